"""Language-model scores: a causal self-attention model in numpy over subword ids, beside a unigram base.

The texts are encoded once and written with their ids. Learning makes two passes over the training texts. The first
counts all their subwords, which fixes a Huffman tree over the whole vocabulary. The second takes the subwords of every
text in consecutive windows and trains the model (embedding of hashed ids and of places, one attention layer) by Adam
and the tree's vectors by Adagrad; each task on what it reads, from a common start; the tasks' parameters are averaged
by their tokens. Both sums are taken in two steps, so that the driver meets one vector however many tasks there were.

Scoring cuts a text into overlapping windows; each subword is scored once, with at least ``CONTEXT`` subwords
before it in its window unless the text begins there. Windows go through the model in batches, with masked
attention.

The unigram base needs the count of every word of every text, which no task can hold. The scoring pass gives
each run of documents a dictionary of its own words and each document a list of places in it; only dictionary
rows are shuffled, to sum the counts of a word, and come back to their run.

Cases: a null or empty text is its end alone; without training text all counts are 0 and the model stays at its
start; rows may repeat and doc_ids may be null (null is a training row); other columns are passed over.
"""

from __future__ import annotations

import contextlib
import ctypes
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, sliced, texts_of, written
from .compress_quality import fold
from .packing import loaded

#: Model: rows of the embedding, width, window, subwords of context that a window repeats.
ROWS, WIDTH, WINDOW, CONTEXT = 2048, 16, 32, 16
assert WINDOW == 2 * CONTEXT  # scoring goes by blocks of CONTEXT subwords, of which a window has two
#: Learning: windows a step, rate of the attention layer, rate of the tree's vectors.
BATCH, RATE, NODE_RATE = 128, 1e-2, 1e-1
#: Added to every count, so that each subword has a leaf of the tree.
SMOOTH = 0.1
#: Windows scored at once; places of a step whose paths are held at once; bytes of text that share a dictionary.
SCORED_AT_ONCE, AT_ONCE, RUN_BYTES = 32, 1024, 32_000_000
#: Blocks of texts that are put together for scoring, at least.
WAITING = 2048
#: Nodes of the tree asked of all places at once.
TOP = 32
END_WORD = np.uint64(0x5EED0FE2D)
_MASK = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)


def rows_of(ids: np.ndarray) -> np.ndarray:
    """The embedding row of each id; the last row stands for the start of a text."""
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(53)).astype(np.int64) % ROWS


class Attention:
    """One causal self-attention layer on an embedding; its hidden rows are what the next subword is told from."""

    SHAPES = {"e": (ROWS + 1, WIDTH), "p": (WINDOW, WIDTH), "w": (WIDTH, 3 * WIDTH), "o": (WIDTH, WIDTH)}
    SIZE = sum(int(np.prod(s)) for s in SHAPES.values())

    def __init__(self, flat: np.ndarray | None = None, seed: int = 7):
        if flat is None:
            rng = np.random.default_rng(seed)
            flat = np.concatenate([rng.normal(0, 0.1, s).ravel() for s in self.SHAPES.values()])
        self.flat = flat.astype(np.float32)[: self.SIZE]
        self.at, begin = {}, 0
        for k, s in self.SHAPES.items():
            size = int(np.prod(s))
            self.at[k] = self.flat[begin : begin + size].reshape(s)
            begin += size
        self.first, self.second, self.steps = np.zeros_like(self.flat), np.zeros_like(self.flat), 0

    def _attend(self, x: np.ndarray):
        n, t, d = x.shape
        qkv = (x.reshape(-1, d) @ self.at["w"]).reshape(n, t, 3 * d)
        q, k, v = qkv[..., :d], qkv[..., d : 2 * d], qkv[..., 2 * d :]
        a = (q * np.float32(d**-0.5)) @ k.transpose(0, 2, 1)
        a += _MASK[:t, :t]
        np.minimum(a, 60, out=a)  # exp stays finite
        np.exp(a, out=a)
        return q, k, v, a, a.sum(-1, keepdims=True)

    def hidden(self, x_rows: np.ndarray) -> np.ndarray:
        """The hidden rows, one for each place."""
        x = self.at["e"][x_rows] + self.at["p"][: x_rows.shape[1]]
        _, _, v, a, total = self._attend(x)
        o = a @ v
        o /= total
        return x.reshape(-1, WIDTH) + o.reshape(-1, WIDTH) @ self.at["o"]

    def gradient(self, x_rows: np.ndarray, gradient_of) -> np.ndarray:
        """``gradient_of`` gives from the hidden rows the loss's gradient by them; this goes on to the parameters."""
        p, d = self.at, WIDTH
        n, t = x_rows.shape
        x = p["e"][x_rows] + p["p"][:t]
        q, k, v, a, total = self._attend(x)
        a /= total
        o = a @ v
        dh = gradient_of(x.reshape(-1, d) + o.reshape(-1, d) @ p["o"])
        g = {"o": o.reshape(-1, d).T @ dh}
        do = (dh @ p["o"].T).reshape(n, t, d)
        ds = do @ v.transpose(0, 2, 1)
        ds -= (do * o).sum(-1, keepdims=True)
        ds *= a
        ds *= np.float32(d**-0.5)
        dqkv = np.concatenate([ds @ k, ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ do], -1).reshape(-1, 3 * d)
        g["w"] = x.reshape(-1, d).T @ dqkv
        dx = dh + dqkv @ p["w"].T
        g["e"] = np.zeros(self.SHAPES["e"], np.float32)
        met, g["e"][met] = _summed_by(x_rows.ravel(), dx)
        g["p"] = np.zeros(self.SHAPES["p"], np.float32)
        g["p"][:t] = dx.reshape(n, t, d).sum(0)
        return np.concatenate([g[k].ravel() for k in self.SHAPES])

    def step(self, grad: np.ndarray) -> None:
        self.steps += 1
        self.first += np.float32(0.1) * (grad - self.first)
        self.second += np.float32(0.01) * (grad * grad - self.second)
        lift = np.float32(RATE * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps))
        self.flat -= lift * self.first / (np.sqrt(self.second) + np.float32(1e-7))


def _summed_by(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys (below 2 ** 16) and the sums of their rows, which have an even number of places."""
    order = np.argsort(keys.astype(np.uint16), kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    # In pairs, as complex numbers: half as many columns to go down.
    return ordered[first], np.add.reduceat(rows.take(order, 0).view(np.complex64), first).view(np.float32)


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, weight) of the nodes of a Huffman tree: leaves first, then inner nodes, the root last; ties by number."""
    n = len(counts)
    weight = np.concatenate([counts.astype(float) + SMOOTH, np.zeros(n - 1)])
    parent = np.zeros(2 * n - 1, np.int64)
    leaves, at = np.argsort(weight[:n], kind="stable").tolist(), 0
    w, inner = weight.tolist(), n
    for new in range(n, 2 * n - 1):  # inner nodes are made in order of weight: two queues do
        for _ in (0, 1):
            if at < n and (inner == new or w[leaves[at]] <= w[inner]):
                k, at = leaves[at], at + 1
            else:
                k, inner = inner, inner + 1
            parent[k] = new
            w[new] += w[k]
    return parent, np.array(w)


class Tree:
    """The softmax over all subwords as yes-no questions down a Huffman tree.

    Each inner node has a vector and a bias; the chance of its first child is the logistic function of their sum with
    the hidden row. The biases begin as the counts have it and the vectors at 0, so the tree begins as the unigram
    model. A subword asks about as many questions as its share has bits, so frequent ones are cheap.

    The heaviest nodes are the last, and with one are all above it. Most questions are theirs: they are asked of all
    places in one product of matrices, with 0 as the sign where a path leaves them. The rest are gathered path by path.
    """

    def __init__(self, counts: np.ndarray, flat: np.ndarray | None = None):
        parent, weight = huffman(counts)
        n = len(counts)
        top = len(weight) - 1
        second = np.zeros(len(weight), bool)
        inner = np.arange(n, top + 1)
        child = np.full(top + 1, -1)
        child[parent[:top][::-1]] = np.arange(top)[::-1]  # the first child is the lower one
        second[:top] = child[parent[:top]] != np.arange(top)
        share = weight[child[inner]] / weight[inner]
        self.bias = np.log(share / (1 - share)).astype(np.float32)
        up, nodes, signs, owners = np.arange(n), [], [], []
        who = np.arange(n)
        while len(up):
            keep = up != top
            up, who = up[keep], who[keep]
            nodes.append(parent[up] - n)
            signs.append(np.where(second[up], -1, 1))
            owners.append(who)
            up = parent[up]
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        self.nodes, self.signs = np.concatenate(nodes)[order], np.concatenate(signs)[order].astype(np.float32)
        self.length = np.bincount(owner, minlength=n)
        self.begin = np.cumsum(self.length) - self.length
        self.top = n - 1 - min(TOP, n - 1)
        asked = np.flatnonzero(self.nodes >= self.top)
        self.below = self.length - np.bincount(owner[order[asked]], minlength=n)  # a path goes up: these come first
        last = self.begin + self.below  # where a path meets the heaviest nodes
        way = self.nodes[last] * 2 + (self.signs[last] > 0)
        met, self.leaves_by = np.unique(way, return_inverse=True)
        sample = np.zeros(len(met), np.int64)
        sample[self.leaves_by] = np.arange(n)
        self.top_signs = np.zeros((len(met), n - 1 - self.top), np.float32)
        for i, k in enumerate(sample.tolist()):
            path = slice(last[k], self.begin[k] + self.length[k])
            self.top_signs[i, self.nodes[path] - self.top] = self.signs[path]
        self.none_asked = (np.float32(np.log(2)) * (self.top_signs == 0).sum(1)).astype(np.float32)
        bias = self.bias
        self.both = np.zeros((n - 1, WIDTH + 2), np.float32)  # the last column stays 0: an even number is summed faster
        self.v, self.bias = self.both[:, :WIDTH], self.both[:, WIDTH]
        self.bias[:] = bias
        if flat is not None:
            self.v[:] = flat[: self.v.size].reshape(self.v.shape)
            self.bias[:] = flat[self.v.size : self.v.size + n - 1]
        self.sums = np.ones((n - 1, 1), np.float32)

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([self.v.ravel(), self.bias])

    def _asked(self, h: np.ndarray, ids: np.ndarray):
        """What all questions are about: those of the heaviest nodes place by place, the others layer by layer.

        The first layer has the first question of each place that asks others, the second the second of those that
        ask two, and so on; places with more come first, so that each layer is of the first so many. Gives the hidden
        rows with a 1 and a 0; the heaviest nodes' signs and signed sums; the others' places, layers (as slices), nodes, signs,
        hidden rows, vectors with biases, signed sums.
        """
        given, h = h, np.zeros((len(h), WIDTH + 2), np.float32)
        h[:, :WIDTH], h[:, WIDTH] = given, 1
        top_signs = self.top_signs.take(self.leaves_by.take(ids), 0)
        top = h @ self.both[self.top :].T
        top *= top_signs
        length = self.below.take(ids)
        so_many = np.bincount(length)
        places = np.argsort(-length.astype(np.int16), kind="stable")[: len(ids) - (so_many[0] if len(so_many) else 0)]
        ends = np.cumsum(np.cumsum(so_many[:0:-1])[::-1]).tolist()
        layers = [slice(i, j) for i, j in zip([0, *ends], ends, strict=False)]
        begin, rows = self.begin.take(ids.take(places)), np.empty((ends[-1] if ends else 0, WIDTH + 2), np.float32)
        at, mine = np.empty(len(rows), np.int64), h.take(places, 0)
        for i, x in enumerate(layers):
            k = x.stop - x.start
            rows[x] = mine[:k]
            np.add(begin[:k], i, out=at[x])
        nodes, signs = self.nodes.take(at), self.signs.take(at)
        vectors = self.both.take(nodes, 0)
        z = np.einsum("ij,ij->i", vectors, rows)
        z *= signs
        return h, top_signs, top, places, layers, nodes, signs, rows, vectors, z

    def log_probs(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of the ids."""
        out = np.zeros(len(ids), np.float32)
        for i in range(0, len(ids), AT_ONCE):
            part = ids[i : i + AT_ONCE]
            _, _, top, places, layers, *_, z = self._asked(h[i : i + AT_ONCE], part)
            for x in (top, z):
                np.negative(x, out=x)
                np.minimum(x, 80, out=x)
                np.exp(x, out=x)
                x += 1
                np.log(x, out=x)
            others = np.zeros(len(places), np.float32)
            for x in layers:
                others[: x.stop - x.start] += z[x]
            got = self.none_asked[self.leaves_by[part]] - top.sum(1)
            got[places] -= others
            out[i : i + AT_ONCE] = got
        return out

    def gradients(self, h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The gradient by the hidden rows; the nodes met (and all of the heaviest) and the gradient by their vectors and biases."""
        dh, met, g = self._gradients(h, ids)
        return dh, met, g[:, : WIDTH + 1]

    def _gradients(self, h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same with the column of zeros."""
        h, top_signs, top, places, layers, nodes, signs, rows, vectors, z = self._asked(h, ids)
        for x in (top, z):
            np.minimum(x, 80, out=x)
            np.exp(x, out=x)
            x += 1
        np.divide(top_signs, top, out=top)
        dh, met, g = top @ -self.v[self.top :], np.arange(self.top, len(self.v)), top.T @ h
        np.negative(g, out=g)
        if len(places):
            by_sum = (-signs / z)[:, None]
            vectors *= by_sum
            rows *= by_sum
            others = np.zeros((len(places), WIDTH), np.float32)
            for x in layers:
                others[: x.stop - x.start] += vectors[x, :WIDTH]
            dh[places] += others
            nodes, sums = _summed_by(nodes, rows)
            met, g = np.concatenate([nodes, met]), np.concatenate([sums, g])
        return dh, met, g

    def step(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Moves the vectors and biases of the nodes met; gives the gradient by the hidden rows before that."""
        out = np.empty_like(h)
        for i in range(0, len(ids), AT_ONCE):
            out[i : i + AT_ONCE], met, g = self._gradients(h[i : i + AT_ONCE], ids[i : i + AT_ONCE])
            sums = self.sums.take(met, 0)
            sums += np.einsum("ij,ij->i", g, g)[:, None] / np.float32(WIDTH + 1)
            self.sums[met] = sums
            g *= np.float32(NODE_RATE) / np.sqrt(sums)
            self.both[met] -= g
        return out


# --- learning ------------------------------------------------------------------------------------------------


def windows_of(all_ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All of the texts' ids in consecutive windows: the ids before (-1 at the start), the ids, and which places are taken."""
    lengths = np.fromiter(map(len, all_ids), np.int64, len(all_ids))
    room = -(-lengths // WINDOW) * WINDOW
    begin = np.cumsum(room) - room
    flat = np.concatenate(all_ids).astype(np.int64)
    at = np.arange(len(flat)) + np.repeat(begin - (np.cumsum(lengths) - lengths), lengths)
    before, ids, taken = np.zeros(room.sum(), np.int64), np.zeros(room.sum(), np.int64), np.zeros(room.sum(), np.float32)
    ids[at], taken[at] = flat, 1
    before[at[1:]] = flat[:-1]
    before[begin] = -1
    return before.reshape(-1, WINDOW), ids.reshape(-1, WINDOW), taken.reshape(-1, WINDOW)


def _vector(v: np.ndarray) -> pa.RecordBatch:
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    return pa.RecordBatch.from_arrays([pa.array([part % 16], pa.int32()), pa.array([zlib.compress(v.astype("<f8").tobytes(), 1)], pa.binary())], names=["salt", "blob"])


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(x), "<f8") for x in pdf["blob"])
    return pd.DataFrame({"salt": [0], "blob": [zlib.compress(total.tobytes(), 1)]})


def _sum_vectors(parts: DataFrame, size: int) -> np.ndarray:
    once = parts.groupBy("salt").applyInPandas(_add, "salt int, blob binary")
    got = once.groupBy(F.lit(0).alias("all")).applyInPandas(lambda pdf: _add(pdf), "salt int, blob binary").collect()
    return np.frombuffer(zlib.decompress(got[0].blob), "<f8") if got else np.zeros(size)


ENCODED = "doc_id long, text binary, held_out boolean, ids binary"


def _encode(path: str, end: int):
    """The rows with the ids of their texts, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, last = loaded(path), np.array([end], "<u4").tobytes()
        for b in sliced(batches):
            ids = [_squeezed(tok.encode(t) + last) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "text", "held_out")), pa.array(ids, pa.binary())], names=["doc_id", "text", "held_out", "ids"])

    return run


def _count(end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(end + 1)
        for b in sliced(batches):
            if b.num_rows:
                total += np.bincount(np.concatenate([_unpacked(x) for x in b.column("ids").to_pylist()]), minlength=end + 1)
        if total.any():
            yield _vector(total)

    return run


def _spared() -> None:
    """Gives back what a worker has kept since it encoded texts (the tokenizer and its caches) and what is free since."""
    loaded.cache_clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # the C library may have no such call
        ctypes.CDLL(None).malloc_trim(0)


def _begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch] | None:
    """The same batches, or None if there are none: many tasks have no rows and need no model."""
    first = next(batches, None)
    return None if first is None else itertools.chain([first], batches)


def _train(counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _spared()
        if (batches := _begun(batches)) is None:
            return
        model, tree, pending, tokens = Attention(), Tree(counts), None, 0

        def step(before: np.ndarray, ids: np.ndarray, taken: np.ndarray) -> int:
            at = np.flatnonzero(taken)

            def gradient_of(h: np.ndarray) -> np.ndarray:
                out = np.zeros_like(h)
                out[at] = tree.step(h[at], ids.ravel()[at])
                out /= len(at)
                return out

            model.step(model.gradient(np.where(before < 0, ROWS, rows_of(np.maximum(before, 0))), gradient_of))
            return len(at)

        for b in batches:
            for part in sliced([b]):
                if not part.num_rows:
                    continue
                new = windows_of([_unpacked(x) for x in part.column("ids").to_pylist()])
                pending = new if pending is None else tuple(np.concatenate(x) for x in zip(pending, new, strict=True))
                full = len(pending[0]) // BATCH * BATCH
                for i in range(0, full, BATCH):
                    tokens += step(*(x[i : i + BATCH] for x in pending))
                pending = tuple(x[full:] for x in pending)
        if pending is not None and len(pending[0]):
            tokens += step(*pending)
        if tokens:
            yield _vector(np.concatenate([model.flat, tree.flat, [1.0]]) * tokens)

    return run


def learn(training: DataFrame, path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts of subwords, parameters) from the rows (ids)."""
    counts = _sum_vectors(training.select("ids").mapInArrow(_count(end), "salt int, blob binary"), end + 1)
    start = np.concatenate([Attention().flat, Tree(counts).flat])
    total = _sum_vectors(training.select("ids").mapInArrow(_train(counts), "salt int, blob binary"), len(start) + 1)
    return counts, (total[:-1] / total[-1]).astype(np.float32) if total[-1] else start


# --- scoring -------------------------------------------------------------------------------------------------


class Scorer:
    def __init__(self, path: str, end: int, counts: np.ndarray, params: np.ndarray):
        self.path, self.end, self.model = path, end, Attention(params)
        self.tree = Tree(counts, params[Attention.SIZE :] if len(params) > Attention.SIZE else None)
        self.by_row, self.by_place = self._tables()

    @property
    def tok(self):
        return loaded(self.path)  # not needed for ids

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return self.scores_of([np.append(np.frombuffer(self.tok.encode(t), "<u4"), self.end) for t in texts])

    def scores_of(self, all_ids: list[np.ndarray]) -> np.ndarray:
        """log10 of the probability of each text, given its ids; blocks of all texts share batches."""
        out, begin, waiting = np.zeros(len(all_ids)), 0, 0
        for i, ids in enumerate(all_ids):
            waiting += -(-len(ids) // CONTEXT)
            if waiting >= WAITING or i == len(all_ids) - 1:
                out[begin : i + 1] = self._scores(all_ids[begin : i + 1])
                begin, waiting = i + 1, 0
        return out / np.log(10)

    def _scores(self, all_ids: list[np.ndarray]) -> np.ndarray:
        lengths = np.fromiter(map(len, all_ids), np.int64, len(all_ids))
        blocks = -(-lengths // CONTEXT)
        starts = np.cumsum(blocks) - blocks
        begins = starts[lengths > 0]
        flat = np.concatenate(all_ids).astype(np.int64)
        at = np.arange(len(flat)) + np.repeat(starts * CONTEXT - (np.cumsum(lengths) - lengths), lengths)
        rows = np.full((blocks.sum() + 1, CONTEXT), ROWS)  # a block in front stands for what the first has before it
        rows.ravel()[CONTEXT + at[1:]] = rows_of(flat[:-1])
        rows[1 + begins, 0] = ROWS
        first = np.zeros(len(rows) - 1, bool)
        first[begins] = True
        step, logs = 2 * SCORED_AT_ONCE, np.empty(len(flat), np.float32)
        for i in range(0, len(first), step):
            j, k = np.searchsorted(at, (i * CONTEXT, (i + step) * CONTEXT))
            h = self._hidden(rows[i : i + step + 1], first[i : i + step])
            logs[j:k] = self.tree.log_probs(h.take(at[j:k] - i * CONTEXT, 0), flat[j:k])
        return np.bincount(np.repeat(np.arange(len(all_ids)), lengths), logs, len(all_ids))

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        """By embedding row and by place: query, key, value as it goes to the hidden row, and the input itself."""
        p, d = self.model.at, WIDTH
        w = np.concatenate([p["w"][:, :d] * np.float32(d**-0.5), p["w"][:, d : 2 * d], p["w"][:, 2 * d :] @ p["o"], np.eye(d, dtype=np.float32)], 1)
        return p["e"] @ w, p["p"] @ w

    def _hidden(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The hidden rows of all blocks but the one in front; the ``first`` of a text has none before it.

        A block's places are the second half of a window and the block before it is the first, or, if it is a text's
        first, the first half. So the hidden rows are those of ``Attention.hidden`` on windows that begin every
        CONTEXT subwords; but no place goes through the model in both.
        """
        c, d = CONTEXT, WIDTH
        met = self.by_row.take(rows, 0)
        own = met[1:] + self.by_place[c:]
        at = np.flatnonzero(first)
        own[at] = met[1:][at] + self.by_place[:c]
        keys = np.concatenate([met[:-1, :, d : 2 * d] + self.by_place[:c, d : 2 * d], own[..., d : 2 * d]], 1)
        values = np.ones((len(own), WINDOW, d + 1), np.float32)  # the last sums the weights
        np.add(met[:-1, :, 2 * d : 3 * d], self.by_place[:c, 2 * d : 3 * d], out=values[:, :c, :d])
        values[:, c:, :d] = own[..., 2 * d : 3 * d]
        a = own[..., :d] @ keys.transpose(0, 2, 1)
        a += _MASK[c:]
        a[at, :, :c] = -1e9
        np.minimum(a, 60, out=a)
        np.exp(a, out=a)
        o = a @ values
        return (own[..., 3 * d :] + o[..., :d] / o[..., d:]).reshape(-1, d)


def _squeezed(x: bytes) -> bytes:
    """Compressed, after the number of bytes. A column's value has less than 2 ** 31."""
    return len(x).to_bytes(4, "little") + pa.compress(x, "zstd", asbytes=True)


def _packed(x: np.ndarray) -> bytes:
    return _squeezed(np.ascontiguousarray(x.astype("<u4")).tobytes())


def _unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(x[4:], int.from_bytes(x[:4], "little"), "zstd", asbytes=True), "<u4")


def _dictionary(held: list[tuple[bool, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list[bytes], list[bytes]]:
    """The words of a run of documents in order and their count in training; each document's places among them and times, packed.

    ``held`` has for each document whether it is held out, its words (ordered hashes, each once) and how often it has them.
    Documents are looked up one by one, so that beside the words themselves nothing is as long as all of them together.
    """
    words = np.unique(np.concatenate([w for _, w, _ in held]))
    known = np.zeros(len(words), np.int64)
    places, times = [], []
    for out, w, n in held:
        at = np.searchsorted(words, w)
        if not out:
            known[at] += n
        places.append(_packed(np.diff(at, prepend=0)))
        times.append(_packed(n))
    return words, known, places, times


RUN = "run long, doc_id long, held_out boolean, n_tokens long, score double, places binary, times binary, word long, place int, count long"


def _score_and_list(path: str, end: int, counts: np.ndarray, params: np.ndarray):
    """Rows of documents, and rows of the words of each run of documents with their count in training."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _spared()
        if (batches := _begun(batches)) is None:
            return
        scorer = Scorer(path, end, counts, params)
        names = [f.split()[0] for f in RUN.split(", ")]
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.float64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
        held, part, number = [], TaskContext.get().partitionId(), 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal held, number
            key = (part << 24) + number
            number += 1
            words, known, places, times = _dictionary([(out, w, c) for _, out, _, w, c in held])
            n = len(held)
            cols = [np.full(n, key), [h[0] for h in held], [h[1] for h in held], [int(h[4].sum()) for h in held], [h[2] for h in held], places, times]
            held = []
            yield pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip(cols, types, strict=False)), *(pa.nulls(n, t) for t in types[7:])], names=names)
            m = len(words)
            for i in range(0, m, 100_000):
                j = slice(i, min(i + 100_000, m))
                k = j.stop - i
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, key)), *(pa.nulls(k, t) for t in types[1:7]), pa.array(words[j].view(np.int64)), pa.array(np.arange(i, j.stop, dtype=np.int32)), pa.array(known[j])], names=names)
            del words, known, places, times, cols
            _spared()

        size = 0
        for b in batches:
            for at in range(0, b.num_rows, 256):
                c = b.slice(at, 256)
                texts = c.column("text").to_pylist()
                for k, out, text, score in zip(c.column("doc_id").to_pylist(), c.column("held_out").to_pylist(), texts, scorer.scores_of([_unpacked(x) for x in c.column("ids").to_pylist()]), strict=True):
                    w = text.lower().split()
                    h = np.append(np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)), END_WORD)
                    words, times = np.unique(h, return_counts=True)
                    held.append((k, out, float(score), words, times.astype(np.uint32)))
                    size += len(text)
                if size >= RUN_BYTES:
                    yield from close()
                    size = 0
        if held:
            yield from close()

    return run


def _base(total: int, distinct: int):
    def run(key: tuple, docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        c = np.zeros(len(words), np.int64)
        c[words["place"].to_numpy()] = words["known"].to_numpy()
        logs, floor = np.log10(c + 1.0), np.log10(total + distinct + 1.0)
        base, known = [], []
        for p, t in zip(docs["places"], docs["times"], strict=True):
            at, times = np.cumsum(_unpacked(p), dtype=np.int64), _unpacked(t).astype(np.int64)
            base.append(float((logs[at] * times).sum() - times.sum() * floor))
            known.append(int(times[c[at] > 0].sum()))
        return docs[["doc_id", "held_out", "n_tokens", "score"]].assign(n_known=known, base_score=base)

    return run


def text_scores(docs: DataFrame, path: str, folds: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    end = loaded(path).tokenizer.get_vocab_size()
    marked = texts_of(docs, F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"))
    encoded = written(marked.mapInArrow(_encode(path, end), ENCODED))
    counts, params = learn(encoded.where(~F.col("held_out")), path, end)
    listed = written(encoded.mapInArrow(_score_and_list(path, end, counts, params), RUN))
    words = listed.where("word is not null").select("run", "word", "place", "count")
    by_word = Window.partitionBy("word")
    summed = written(words.select("run", "place", F.sum("count").over(by_word).alias("known"), (F.row_number().over(by_word.orderBy("run")) == 1).alias("first")))
    total = words.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    distinct = summed.where("first and known > 0").count()
    rows = listed.where("word is null").select("run", "doc_id", "held_out", "n_tokens", "score", "places", "times")
    n = partitions(docs.sparkSession)
    scored = rows.repartition(n, "run").groupBy("run").cogroup(summed.select("run", "place", "known").repartition(n, "run").groupBy("run")).applyInPandas(_base(total, distinct), "doc_id long, held_out boolean, n_tokens long, score double, n_known long, base_score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
