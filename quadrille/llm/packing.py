"""Best-fit packing of token pieces into sequences, with certified bin counts.

Documents are tokenized and cut only beyond the sequence length. The pieces are dealt into groups by a hash,
each small enough for one task; a group is packed by best-fit decreasing over a histogram of gaps. A lower
bound from dual feasible functions certifies how many sequences the group needs at least. Where a group has
more than that, or loose ends, its sequences that are not nearly full are taken apart and their documents
exchanged: they are dealt with those of other such groups into fewer groups, and packed again. This goes on
until one group is left, all are certified, or a round gains nothing.

Cases: a null or empty text is the closing id alone; an empty table gives no rows; repeated rows are packed
each; ties are broken by doc_id and piece; other columns are passed over.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, texts_of

#: Pieces in a group, about.
GROUP_PIECES = 8192
#: Chunks and pieces kept with their ids, by a worker; beyond that a cache starts anew; longer ones aren't kept.
CACHE_CHUNKS, CACHE_PIECES, CACHE_BYTES = 400_000, 400_000, 48
#: How the tokenizer's pre-tokenizer cuts lower-case text, for the letters below U+0100 (a fixed value).
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9]+").findall
#: Chunks of printable ASCII and Latin-1 letters: lower case is letter by letter, NFC changes nothing.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
#: The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 and on, in their order.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_ALPHABET = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - _PRINTABLE))}


class ChunkTokenizer:
    """Ids of whole texts from a tokenizer that drops white space and never merges across it.

    The six ASCII white space characters are separators for its pre-tokenizer, so a text's ids are those of its
    chunks, one after the other. Chunks met before are looked up. A new one in plain letters goes to the
    tokenizer's model piece by piece; any other, and one that holds an added token's string, goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) or "(?!)", re.IGNORECASE).search
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        mapped = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(_ALPHABET)
        ids = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
        if len(piece) <= CACHE_BYTES:
            if len(self.pieces) >= CACHE_PIECES:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def _learn(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if _PLAIN(text) and not self.added(text):
            seen = self.pieces.get
            ids = b"".join([seen(p) or self._piece(p) for p in _PIECES(text.lower())])
        else:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= CACHE_BYTES:
            if len(self.known) >= CACHE_CHUNKS:
                self.known.clear()
            self.known[chunk] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        chunks = text.split()
        parts = list(map(self.known.get, chunks))
        if None in parts:
            for i in [i for i, x in enumerate(parts) if x is None]:
                parts[i] = self._learn(chunks[i]) if (x := self.known.get(chunks[i])) is None else x
        return b"".join(parts)


@functools.lru_cache(2)
def loaded(path: str) -> ChunkTokenizer:
    return ChunkTokenizer(path)


def token_pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids with the closing id."""
    step, end = 4 * capacity, np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = loaded(path)
        for b in batches:
            rows = []
            for k, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = tok.encode(text) + end
                rows += [(k, i, i * capacity, len(x) // 4, zlib.crc32(x)) for i, x in enumerate(ids[at : at + step] for at in range(0, len(ids), step))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts_of(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences needed at least, by the best of three families of dual feasible functions.

    u(x) rounds x down to k-th parts unless it is one; U(x) lifts lengths above capacity - e to the whole and drops
    those below e; the third counts lengths over a half once and others by how many fit beside e.
    """
    if not len(lengths):
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = math.ceil(int((sizes * counts).sum()) / capacity)
    for k in range(1, 21):
        exact = (sizes * (k + 1)) % capacity == 0
        u = np.where(exact, sizes * k, (sizes * (k + 1)) // capacity * capacity)  # times 1 / (k * capacity)
        best = max(best, -(-int((u * counts).sum()) // (k * capacity)))
    for e in np.unique(np.minimum(sizes, capacity - sizes)):
        if 0 < e <= capacity // 2:
            lifted = np.where(sizes > capacity - e, capacity, np.where(sizes < e, 0, sizes))
            best = max(best, -(-int((lifted * counts).sum()) // capacity))
            fit = capacity // e
            stepped = np.where(2 * sizes > capacity, fit - (capacity - sizes) // e, np.where(2 * sizes == capacity, fit / 2, sizes // e))
            best = max(best, math.ceil(float((stepped * counts).sum()) / fit - 1e-9))
    return best


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """The bin and the offset of each length, longest first; and the number of bins.

    A bit mask of the gaps that some bin has finds the smallest one that fits.
    """
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, 0
    where, offset = [0] * len(lengths), [0] * len(lengths)
    for i in order:
        n = lengths[i]
        above = mask >> n
        if above:
            gap = n + (above & -above).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                mask ^= 1 << gap
        else:
            gap, b = capacity, bins
            bins += 1
        where[i], offset[i] = b, capacity - gap
        if gap > n:
            by_gap[gap - n].append(b)
            mask |= 1 << (gap - n)
    return where, offset, bins


PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, grp long, seq long, offset long, bins long, bound long"


def _pack_group(capacity: int, level: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        where, offset, bins = best_fit(pdf["length"].tolist(), capacity)
        return pdf.assign(seq=np.array(where, np.int64) + (np.int64(level) << 56), offset=np.array(offset, np.int64), bins=bins, bound=lower_bound(pdf["length"].to_numpy(), capacity))

    return run


def pack(pieces: DataFrame, capacity: int = 4096, group_pieces: int = GROUP_PIECES, loose_part: int = 16, rounds: int = 8) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    Open for exchange are the sequences with a gap of capacity / ``loose_part`` or more and, in groups above their
    bound, all with any gap. Each round moves the open pieces only, and stops if their gaps add up to less than a
    sequence, if they fit in one group that is certified, or if it has gained nothing.
    """
    todo, done, spent = checkpointed(pieces), [], None
    for level in range(rounds):
        if not (n := todo.count()):
            break
        groups = math.ceil(n / group_pieces)
        dealt = todo.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(level)), F.lit(groups)))
        packed = checkpointed(dealt.groupBy("grp").applyInPandas(_pack_group(capacity, level), PACKED))
        fill = packed.groupBy("grp", "seq").agg(F.sum("length").alias("fill"), F.max("bins").alias("bins"), F.max("bound").alias("bound"))
        gap = F.lit(capacity) - F.col("fill")
        fill = fill.withColumn("open", (gap >= capacity // loose_part) | ((F.col("bins") > F.col("bound")) & (gap > 0)))
        used, loose, free = fill.agg(F.count("*"), F.count_if("open"), F.coalesce(F.sum(F.when(F.col("open"), gap)), F.lit(0))).first()
        if groups == 1 or free < capacity or level == rounds - 1 or (spent is not None and used >= spent):
            done.append(packed)
            break
        marked = checkpointed(packed.join(fill.select("grp", "seq", "open"), ["grp", "seq"]))
        done.append(marked.where(~F.col("open")))
        todo, spent = marked.where("open").select(*pieces.columns), loose
    placed = [d.select(*pieces.columns, (F.col("seq") + F.col("grp") * F.lit(2**32)).alias("sequence_id"), "offset") for d in done]
    if not placed:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    return functools.reduce(DataFrame.unionByName, placed)
