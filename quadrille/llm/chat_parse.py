"""Chat transcripts back to turns: a hidden Markov model over lines, decoded by Viterbi.

A state is a role and whether the line begins a turn or goes on with it. What a line shows is a tuple of small
features: the speaker marker it begins with, its length, its last character, the case of its first letter.
Emissions are products over the features; they and the transitions are counted over all labelled conversations.
The best path gives the roles; runs of lines make turns, which are rendered in one canonical form with the markers
taken off.

Conversations have no bound. Rows are range-partitioned and sorted by conversation and turn, so that one may lie over
many partitions, and every task streams its rows. Where a conversation crosses a seam between partitions, what the
part on either side does to the scores is a matrix over the states (max-plus products; whole numbers, so that they
are exact). The driver multiplies the two of each partition along the seams, and each part is decoded from the scores
that enter it to the state that it has to end in. The path is that of the whole conversation, however it is cut.

Cases: a null or empty transcript has no turns; blank lines go on with their turn; an unknown role is learned
as the user's; without labelled rows the priors decide; repeated rows are turns each; rows without conv_id are one
conversation; extra columns go.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

ROLES = ("system", "user", "assistant")
STATES = [(r, b) for r in range(len(ROLES)) for b in (True, False)]
#: Markers by role (fixed values); the first of a role is written most often.
MARKERS = {"system": ("System", "Instructions"), "user": ("User", "Human", "Q"), "assistant": ("Assistant", "AI", "Bot", "A")}
_MARK = re.compile(r"^[\s>*#\[]*(" + "|".join(m for ms in MARKERS.values() for m in ms) + r")[\]*]*\s*[:>-]\s*", re.IGNORECASE)
_ROLE_OF = {m.lower(): ROLES.index(r) for r, ms in MARKERS.items() for m in ms}
#: Values of each feature: marker (none or a role), length, end, beginning.
SIZES = (4, 5, 4, 3)
#: Log probabilities are whole numbers of this fraction, so that sums don't depend on their order.
UNIT = 1 << 20
#: Lines and characters after which a task looks how far back the path is settled, and gives that part out.
PIECE_LINES, PIECE_CHARS = 4096, 1 << 20


def features(line: str) -> tuple[int, int, int, int]:
    m = _MARK.match(line)
    body = line[m.end() :] if m else line
    n = len(body)
    last, first = body.rstrip()[-1:], body.lstrip()[:1]
    return (
        1 + _ROLE_OF[m[1].lower()] if m else 0,
        0 if not n else 1 if n < 40 else 2 if n < 160 else 3 if n < 600 else 4,
        0 if not last else 1 if last == "?" else 2 if last in ".!" else 3,
        0 if not first.isalpha() else 1 if first.isupper() else 2,
    )


def stripped(line: str) -> str:
    return _MARK.sub("", line, count=1)


class LineModel:
    """Log probabilities from counts: starts, transitions, emissions by feature."""

    def __init__(self, counts: np.ndarray | None = None):
        s = len(STATES)
        begin, move = np.ones(s), np.full((s, s), 0.05)
        emit = [np.ones((s, k)) for k in SIZES]
        for i, (r, b) in enumerate(STATES):
            begin[i] = 1.0 if b else 1e-6
            for j, (q, c) in enumerate(STATES):
                move[i, j] = (1.0 if q == r else 1e-9) if not c else (1e-3 if q == r else 0.5)
            emit[0][i, 1 + r] += 3.0 if b else 0.0
            emit[0][i, 0] += 0.0 if b else 20.0
        if counts is not None:
            at = 0
            for a in (begin, move, *emit):
                a += counts[at : at + a.size].reshape(a.shape)
                at += a.size
        move[:, :] = np.where([[not c and q != r for q, c in STATES] for r, _ in STATES], 1e-12, move)
        self.begin, self.move, *self.emit = (np.rint(np.log(a / a.sum(-1, keepdims=True)) * UNIT).astype(np.int64) for a in (begin, move, *emit))

    @staticmethod
    def size() -> int:
        s = len(STATES)
        return s + s * s + sum(s * k for k in SIZES)

    @staticmethod
    def count(path: list[int], seen: list[tuple], into: np.ndarray, before: int | None = None) -> None:
        """Add the lines of a turn; ``before`` is the state of the line before it."""
        s = len(STATES)
        if before is None:
            into[path[0]] += 1
            steps = zip(path, path[1:], strict=False)
        else:
            steps = zip([before, *path], path, strict=False)
        for p, q in steps:
            into[s + p * s + q] += 1
        at = s + s * s
        for k, size in enumerate(SIZES):
            for p, f in zip(path, seen, strict=True):
                into[at + p * size + f[k]] += 1
            at += s * size

    def shown(self, f: tuple) -> np.ndarray:
        """The scores of the states for what a line shows."""
        return self.emit[0][:, f[0]] + self.emit[1][:, f[1]] + self.emit[2][:, f[2]] + self.emit[3][:, f[3]]

    def viterbi(self, seen: list[tuple]) -> list[int]:
        """The likeliest states of the lines; the earlier state where two are alike."""
        best, back = self.begin + self.shown(seen[0]), []
        for f in seen[1:]:
            through = best[:, None] + self.move
            back.append(through.argmax(0))
            best = through.max(0) + self.shown(f)
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]

    def product(self, seen: Iterable[tuple], starts: bool) -> tuple[int, np.ndarray]:
        """(lines, matrix): the best score from each state before the lines to each state of the last, up to a constant.

        One row where the lines start a conversation.
        """
        m, n = None, 0
        for n, f in enumerate(seen, 1):
            e = self.shown(f)
            if m is None:
                m = self.begin[None, :] + e if starts else self.move + e
            else:
                m = (m[:, :, None] + self.move).max(1) + e
            if not n % 1024:
                m -= m.max()
        return n, m - m.max()

    def origins(self, seen: Iterable[tuple], enter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state before the lines for each state of the last on its best path, their scores)."""
        best, origin = enter, np.arange(len(STATES))
        for n, f in enumerate(seen, 1):
            through = best[:, None] + self.move
            origin = origin[through.argmax(0)]
            best = through.max(0) + self.shown(f)
            if not n % 1024:
                best -= best.max()
        return origin, best - best.max()

    def decoded(self, seen: Iterable[tuple[tuple, int]], enter: np.ndarray | None, end: int | None) -> Iterator[list[int]]:
        """The path in pieces. ``seen`` has the features and the length of each line.

        ``enter`` has the scores before the first line where the conversation started earlier; ``end`` is the last state
        where it goes on later. A piece is what all ways back agree on.
        """
        best, back, size = enter, [], 0
        for f, chars in seen:
            if best is None:
                best = self.begin + self.shown(f)
                back.append(np.zeros(len(STATES), np.uint8))
            else:
                through = best[:, None] + self.move
                back.append(through.argmax(0).astype(np.uint8))
                best = through.max(0) + self.shown(f)
            size += chars
            if len(back) % PIECE_LINES == 0 or size >= PIECE_CHARS:
                best = best - best.max()
                size = 0
                at = np.arange(len(STATES))
                for i in range(len(back) - 1, 0, -1):
                    at = back[i][at]
                    if (at == at[0]).all():
                        yield self._traced(back[:i], int(at[0]))
                        del back[:i]
                        break
        if back:
            yield self._traced(back, int(best.argmax()) if end is None else end)

    @staticmethod
    def _traced(back: list[np.ndarray], last: int) -> list[int]:
        path = [last]
        for b in reversed(back[1:]):
            path.append(int(b[path[-1]]))
        return path[::-1]


def parse(text: str, model: LineModel) -> list[tuple[str, str]]:
    """(role, content) of the turns of a transcript."""
    lines = text.split("\n") if text else []
    if not lines:
        return []
    turns: list[tuple[str, list[str]]] = []
    for line, s in zip(lines, model.viterbi([features(x) for x in lines]), strict=True):
        role, begins = STATES[s]
        if begins or not turns:
            turns.append((ROLES[role], [stripped(line)]))
        else:
            turns[-1][1].append(line)
    return [(r, "\n".join(x)) for r, x in turns]


def render(turns: list[tuple[str, str]]) -> str:
    """The canonical form: a header line with the role, the content, an end mark."""
    return "".join(f"<|{role}|>\n{content}\n<|end|>\n" for role, content in turns)


def written_out(turns: list[tuple[int, str, str]]) -> tuple[str, list[int]]:
    """A transcript as people paste them, and the state of each line.

    By a hash of turn and text a turn has one of its role's markers, or in one case of eight none.
    """
    lines, states = [], []
    for turn, role, text in turns:
        r = ROLES.index(role) if role in ROLES else 1
        h = zlib.crc32(f"{turn}:{text[:64]}".encode())
        marks = MARKERS[ROLES[r]]
        head = "" if h % 8 == 0 else f"{marks[0 if h % 3 else h // 8 % len(marks)]}: "
        for i, line in enumerate((text or "").split("\n")):
            lines.append(head + line if not i else line)
            states.append(STATES.index((r, not i)))
    return "\n".join(lines), states


def ordered(conversations: DataFrame, parts: int | None = None) -> DataFrame:
    """(conv_id, turn, role, text) sorted over all partitions; rows alike are told apart, so that no range is one value."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), "role", "text", F.monotonically_increasing_id().alias("row"))
    by = ("conv_id", "turn", "role", "text", "row")
    dealt = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    return checkpointed(dealt.sortWithinPartitions(*by).drop("row"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """The conversations of a partition, each with its rows, streamed."""
    return groupby(_rows(batches), key=lambda r: r[0])


def _lines(rows: Iterable[tuple]) -> Iterator[tuple[str, int]]:
    """The lines of the transcript and their true states."""
    for _, turn, role, text in rows:
        lines, states = written_out([(turn, role, text or "")])
        yield from zip(lines.split("\n"), states, strict=True)


def _seen(rows: Iterable[tuple]) -> Iterator[tuple]:
    return (features(x) for x, _ in _lines(rows))


@dataclass
class Seams:
    """What the driver knows of the partitions, a few numbers each: where a conversation goes on in the next one.

    ``joined`` has the partitions whose first conversation started in the one before (``before``). For them ``enter`` has
    the scores that come in and ``lines`` the number of lines so far; ``end`` has the state in which the last
    conversation of a partition has to end where it goes on.
    """

    before: dict[int, int] = field(default_factory=dict)
    last: dict[int, int | None] = field(default_factory=dict)
    enter: dict[int, np.ndarray] = field(default_factory=dict)
    lines: dict[int, int] = field(default_factory=dict)
    end: dict[int, int] = field(default_factory=dict)

    def opens(self) -> set[int]:
        """The partitions whose last conversation goes on in the next one."""
        return set(self.before.values())


def learn(rows: DataFrame) -> tuple[LineModel, Seams]:
    """The model and the seams from ``ordered`` rows: every line of every conversation is counted.

    One row of fixed size for each partition comes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first, conv, state = np.zeros(LineModel.size()), None, None, None
        for conv, turns in _runs(batches):
            state = None
            for _, turn, role, text in turns:
                lines, path = written_out([(turn, role, text or "")])
                LineModel.count(path, [features(x) for x in lines.split("\n")], total, state)
                first = first or (conv, path[0])
                state = path[-1]
        if first:
            values = (TaskContext.get().partitionId(), first[0], first[1], conv, state, total.tolist())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.float64())), strict=True)], names=["part", "first_conv", "first_state", "last_conv", "last_state", "counts"])

    got = sorted(rows.mapInArrow(run, "part int, first_conv long, first_state int, last_conv long, last_state int, counts array<double>").collect(), key=lambda r: r.part)
    if not got:
        return LineModel(), Seams()
    total, seams, s = np.sum([r.counts for r in got], 0), Seams(), len(STATES)
    for a, b in zip(got, got[1:], strict=False):
        if a.last_conv == b.first_conv:  # no start but a step
            total[b.first_state] -= 1
            total[s + a.last_state * s + b.first_state] += 1
            seams.before[b.part] = a.part
    seams.last = {r.part: r.last_conv for r in got if r.part in seams.opens()}
    model = LineModel(total)
    if seams.before:
        _cross(rows, model, seams)
    return model, seams


def _cross(rows: DataFrame, model: LineModel, seams: Seams) -> None:
    """Fill in what enters the parts of conversations that cross seams, and where they have to end."""
    opens = seams.opens()
    joined, last = set(seams.before), dict(seams.last)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, (conv, turns) in enumerate(_runs(batches)):
            goes_on = part in opens and conv == last[part]
            joins = i == 0 and part in joined
            if goes_on or joins:
                n, m = model.product(_seen(turns), not joins)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([joins]), pa.array([goes_on]), pa.array([n], pa.int64()), pa.array([m.ravel().tolist()], pa.list_(pa.int64()))], names=["part", "joins", "goes_on", "n", "m"])

    got = rows.mapInArrow(products, "part int, joins boolean, goes_on boolean, n long, m array<long>").collect()
    leaves: dict[int, tuple[np.ndarray, int]] = {}
    for r in sorted(got, key=lambda r: (r.part, not r.joins)):
        m, n = np.array(r.m).reshape(-1, len(STATES)), r.n
        if r.joins:
            enter, before = leaves[seams.before[r.part]]
            seams.enter[r.part], seams.lines[r.part] = enter, before
            m, n = (enter[:, None] + m).max(0)[None, :], n + before
        if r.goes_on:
            leaves[r.part] = (m[0] - m[0].max(), n)
    enters = dict(seams.enter)

    def origins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, (conv, turns) in enumerate(_runs(batches)):
            if i == 0 and part in enters:
                origin, best = model.origins(_seen(turns), enters[part])
                goes_on = part in opens and conv == last[part]
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([goes_on]), pa.array([origin.tolist()], pa.list_(pa.int32())), pa.array([int(best.argmax())], pa.int32())], names=["part", "goes_on", "origin", "best"])

    back = rows.mapInArrow(origins, "part int, goes_on boolean, origin array<int>, best int").collect()
    for r in sorted(back, key=lambda r: -r.part):
        seams.end[seams.before[r.part]] = r.origin[seams.end[r.part] if r.goes_on else r.best]


def parsed(rows: DataFrame, model: LineModel, seams: Seams) -> DataFrame:
    """Pieces of the canonical renderings of ``ordered`` rows; those of a conversation by ``start_line`` make up the whole.

    conv_id, start_line, n_lines, n_turns, n_right (lines with the right role), digest, rendered. ``digest`` is the
    exclusive or of a hash of each line's number and rendering: over a conversation it doesn't depend on the pieces.
    """

    def pieces(conv: int | None, turns: Iterator[tuple], at: int, enter: np.ndarray | None, end: int | None) -> Iterator[tuple]:
        held: list[tuple[str, int]] = []

        def read() -> Iterator[tuple[tuple, int]]:
            for line, truth in _lines(turns):
                held.append((line, truth))
                yield features(line), len(line)

        found, ready = model.decoded(read(), enter, end), None
        while True:
            path = next(found, None)
            if ready is not None:  # the last piece closes the last turn
                yield _piece(conv, *ready, closes=path is None and end is None)
            if path is None:
                return
            ready = (at, held[: len(path)], path)
            del held[: len(path)]
            at += len(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        made, size = [], 0
        for i, (conv, turns) in enumerate(_runs(batches)):
            joins = i == 0 and part in seams.enter
            end = seams.end[part] if part in seams.end and conv == seams.last[part] else None
            for p in pieces(conv, turns, seams.lines[part] if joins else 0, seams.enter[part] if joins else None, end):
                made.append(p)
                size += len(p[-1])
                if len(made) >= 1024 or size >= 4 * PIECE_CHARS:
                    yield _batch(made)
                    made, size = [], 0
        if made:
            yield _batch(made)

    return rows.mapInArrow(run, "conv_id long, start_line long, n_lines long, n_turns long, n_right long, digest long, rendered string")


def _piece(conv: int | None, at: int, lines: list[tuple[str, int]], path: list[int], closes: bool) -> tuple:
    parts, turns, right = [], 0, 0
    for i, ((line, truth), state) in enumerate(zip(lines, path, strict=True)):
        role, begins = STATES[state]
        first = at + i == 0
        turns += begins or first
        right += STATES[truth][0] == role
        parts.append(("" if first else "\n<|end|>\n") + f"<|{ROLES[role]}|>\n{stripped(line)}" if begins or first else "\n" + line)
    if closes:
        parts[-1] += "\n<|end|>\n"
    digest = 0
    for i, part in enumerate(parts, at):
        digest ^= xxhash.xxh64_intdigest(f"{i}:{part}".encode())
    return conv, at, len(lines), turns, right, digest - (1 << 64) if digest >> 63 else digest, "".join(parts)


def _batch(made: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.string() if i == 6 else pa.int64()) for i, x in enumerate(zip(*made, strict=True))], names=["conv_id", "start_line", "n_lines", "n_turns", "n_right", "digest", "rendered"])


def recovered(conversations: DataFrame, parts: int | None = None) -> DataFrame:
    """The pieces of all conversations (see ``parsed``), by the model learned from them."""
    rows = ordered(conversations, parts)
    return parsed(rows, *learn(rows))


def digests(pieces: DataFrame) -> DataFrame:
    """conv_id, n_lines, n_turns, n_right, rendered_xor: one row for each conversation."""
    return pieces.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("n_lines", "n_turns", "n_right")], F.bit_xor("digest").alias("rendered_xor"))
