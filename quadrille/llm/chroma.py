"""Chroma fingerprints of audio, and the alignment of recordings by them.

The samples' spectra are folded into twelve pitch classes a frame, smoothed over time and normalised. Over the
integral image of frames and classes, sixteen filters compare the sums of rectangles; each ratio is quantised
to two bits (Gray code), so that a frame becomes one 32-bit integer. Two recordings align at the offset that the
most equal integers vote for; the share of different bits over the overlap says whether they match.

Cases: null or short audio (under ``SPAN`` frames) has an empty fingerprint and matches nothing; equal
fingerprints are one class, compared once, and a class is named by its fingerprint's SHA-256; ids may repeat or be
null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, sliced

RATE, FRAME, HOP, SPAN = 4000, 512, 256, 8
#: Filters by rule: kind k mod 4 (above/below, before/after, both, middle), class and height from k.
FILTERS = [(k % 4, (5 * k) % 12, 2 + k % 3) for k in range(16)]
#: Limits of the logarithm of the ratio of two sums; two bits from three limits.
LIMITS = (-0.12, 0.0, 0.12)
GRAY = np.array([0, 1, 3, 2], np.uint32)
#: A match: at least so many votes and this share of the shorter recording, at most this share of bits wrong.
VOTES, OVERLAP, ERRORS = 3, 0.5, 0.2
QUERY_BLOCK = 512
#: Offsets of a query that a vote can tell apart, in frames; more than a recording has.
SHIFTS = 1 << 40


def _fold_matrix() -> np.ndarray:
    freq = np.fft.rfftfreq(FRAME, 1 / RATE)
    out = np.zeros((len(freq), 12))
    for i, f in enumerate(freq):
        if 60 <= f <= 1900:
            out[i, int(round(12 * np.log2(f / 440.0))) % 12] = 1
    return out


_FOLD, _WINDOW = _fold_matrix(), np.hanning(FRAME)


def chroma(samples: np.ndarray) -> np.ndarray:
    """Normalised pitch-class energies (frames, 12)."""
    n = 1 + (len(samples) - FRAME) // HOP
    if n < SPAN:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP] * _WINDOW
    energy = (np.abs(np.fft.rfft(frames, axis=1)) ** 2) @ _FOLD
    soft = np.cumsum(np.pad(energy, ((3, 2), (0, 0))), 0)
    soft = (soft[5:] - soft[:-5]) / 5
    norm = np.sqrt((soft**2).sum(1, keepdims=True))
    return np.where(norm > 1e-6, soft / np.maximum(norm, 1e-6), 0)


def fingerprint(samples: np.ndarray) -> np.ndarray:
    """One 32-bit integer for each frame that has ``SPAN`` frames from it on."""
    c = chroma(samples)
    if not len(c):
        return np.zeros(0, np.uint32)
    wrap = np.concatenate([c, c], 1)  # pitch classes are a circle
    image = np.zeros((len(c) + 1, 25))
    image[1:, 1:] = wrap.cumsum(0).cumsum(1)
    n = len(c) - SPAN + 1

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        """Sums over frames [i + t0, i + t1) and classes [p0, p1)."""
        a, b = image[t0 : t0 + n], image[t1 : t1 + n]
        return b[:, p1] - a[:, p1] - b[:, p0] + a[:, p0]

    out = np.zeros(n, np.uint32)
    half, third = SPAN // 2, SPAN // 4
    for kind, p, h in FILTERS:
        if kind == 0:
            x, y = area(0, SPAN, p, p + h), area(0, SPAN, p + h, p + 2 * h)
        elif kind == 1:
            x, y = area(0, half, p, p + h), area(half, SPAN, p, p + h)
        elif kind == 2:
            x = area(0, half, p, p + h) + area(half, SPAN, p + h, p + 2 * h)
            y = area(half, SPAN, p, p + h) + area(0, half, p + h, p + 2 * h)
        else:
            x = area(third, SPAN - third, p, p + h)
            y = area(0, third, p, p + h) + area(SPAN - third, SPAN, p, p + h)
        ratio = np.log((1 + np.maximum(x, 0)) / (1 + np.maximum(y, 0)))
        out = (out << np.uint32(2)) | GRAY[np.searchsorted(LIMITS, ratio)]
    return out


def align(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[int, int]:
    """(overlap in frames, different bits) of b laid on a so that b[0] meets a[offset]."""
    lo, hi = max(0, offset), min(len(a), offset + len(b))
    if hi <= lo:
        return 0, 0
    return hi - lo, int(np.bitwise_count(a[lo:hi] ^ b[lo - offset : hi - offset]).sum())


class QueryBlock:
    """Fingerprints of a bounded block of queries, indexed by integer."""

    def __init__(self, keys: list[int], prints: list[np.ndarray]):
        self.keys, self.prints = keys, prints
        sizes = [len(p) for p in prints]
        values = np.concatenate(prints) if prints else np.zeros(0, np.uint32)
        order = np.argsort(values, kind="stable")
        self.values, self.who = values[order], np.repeat(np.arange(len(prints)), sizes)[order]
        self.at = np.concatenate([np.arange(n) for n in sizes])[order] if prints else np.zeros(0, int)

    def matches(self, p: np.ndarray) -> list[tuple[int, int, float]]:
        """(key, offset, share of wrong bits) of the queries that p matches, at the offset with most votes that will do."""
        lo, hi = np.searchsorted(self.values, p, "left"), np.searchsorted(self.values, p, "right")
        n = hi - lo
        if not n.sum():
            return []
        hits = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        shift = self.at[hits] - np.repeat(np.arange(len(p)), n)
        key = self.who[hits].astype(np.int64) * SHIFTS + shift + SHIFTS // 2
        votes, count = np.unique(key, return_counts=True)
        out = []
        who = votes // SHIFTS
        for q in np.unique(who[count >= VOTES]):
            own = np.flatnonzero(who == q)
            own = own[count[own] >= VOTES]
            for best in own[np.argsort(-count[own], kind="stable")]:
                offset = int(votes[best] % SHIFTS) - SHIFTS // 2
                length, wrong = align(self.prints[q], p, offset)
                if length >= OVERLAP * min(len(p), len(self.prints[q])) and wrong <= ERRORS * 32 * length:
                    out.append((self.keys[q], offset, wrong / (32 * length)))
                    break
        return out


def fingerprints(audio: DataFrame, id_col: str, samples_of) -> DataFrame:
    """(id, print): ``samples_of`` turns the values of column ``audio`` of a batch into arrays of samples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 64):  # samples are some hundred times their fingerprint
            prints = [(fingerprint(s) if s is not None else np.zeros(0, np.uint32)).astype("<u4").tobytes() for s in samples_of(b.column("audio"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(prints, pa.binary())], names=["id", "print"])

    return audio.select(F.col(id_col).cast("long").alias("id"), "audio").mapInArrow(run, "id long, print binary")


def _matched(block: QueryBlock):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k, n, p in zip(*(b.column(c).to_pylist() for c in ("class", "copies", "print")), strict=True):
                rows += [(key, k, n, offset, wrong) for key, offset, wrong in block.matches(np.frombuffer(p, "<u4"))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["class", "match", "n_copies", "offset", "wrong"])

    return run


def _classed(prints: DataFrame) -> DataFrame:
    """(id, print, class): the class names the fingerprint; null for an empty one."""
    return checkpointed(prints.withColumn("class", F.when(F.length("print") > 0, F.sha2("print", 256))))


def _aligned(kept: DataFrame, every: int) -> DataFrame:
    asks = F.coalesce(F.col("id") % every == 0, F.lit(False))
    classes = checkpointed(kept.where("class is not null").groupBy("class").agg(F.first("print").alias("print"), F.count("*").alias("copies"), F.max(asks).alias("asked")))
    asked = classes.where("asked").select("class", "print", F.xxhash64("class").alias("h"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    found = None
    for i in range(blocks):
        part = asked.where(F.pmod("h", F.lit(blocks)) == i).collect()  # about QUERY_BLOCK rows
        block = QueryBlock([r["class"] for r in part], [np.frombuffer(bytes(r.print), "<u4") for r in part])
        # Computed at once, so that the driver holds the prints of one block only.
        met = checkpointed(classes.select("class", "copies", "print").mapInArrow(_matched(block), "class string, match string, n_copies long, offset long, wrong double"))
        found = met if found is None else found.unionByName(met)
    own = classes.where("asked and copies > 1").select("class", F.col("class").alias("match"), (F.col("copies") - 1).alias("n_copies"), F.lit(0).cast("long").alias("offset"), F.lit(0.0).alias("wrong"))
    found = checkpointed(found.where("class <> match").unionByName(own))
    totals = found.groupBy("class").agg(F.sum("n_copies").alias("n_matches"), F.sum(F.when(F.col("class") == F.col("match"), F.col("n_copies"))).alias("n_equal"))
    ask = kept.where(asks).select(F.col("id").alias("query"), (F.length("print") / 4).cast("long").alias("n_frames"), "class")
    out = ask.join(totals, "class", "left").join(found, "class", "left")
    return out.select("query", "n_frames", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_matches", "n_equal")], "class", "match", "n_copies", "offset", "wrong")


def aligned(prints: DataFrame, every: int = 50) -> DataFrame:
    """For each row whose id is divisible by ``every``: the recordings that match it (itself left out), over all rows.

    One row for each query and class of equal fingerprints that it matches: query, n_frames, n_matches, n_equal, class,
    match, n_copies, offset, wrong. Its own class is one of them where other rows share it; a query without a match has
    one row without ``match``. ``n_matches`` counts the recordings of all classes, ``n_equal`` those of its own. The
    queries go in blocks of ``QUERY_BLOCK``.
    """
    return _aligned(_classed(prints), every)


def aligned_with_members(prints: DataFrame, every: int = 50) -> DataFrame:
    """The rows of ``aligned`` with a null id, and one row (id, class) for every recording: who is in the classes."""
    kept = _classed(prints)
    return _aligned(kept, every).unionByName(kept.select("id", "class"), allowMissingColumns=True)


def melody(vector: list[float] | None) -> np.ndarray | None:
    """Samples that stand for a vector: one note of an eighth of a second for each two entries.

    The first entry of a pair chooses the pitch within two octaves, the second one the loudness.
    """
    if vector is None or len(vector) < 2:
        return None
    v = np.nan_to_num(np.array([x or 0.0 for x in vector], float))
    v = v[: len(v) // 2 * 2].reshape(-1, 2)
    scale = np.abs(v).max() or 1.0
    pitch = 220.0 * 2 ** (np.round((v[:, 0] / scale + 1) * 12) / 12)
    t = np.arange(RATE // 8) / RATE
    return ((0.3 + 0.7 * np.abs(v[:, 1:]) / scale) * np.sin(2 * np.pi * pitch[:, None] * t)).ravel()


def melodies(column: pa.Array) -> list[np.ndarray | None]:
    return [melody(v) for v in column.to_pylist()]
