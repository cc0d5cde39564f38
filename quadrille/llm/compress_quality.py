"""Quality classifier by compression.

Two zstandard dictionaries are trained, one from good and one from bad labelled text. A text is compressed
block by block with either; the difference of the two sizes over their sum says which kind it resembles, and a
logistic curve fitted on labelled texts that neither dictionary has seen turns that, with its weight of evidence
and the text's own compression ratio, into a probability.

Learning takes a bounded sample of labelled rows (``SAMPLE_ROWS`` a class, none above ``SAMPLE_BYTES``), the
first by a hash of doc_id; scoring covers every whole text.

Cases: a null or empty text has difference 0 and the score of the curve there; rows without text in either
table, null labels and null ids are no training rows; labels that disagree count as the lowest; without both
classes every score is the share of good labels, or 0.5 without any; repeated rows score alike.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_document, texts_of

#: Bound of the labelled sample: rows of each class, and bytes of a row.
SAMPLE_ROWS, SAMPLE_BYTES = 2000, 65536
#: Bytes compressed at once, of a dictionary, and the level.
BLOCK, DICTIONARY, LEVEL = 256, 112_640, 3
HELD_OUT = 2


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    shift: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        z = features(texts, self.good, self.bad) @ np.array(self.weights) if self.weights else np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(z + self.shift, -40, 40)))


@functools.lru_cache(4)
def _compressor(dictionary: bytes) -> zstd.ZstdCompressor:
    data = zstd.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstd.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False)


def blocks(text: bytes) -> list[bytes]:
    """The text in equal blocks of at most ``BLOCK`` bytes."""
    n = -(-len(text) // BLOCK)
    return [text[len(text) * i // n : len(text) * (i + 1) // n] for i in range(n)]


def features(texts: list[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """Three numbers a text, all from compressed sizes.

    The normalised difference (size by bad - size by good) / sum, above 0 for what the good dictionary shortens
    more; the same difference over the root of the sum, which grows with the evidence; and the logarithm of the
    ratio to which the text as a whole shrinks, low for text that repeats itself.
    """
    a, b = _compressor(good).compress, _compressor(bad).compress
    frame = len(a(b""))
    out = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        if text:
            parts = blocks(text)
            g, h = (sum(len(f(p)) - frame for p in parts) for f in (a, b))
            total = max(g + h, 0) + 1
            out[i] = (h - g) / total, (h - g) / math.sqrt(total), math.log((max(len(a(text)) - frame, 0) + 8) / (len(text) + 8))
    return out


def _dictionary(texts: list[bytes]) -> bytes:
    samples = [p for t in texts for p in blocks(t) if len(p) >= 8]
    try:
        return zstd.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstd.ZstdError:  # too little text to train from: the text itself serves
        return b"".join(samples)[-DICTIONARY:]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[tuple[float, ...], float]:
    """Weights and shift of the maximum-likelihood curve, by Newton's method on standardised x."""
    mean, sd = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / sd, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    slopes = w[:-1] / sd
    return tuple(map(float, slopes)), float(w[-1] - slopes @ mean)


def fit(texts: list[bytes], labels: list[int]) -> CompressionModel:
    """Three of five texts build the dictionaries, the others the curve."""
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        p = min(max((y.sum() + 0.5) / (len(y) + 1), 0.01), 0.99) if len(y) else 0.5
        return CompressionModel(b"", b"", (), float(np.log(p / (1 - p))))
    place = np.zeros(len(y), int)
    for c in (0, 1):
        place[y == c] = np.arange((y == c).sum())
    build = place % 5 < 3
    good, bad = (_dictionary([t for t, k, b in zip(texts, y, build, strict=True) if k == c and b]) for c in (1, 0))
    rest = ~build if len(set(y[~build])) == 2 else np.ones(len(y), bool)
    x = features([t for t, r in zip(texts, rest, strict=True) if r], good, bad)
    return CompressionModel(good, bad, *logistic(x, y[rest]))


def fold(doc_id, folds: int):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def training_rows(docs: DataFrame, labels: DataFrame) -> tuple[list[bytes], list[int]]:
    """The bounded sample, in the order of the hash."""
    known = labels.where("quality is not null and doc_id is not null").where(fold("doc_id", 4) != HELD_OUT).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picks = [known.where(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS) for c in (0, 1)]
    chosen = F.broadcast(picks[0].unionByName(picks[1]))  # at most 2 * SAMPLE_ROWS rows
    rows = texts_of(docs.where("text is not null").join(chosen, "doc_id"), "quality").where((F.length("text") > 0) & (F.length("text") <= SAMPLE_BYTES)).dropDuplicates(["doc_id"])
    got = sorted(rows.select(F.xxhash64("doc_id").alias("h"), "doc_id", "quality", "text").collect())
    return [bytes(r.text) for r in got], [int(r.quality) for r in got]


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = fit(*training_rows(docs, labels))

    def scored(texts: list[bytes]) -> list:
        s = model.score(texts)
        return [s, (s >= threshold).astype(np.int32)]

    out = per_document(texts_of(docs), scored, "score double, predicted int")
    return out.select("doc_id", F.coalesce(fold("doc_id", 4) == HELD_OUT, F.lit(False)).alias("held_out"), "score", "predicted")
