"""Line dedup over the whole corpus.

Every line's key is hashed to 128 bits. The rows (hash, document, position) are range-partitioned and
sorted, the document descending, so that a key's last holder comes first and a key that a third of all
documents hold is spread over many tasks. Each partition is streamed once: the first document of a key
keeps its lines, the others lose theirs if enough documents hold the key. What a partition cannot know of
its first and last key comes from the borders: two rows a partition, folded on the driver. The result is
not text but a compressed bitmap of the lines to keep for each document.

Cases: a null text is one empty line; a null doc_id stands below every other id; rows that share a doc_id
are one document for the counts and keep a bitmap for each text; keys under ``min_chars`` code points are
never dropped; an empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, SPACE, checkpointed, partitions, per_document, texts_of


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key, or None for a line that is too short to have one."""
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key


def _explode(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            hashes, counts, places = [], [], []
            for text in b.column("text").to_pylist():
                before = len(places)
                for i, line in enumerate(text.split(b"\n")):
                    if (key := line_key(line, min_chars)) is not None:
                        hashes.append(digest(key))
                        places.append(i)
                counts.append(len(places) - before)
            h = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            ids, fps = (np.repeat(b.column(c).to_numpy(), counts) for c in ("id", "fp"))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.ascontiguousarray(h[:, 0]), np.ascontiguousarray(h[:, 1]), ids, fps, np.array(places, np.int32))], names=["h1", "h2", "id", "fp", "pos"])

    return run


def _starts(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    return new


def _columns(b: pa.RecordBatch) -> list[np.ndarray]:
    return [b.column(c).to_numpy() for c in ("h1", "h2", "id", "fp", "pos")]


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last key of a partition: how many documents, from which to which."""
    first, now, part = None, None, 0
    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, ids, _, _ = _columns(b)
        part = b.column("part")[0].as_py()
        new = _starts(h1, h2)
        doc = new.copy()
        doc[1:] |= ids[1:] != ids[:-1]
        at = np.flatnonzero(new)
        ends = np.append(at[1:], len(h1))
        n = np.add.reduceat(doc.astype(np.int64), at)
        for k in sorted({0, len(at) - 1}):
            row = [int(h1[at[k]]), int(h2[at[k]]), int(n[k]), int(ids[at[k]]), int(ids[ends[k] - 1])]
            if now is not None and now[:2] == row[:2]:
                now = [*row[:2], now[2] + row[2] - (now[4] == row[3]), now[3], row[4]]
            else:
                if now is not None and first is None:
                    first = now
                now = row
    rows = [r for r in (first, now) if r is not None]
    yield pa.RecordBatch.from_pydict({k: pa.array([part if i < 0 else r[i] for r in rows], pa.int64()) for i, k in enumerate(("part", "h1", "h2", "n", "top", "low"), -1)})


def _drops(min_docs: int, shared: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, None  # rows of an undecided key; the key decided last, with its keeper
        for b in batches:
            if not b.num_rows:
                continue
            cols = _columns(b)
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            h1, h2, ids, fps, pos = cols
            new = _starts(h1, h2)
            doc = new.copy()
            doc[1:] |= ids[1:] != ids[:-1]
            at = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            n, keeper = np.add.reduceat(doc.astype(np.int64), at), ids[at]
            if known is not None and known[0] == (h1[0], h2[0]):
                n[0], keeper[0] = min_docs, known[1]
            for g in {0, len(at) - 1}:
                if (x := shared.get((int(h1[at[g]]), int(h2[at[g]])))) is not None:
                    n[g], keeper[g] = x
            last = at[-1]
            known, held = None, None
            if n[-1] >= min_docs:
                known = ((h1[last], h2[last]), keeper[-1])
                end = len(h1)
            else:
                held, end = [x[last:] for x in cols], last
            out = np.flatnonzero(((n[group] >= min_docs) & (ids != keeper[group]))[:end])
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (ids, fps, pos)], names=["id", "fp", "pos"])

    return run


def _fold(rows) -> dict:
    """Of each key at a border: the documents over all partitions, and the largest."""
    total: dict = {}
    for r in sorted(rows, key=lambda r: r.part):
        key = (r.h1, r.h2)
        n, top, low = total.get(key, (0, None, None))
        total[key] = (n + r.n - (low == r.top and n > 0), r.top if top is None else top, r.low)
    return {k: (n, top) for k, (n, top, _) in total.items()}


def _bitmap(drops: list[list[int]]) -> list[list]:
    out = []
    for places in drops:
        bits = np.zeros(-(-(max(places) + 1) // 8) * 8, bool)  # whole bytes: the bits past the last line say keep
        bits[places] = True
        out.append(zlib.compress(np.packbits(~bits).tobytes(), 6))
    return [out]


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(id, fp, n_dropped, keep) for every document that loses a line.

    ``id`` is doc_id with ``NULL_ID`` for null, ``fp`` the xxhash64 of the text, ``keep`` the zlib-packed bits of
    the lines to keep; lines beyond the last bit stay.
    """
    spark = docs.sparkSession
    keyed = texts_of(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), F.xxhash64("text").alias("fp"), "text")
    rows = keyed.mapInArrow(_explode(min_chars), "h1 long, h2 long, id long, fp long, pos int")
    order = ("h1", "h2", F.desc("id"), "fp", "pos")
    dealt = checkpointed(rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    shared = _fold(dealt.mapInArrow(_borders, "part long, h1 long, h2 long, n long, top long, low long").collect())
    drops = dealt.mapInArrow(_drops(min_docs, shared), "id long, fp long, pos int")
    lists = drops.groupBy("id", "fp").agg(F.collect_set("pos").alias("drops")).withColumn("n_dropped", F.size("drops").cast("long"))
    return per_document(lists, _bitmap, "keep binary", keep=("id", "fp", "n_dropped"), text="drops")


def kept_text(text: bytes, keep: bytes | None) -> bytes:
    """The text without the lines that the bitmap leaves out."""
    if keep is None:
        return text
    lines = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))
    return b"\n".join(x for i, x in enumerate(lines) if i >= len(bits) or bits[i])


def with_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with their n_dropped and keep (null where nothing is dropped)."""
    marks = keep_bitmaps(docs, min_chars, min_docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    left = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), "__fp": F.xxhash64(text)})
    marks = marks.select(F.col("id").alias("__id"), F.col("fp").alias("__fp"), F.col("n_dropped").alias("__dropped"), F.col("keep").alias("__keep"))
    return left.join(marks, ["__id", "__fp"], "left").drop("__id", "__fp")


def dedup_digest(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document: n_lines, n_dropped and the SHA-256 of what is left of its text."""
    joined = with_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs).withColumn("n_dropped", F.coalesce("__dropped", F.lit(0).cast("long")))
    joined = texts_of(joined, "n_dropped", F.col("__keep").alias("keep"))
    out = joined.select("doc_id", "n_dropped").schema.add("n_lines", "long").add("kept_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            sha = [hashlib.sha256(kept_text(t, k)).hexdigest() for t, k in zip(texts, b.column("keep").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_dropped"), pa.array([t.count(b"\n") + 1 for t in texts], pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_dropped", "n_lines", "kept_sha256"])

    return joined.mapInArrow(run, out).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def dedup_texts(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the dropped lines gone from their texts; the columns stay as they were, n_chars is counted anew."""
    joined = with_bitmaps(docs, min_chars, min_docs)
    schema = docs.schema
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {c: b.column(c) for c in names}
            texts = [None if t is None else t if k is None else kept_text(t.encode(), k).decode() for t, k in zip(cols["text"].to_pylist(), b.column("__keep").to_pylist(), strict=True)]
            cols["text"] = pa.array(texts, pa.string())
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([n if t is None else len(t) for n, t in zip(cols["n_chars"].to_pylist(), texts, strict=True)], cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=names)

    return joined.select(*names, "__keep").mapInArrow(run, schema)
