"""What the operators share: reading, null handling, Arrow plumbing, checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` and ``bytes.strip()`` use the same six, so words are cut on UTF-8 bytes.
SPACE = b" \t\n\x0b\x0c\r"
#: Stands for a null doc_id where ids are ordered or joined; it sorts below every other id.
NULL_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, text as UTF-8 bytes, more...); a null text becomes empty, other columns go."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"), *more)


def per_document(docs: DataFrame, fn: Callable[[list[bytes]], list[list]], fields: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Rows of ``keep`` plus the columns that ``fn`` gives for the texts of an Arrow batch.

    ``fn`` takes the texts of one batch (UTF-8 bytes) and returns one list or array for each field of
    the DDL string ``fields``. A narrow transformation: no shuffle, state only inside a batch.
    """
    spark = docs.sparkSession
    extra = spark.createDataFrame([], fields).schema
    out = docs.select(*keep).schema
    for f in extra.fields:
        out = out.add(f.name, f.dataType, True)
    names = [f.name for f in out.fields]
    types = {f.name: _arrow(f.dataType.simpleString()) for f in extra.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            made = fn(b.column(text).to_pylist())
            cols = [b.column(c) for c in keep] + [pa.array(v, type=types[f.name]) for f, v in zip(extra.fields, made, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, out)


def _arrow(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}[kind]


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors see; a temporary one only in a local session without it."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as a checkpoint, with its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame) -> DataFrame:
    """As ``checkpointed``, but as Parquet, which takes less room for columns that compress.

    The optimizer starts anew on what is read; of a checkpoint it keeps the constraints inferred before, whose number
    explodes where a loop joins a table with itself.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrow(df: DataFrame, rows: int, each: int = 20_000) -> DataFrame:
    """``df`` in about as many partitions as so many rows need, at most those it has: small tables get few tasks."""
    return df.coalesce(max(4, min(partitions(df.sparkSession), -(-rows // each))))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many, which bounds what a task holds beside Spark's batch."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
