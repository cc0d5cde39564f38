"""Aggregates that write a group of triples as one text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..sources.writers import Document, line

#: Characters of the terms that one of a group's documents holds, about.
PART_CHARS = 1_000_000
COLUMNS = ("subject", "predicate", "object", "isLiteral", "literalType", "literalLang", "subjectSPO")
NAMES = {"nt": "N-Triples", "ttl": "Turtle", "xml": "RDF/XML", "json": "JSON-LD", "ttlstar": "Turtle-star"}


def collect_nt(triples: DataFrame, *keys: str) -> DataFrame:
    """keys and the group's distinct statements as N-Triples, in order; JVM-side, combined before the shuffle."""
    text = F.array_join(F.sort_array(F.collect_set(line())), "\n")
    return triples.groupBy(*keys).agg(F.when(text == "", "").otherwise(F.concat(text, F.lit("\n"))).alias("rdf"))


def collect(triples: DataFrame, fmt: str, *keys: str, prefixes: dict[str, str] | None = None) -> DataFrame:
    """keys and the group as a document; fmt is nt, ttl, xml, json or ttlstar. A document is made in one task, so a group must fit one; ``collect_parts`` is for larger ones."""
    name = NAMES[fmt]
    if name == "N-Triples":
        return collect_nt(triples, *keys)
    schema = triples.select(*keys).schema.add("rdf", "string")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf[list(COLUMNS)].astype(object).where(pdf[list(COLUMNS)].notna(), None).to_dict("records")
        rows = [r | {"subjectSPO": None if r["subjectSPO"] is None else list(r["subjectSPO"])} for r in rows]
        first = {k: [pdf[k].iloc[0]] for k in keys}
        return pd.DataFrame(first | {"rdf": [Document(rows, prefixes).write(name)]})

    return triples.select(*dict.fromkeys([*keys, *COLUMNS])).groupBy(*keys).applyInPandas(write, schema)


def collect_parts(triples: DataFrame, fmt: str, *keys: str, prefixes: dict[str, str] | None = None, then: Callable[[tuple, str], list[tuple]] | None = None, schema: str | None = None) -> DataFrame:
    """keys and the group as several documents of about ``PART_CHARS``, which hold each distinct statement once; for groups of any size.

    Those in Turtle, Turtle-star and N-Triples make one document of the group if joined end to end. With ``then``, each
    document's (values of keys, text) go to it where the document was made, and the rows that it gives, of the DDL string
    ``schema``, take the documents' place.

    The statements are dealt by key and subject and sorted, and a task holds those of one document at a time.
    """
    name = NAMES[fmt]
    # Who is spoken about by statements of statements is in subjectSPO; the same as text would only be moved.
    made = triples.select(*keys, *(F.when(F.col("subjectSPO").isNull(), F.col(c)).alias(c) if c == "subject" else F.col(c) for c in COLUMNS))
    inner = made.repartition(*keys, "subject", "subjectSPO").sortWithinPartitions(*keys, "subject", "subjectSPO", *COLUMNS[1:-1])
    out = triples.select(*keys).schema.add("rdf", "string") if then is None else StructType.fromDDL(schema)
    types = to_arrow_schema(out)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, str]]:
        held, key, last, size = [], None, None, 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row == last:
                    continue
                last, k = row, row[: len(keys)]
                if held and (k != key or size >= PART_CHARS):
                    yield key, Document(held, prefixes).write(name)
                    held, size = [], 0
                key = k
                held.append(dict(zip(COLUMNS, row[len(keys) :], strict=True)))
                size += sum(len(x) for x in row[len(keys) :] if x.__class__ is str) + sum(map(len, row[-1] or ()))
        if held:
            yield key, Document(held, prefixes).write(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, text in documents(batches):
            rows = [(*key, text)] if then is None else then(key, text)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), types, strict=True)], names=types.names)

    return inner.mapInArrow(run, out)
