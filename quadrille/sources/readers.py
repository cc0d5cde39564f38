"""RDF files and strings as triples DataFrames.

N-Triples and N-Quads are split by lines and parsed in SQL expressions. The other formats are parsed a file at a
time, in parallel over files; so are archives, whose entries are chosen after ``!`` in the path.
"""

from __future__ import annotations

import bz2
import gzip
import io
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ParserConfig
from ..model import TRIPLES, XSD
from .jsonld import JSONLDParser
from .rdfxml import RDFXMLParser
from .terms import LANG_STRING, ParseError, Statement
from .turtle import TurtleParser

FORMATS = ("RDF/XML", "JSON-LD", "Turtle", "N-Triples", "TriG", "N-Quads", "Turtle-star", "TriG-star")
QUAD_FORMATS = ("TriG", "N-Quads", "TriG-star")
BASE_IRI = "http://example.org/base/"


def need_format(name: str) -> str:
    if name not in FORMATS:
        raise ParseError(f"Unrecognized serialization format: {name}")
    return name


def parse_text(text: str, fmt: str, base: str | None = BASE_IRI, strict: bool = True) -> list[Statement]:
    """The statements of a document; pure Python."""
    need_format(fmt)
    if fmt == "RDF/XML":
        return RDFXMLParser(text, base, strict).parse()
    if fmt == "JSON-LD":
        return JSONLDParser(text, base, strict).parse()
    return TurtleParser(text, base, strict, fmt in QUAD_FORMATS).parse()


def inline(spark: SparkSession, text: str, fmt: str, config: ParserConfig | None = None) -> DataFrame:
    config = config or ParserConfig()
    return spark.createDataFrame([tuple(s) for s in parse_text(text, fmt, strict=config.verifyUriSyntax)], TRIPLES)


def unpacked(name: str, data: bytes, entry: str | None) -> bytes:
    """The bytes of a plain, compressed or archived file."""
    low = name.lower()
    if low.endswith(".zip"):
        if entry is None:
            raise ParseError("a zip archive needs an entry: path!entry")
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            return z.read(entry)
    if low.endswith((".tgz", ".tar.gz", ".tar.bz2", ".tar")):
        with tarfile.open(fileobj=io.BytesIO(data)) as t:
            member = entry or next(m.name for m in t.getmembers() if m.isfile())
            return t.extractfile(member).read()
    if low.endswith(".gz"):
        return gzip.decompress(data)
    return bz2.decompress(data) if low.endswith(".bz2") else data


def read(spark: SparkSession, path: str, fmt: str, config: ParserConfig | None = None) -> DataFrame:
    """Triples of the files at ``path`` (``archive!entry`` for one of an archive), with ord unique and rising in each file."""
    config = config or ParserConfig()
    need_format(fmt)
    path, _, entry = path.partition("!")
    if fmt in ("N-Triples", "N-Quads") and not path.lower().endswith((".zip", ".tgz", ".tar", ".tar.gz", ".tar.bz2")):
        lines = spark.read.text(path)
        # The blank nodes of one file keep their labels; those of several are told apart by the file's name.
        several = len(lines.inputFiles()) > 1
        return _lines(lines.select("value", F.hex(F.xxhash64("_metadata.file_path")).alias("file")) if several else lines, config)
    strict, inner = config.verifyUriSyntax, entry or None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, data, at in zip(b["path"], b["content"], b["file"], strict=True):
                made = parse_text(unpacked(name, bytes(data), inner).decode("utf-8"), fmt, strict=strict)
                # Blank nodes are a file's own.
                tag = lambda t, at=at: f"_:f{at}x{t[2:]}" if isinstance(t, str) and t.startswith("_:") else t
                rows = [s._replace(subject=tag(s.subject), object=s.object if s.isLiteral else tag(s.object), ord=(at << 40) + s.ord) for s in made]
                yield pd.DataFrame(rows, columns=Statement._fields)

    files = spark.read.format("binaryFile").load(path)
    names = sorted(r.path for r in files.select("path").collect())  # the names of the files, which the driver lists anyway
    numbers = spark.createDataFrame(list(enumerate(names)), "file long, path string")
    return files.select("path", "content").join(numbers, "path").select("path", "content", "file").mapInPandas(run, TRIPLES)


_IRI, _BNODE = r"<([^<>\s]*)>", r"(_:[^\s<>\"]+)"
_LINE = rf'^\s*(?:{_IRI}|{_BNODE})\s*{_IRI}\s*(?:{_IRI}|{_BNODE}|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z]+(?:-[A-Za-z0-9]+)*)|\^\^{_IRI})?)\s*(?:{_IRI}|{_BNODE})?\s*\.\s*(?:#.*)?$'


def _unescaped(c):
    """N-Triples escapes undone. What has any is made a JSON string and read by ``from_json``; it fails if that can't.

    Eight-digit escapes become the four-digit ones of JSON, beyond U+FFFF as a surrogate pair.
    """
    plain = F.when(~c.contains("\\"), c)
    # An escaped backslash goes first, so that no letter after it is taken for its escape.
    safe = F.regexp_replace(c, r"\\\\", r"\\u005c")

    def narrow(h):
        above = F.conv(h, 16, 10).cast("int") - 0x10000
        four = lambda x: F.concat(F.lit("\\u"), F.lpad(F.hex(x), 4, "0"))
        pair = F.concat(four(F.lit(0xD800) + F.shiftright(above, 10)), four(F.lit(0xDC00) + above.bitwiseAND(0x3FF)))
        return F.when(above < 0, F.concat(F.lit("\\u"), F.substring(h, 5, 4))).otherwise(pair)

    wide = F.array_distinct(F.regexp_extract_all(safe, F.lit(r"\\U([0-9A-Fa-f]{8})"), F.lit(1)))
    short = F.aggregate(wide, safe, lambda acc, h: F.replace(acc, F.concat(F.lit("\\U"), h), narrow(h)))
    read = F.from_json(F.concat(F.lit('{"v":"'), F.regexp_replace(short, r"\\'", "'"), F.lit('"}')), "v string", {"allowUnquotedControlChars": "true"})["v"]
    return F.coalesce(plain, read, F.raise_error(F.concat(F.lit("not an N-Triples string: "), c)).cast("string"))


def _lines(lines: DataFrame, config: ParserConfig) -> DataFrame:
    g = lambda i: F.nullif(F.regexp_extract("value", _LINE, i), F.lit(""))
    rows = lines.where(~F.col("value").rlike(r"^\s*(?:#.*)?$")).withColumn("ord", F.monotonically_increasing_id())
    ok = F.col("value").rlike(_LINE)
    bad = F.raise_error(F.concat(F.lit("not a statement: "), F.col("value")))
    rows = rows.where(ok) if not config.abortOnError else rows.where(F.when(ok, True).otherwise(bad.cast("boolean")))
    # Blank nodes are a file's own.
    blank = (lambda i: F.concat(F.lit("_:f"), F.col("file"), F.lit("x"), F.substring(g(i), 3, 1 << 20))) if "file" in lines.columns else g
    obj = F.coalesce(g(4), blank(5))
    out = rows.select(
        F.coalesce(g(1), blank(2)).alias("subject"), g(3).alias("predicate"),
        F.coalesce(obj, _unescaped(F.regexp_extract("value", _LINE, 6))).alias("object"), obj.isNull().alias("isLiteral"),
        F.when(obj.isNull(), F.coalesce(g(8), F.when(g(7).isNotNull(), F.lit(LANG_STRING)), F.lit(XSD + "string"))).alias("literalType"),
        g(7).alias("literalLang"), F.lit(None).cast("array<string>").alias("subjectSPO"), F.coalesce(g(9), blank(10)).alias("graph"), "ord",
    )
    if config.verifyUriSyntax:
        wrong = ~F.col("predicate").contains(":")
        out = out.where(F.when(~wrong, True).otherwise(F.raise_error(F.concat(F.lit("not an IRI: "), F.col("predicate"))).cast("boolean")))
    return out


def stream(triples: DataFrame, config: ParserConfig | None = None) -> DataFrame:
    """The first ``limit`` statements, without excluded predicates."""
    config = config or ParserConfig()
    kept = triples.where(~F.col("predicate").isin(list(config.predicateExclusionList))) if config.predicateExclusionList else triples
    return kept.orderBy("ord").limit(config.limit).drop("graph", "ord")
