"""Secret scan in DataFrame functions only: base patterns, and windows of high entropy.

Where a pattern matches is found from what lies between the matches: ``split`` gives the pieces and
``regexp_extract_all`` the matches, and the running sum of their lengths the places, in code points.

The candidates of the method are runs of token characters. Parts of a path that look like words, and segments that
are a placeholder's word, are left out of what is measured; runs of one case or without a digit are measured without
their wordlike segments and against classes of their own. A window slides over each;
its counts by character are kept in an array, one step adds a character and takes one away, and with them
changes the sum of c * log2(c) that fixes the Shannon entropy. A window of the class's size and entropy makes
the candidate a span, unless the allow-list knows it or a base span overlaps it.

Cases: a null or empty text has no spans; a candidate shorter than the window of its class is no span; equal
starts are ordered by kind as listed in ``KINDS``; repeated rows and null ids are kept; other columns go.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: The base patterns: kind, pattern, group to measure, least length of that group.
BASE = (
    ("assign", "(" + _either_case("password|passwd|secret|token|api_?key") + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
)
#: Candidates: a whole run of at least 20 token characters.
CANDIDATE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
#: By character class: what the whole candidate must match, the alphabet, the window, the least bits a character.
CLASSES = (
    ("hex", "^[0-9a-fA-F]+$", "0123456789abcdefABCDEF", 20, 3.0),
    ("base64", "^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 20, 3.6),
)
#: Candidates that are no secrets: plain numbers, UUIDs, runs of the alphabet, placeholders, paths and dates.
ALLOWED = (
    "^[0-9_=/+-]+$",
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "(?i)abcdefgh|12345678|example|sample|placeholder|changeme|dummy|redacted|xxxx",
    "^/?[A-Za-z0-9_-]*(/[A-Za-z0-9_-]*){2,}$",
    "^[A-Za-z]+([-_=][A-Za-z]+)*[-_=]?[0-9]{1,4}$",
)
#: As CLASSES, for what those leave out, by what it holds; the SQL knows only CLASSES.
MORE_CLASSES = (
    ("base36", "^(?=.*[a-z])(?=.*[0-9])[^A-Z]+$", "abcdefghijklmnopqrstuvwxyz0123456789+/_=-", 20, 3.6),
    ("base32", "^(?=.*[A-Z])(?=.*[0-9])[^a-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-", 20, 3.6),
    ("one case", "^(?:[^0-9A-Z]+|[^0-9a-z]+)$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-", 20, 3.6),
    ("letters", "^[^0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-", 20, 3.75),
)
NUMBERS, UUID, PLACEHOLDER, PATH, NAMED = ALLOWED
#: A word or a short number: lower case, capitals, or humps of both, at most 16 letters each, with up to four digits.
_WORD = "(?:[A-Z]?[a-z]{2,16}(?:[A-Z][a-z]{1,15})*|[A-Z]{2,16}|[A-Za-z])?[0-9]{0,4}"
#: Parts of a path that look like words, with their slash; the same for segments between any separators.
WORDLIKE_PART = f"(?<![^/]){_WORD}(?:[_-]{_WORD})*(?:/|$)"
WORDLIKE_SEGMENT = f"(?<![^/_=+-]){_WORD}(?:[/_=+-]|$)"
#: Segments that are a placeholder's word and nothing else.
PLACEHOLDER_SEGMENT = "(?i)(?<![^/_=-])(?:abcdefgh|12345678|example|sample|placeholder|changeme|dummy|redacted|x{4,})(?:[/_=-]|$)"
#: c * log2(c) is kept in millionths, so that counts alone decide.
MILLION = 1_000_000


def scaled(c: int) -> int:
    return round(c * math.log2(c) * MILLION) if c > 1 else 0


def most_allowed(window: int, bits: float) -> int:
    """The largest sum of c * log2(c) at which a window still has the entropy."""
    return round(window * (math.log2(window) - bits) * MILLION)


def _placed(text: Column, pattern: str, group: int) -> Column:
    """(start, end, what) of the matches in order; null where there is none."""
    lit = F.lit(pattern)
    gaps, found, measured = F.split(text, pattern, -1), F.regexp_extract_all(text, lit, F.lit(0)), F.regexp_extract_all(text, lit, F.lit(group))
    zipped = F.arrays_zip(gaps.alias("gap"), found.alias("found"), measured.alias("what"))
    start = F.struct(F.lit(0).cast("int").alias("at"), F.expr("cast(array() as array<struct<start:int,end:int,what:string>>)").alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        begin = acc["at"] + F.length(m["gap"])
        end = begin + F.coalesce(F.length(m["found"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), m["what"].alias("what"))
        return F.struct(end.alias("at"), F.when(m["found"].isNull(), acc["spans"]).otherwise(F.array_append(acc["spans"], span)).alias("spans"))

    return F.when(text.rlike(pattern), F.aggregate(zipped, start, step, lambda acc: acc["spans"]))


def lowest_sum(token: Column, alphabet: str, window: int) -> Column:
    """The least sum of c * log2(c), in millionths, of any window of a token; null where none fits."""
    gain = F.lit([scaled(c + 1) - scaled(c) for c in range(window + 1)])
    zero = F.array_repeat(F.lit(0), len(alphabet) + 1)
    start = F.struct(zero.alias("counts"), F.lit(0).cast("long").alias("total"), F.lit(None).cast("long").alias("least"))

    def place(i: Column) -> Column:
        return F.instr(F.lit(alphabet), F.substring(token, i, F.lit(1)))

    def step(acc: Column, i: Column) -> Column:
        come, gone = place(i), F.when(i > window, place(i - window)).otherwise(F.lit(-1))
        left = F.when(gone < 0, acc["counts"]).otherwise(F.transform(acc["counts"], lambda c, j: c - F.when(j == gone, 1).otherwise(0)))
        less = F.when(gone < 0, F.lit(0)).otherwise(F.element_at(gain, F.element_at(left, gone + 1) + 1))
        more = F.element_at(gain, F.element_at(left, come + 1) + 1)
        total = acc["total"] - less + more
        return F.struct(
            F.transform(left, lambda c, j: c + F.when(j == come, 1).otherwise(0)).alias("counts"),
            total.cast("long").alias("total"),
            F.when(i >= window, F.least(acc["least"], total)).otherwise(acc["least"]).cast("long").alias("least"),
        )

    return F.when(F.length(token) >= window, F.aggregate(F.sequence(F.lit(1), F.length(token)), start, step, lambda acc: acc["least"]))


def measured(token: Column) -> Column:
    """What of a candidate can be a secret, or null: not the placeholders' segments, and of a path not the wordlike parts."""
    bare = F.regexp_replace(token, PLACEHOLDER_SEGMENT, "")
    value = F.regexp_replace(bare, "^.*=(?=[^=])", "")
    left = F.when(~token.rlike(PLACEHOLDER), token).when(~bare.rlike(PLACEHOLDER), bare).when(~value.rlike(PLACEHOLDER), value)
    return F.when(left.rlike(PATH), F.regexp_replace(left, WORDLIKE_PART, "")).otherwise(left)


def _reaches(token: Column, alphabet: str, window: int, bits: float) -> Column:
    return F.coalesce(lowest_sum(token, alphabet, window) <= most_allowed(window, bits), F.lit(False))


def is_secret(token: Column, unworded: Column) -> Column:
    """Whether what is measured of a candidate has a window of its class's entropy and no entry in the allow-list.

    ``unworded`` is the same without its wordlike segments. Plain words with a number go to the further classes.
    """
    found = F.lit(False)
    for _, shape, alphabet, window, bits in reversed(MORE_CLASSES):
        found = F.when(unworded.rlike(shape), _reaches(unworded, alphabet, window, bits)).otherwise(found)
    letters = MORE_CLASSES[-1][2:]
    found = F.when(token.rlike(NAMED), _reaches(unworded, *letters)).otherwise(found)
    for _, shape, alphabet, window, bits in reversed(CLASSES):
        found = F.when(token.rlike(shape) & token.rlike("[0-9]") & ~token.rlike(NAMED), _reaches(token, alphabet, window, bits)).otherwise(found)
    return F.when(token.isNull() | token.rlike(NUMBERS) | token.rlike(UUID), False).otherwise(found)


def _long_enough(least: int):
    return lambda s: F.length(s["what"]) >= least


def _kinded(spans: Column, kind: str) -> Column:
    empty = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string>>)")
    made = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))
    return F.coalesce(made, empty)


def _said(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with __base and __spans, each an array of (start, rank, end, kind) in order of start and kind."""
    out = docs.withColumn("__text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    for kind, pattern, group, least in BASE:
        out = out.withColumn(f"__{kind}", _placed(F.col("__text"), pattern, group))
        out = out.withColumn(f"__{kind}", _kinded(F.filter(f"__{kind}", _long_enough(least)), kind))
    out = out.withColumn("__base", F.array_sort(F.concat("__assign", "__access", "__hex")))
    out = out.withColumn("__candidates", _placed(F.col("__text"), CANDIDATE, 0))
    clear = lambda s: ~F.exists("__base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    # each step is a value of the next array: inside the window's loop an expression would be computed for every character
    part = F.transform(F.filter("__candidates", clear), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), measured(s["what"]).alias("token")))
    part = F.transform(part, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["token"].alias("token"), F.regexp_replace(s["token"], WORDLIKE_SEGMENT, "").alias("unworded")))
    out = out.withColumn("__entropy", _kinded(F.filter(part, lambda s: is_secret(s["token"], s["unworded"])), "entropy"))
    return out.withColumn("__spans", F.array_sort(F.concat("__base", "__entropy"))).drop("__text", "__candidates")


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, the counts by kind, the digest of the base spans and all spans. No shuffle, no Python on the executors."""
    found = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return found.select(
        "doc_id",
        *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_said(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
        _said(F.col("__spans")).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark``, overlapping spans by one; n_chars is counted anew."""
    text, start = F.col("text"), F.struct(F.lit(0).cast("int").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        grown = F.struct(s["end"].alias("at"), F.concat(acc["out"], before, F.lit(mark)).alias("out"))
        return F.when(s["end"] <= acc["at"], acc).when(s["start"] < acc["at"], F.struct(s["end"].alias("at"), acc["out"].alias("out"))).otherwise(grown)

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))

    found = with_spans(docs)
    clean = F.when(F.size("__spans") > 0, F.aggregate("__spans", start, step, finish)).otherwise(text)
    out = found.withColumn("__clean", clean)
    cols = [F.col("__clean").alias(c) if c == "text" else F.when(F.size("__spans") > 0, F.length("__clean")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return out.select(*cols)
