"""IRIs as column expressions: split, test, shorten, expand."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHORT = r"^(\w+)__(\w+)$"


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def namespace(iri) -> Column:
    """Up to the last ``#``, else the last ``/``, else the last ``:``; null without any of them."""
    c = _col(iri)
    return F.coalesce(*[F.nullif(F.regexp_extract(c, rf"^([\s\S]*{s})", 1), F.lit("")) for s in "#/:"])


def local_name(iri) -> Column:
    """What follows the namespace; null for what has none."""
    c = _col(iri)
    return F.substring(c, F.length(namespace(c)) + 1, F.length(c))


def is_iri(text) -> Column:
    """Whether a text is an absolute IRI: a scheme, a colon, no blanks or delimiters that IRIs leave out."""
    return F.coalesce(_col(text).rlike(r'^[A-Za-z][A-Za-z0-9+.\-]*:[^\s<>"{}|\\^`]*$'), F.lit(False))


def _prefix_map(prefixes: dict[str, str], turned: bool = False) -> Column:
    """A map literal of a catalogue's prefixes; an empty one is typed."""
    pairs = [x for p, n in sorted(prefixes.items()) for x in ((F.lit(n), F.lit(p)) if turned else (F.lit(p), F.lit(n)))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def shorten(iri, prefixes: dict[str, str], strict: bool = True) -> Column:
    """``prefix__local``; where the namespace has no prefix an error, or null if not ``strict``."""
    c = _col(iri)
    short = F.concat(F.try_element_at(_prefix_map(prefixes, True), namespace(c)), F.lit("__"), local_name(c))
    return F.when(c.isNull() | short.isNotNull() | F.lit(not strict), short).otherwise(F.raise_error(F.concat(F.lit("Prefix Undefined: No prefix defined for this namespace <"), namespace(c), F.lit("> "))))


def expand(short, prefixes: dict[str, str]) -> Column:
    """The IRI of ``prefix__local``; an error for another form or an unknown prefix."""
    c = _col(short)
    prefix, local = F.regexp_extract(c, SHORT, 1), F.regexp_extract(c, SHORT, 2)
    ns = F.try_element_at(_prefix_map(prefixes), prefix)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(~c.rlike(SHORT), F.raise_error(F.concat(F.lit("Wrong short form: "), c))).when(ns.isNull(), F.raise_error(F.concat(F.lit("Prefix Undefined: "), prefix))).otherwise(F.concat(ns, local))
