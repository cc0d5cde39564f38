"""Literals as column expressions: language tags, datatype suffixes, typing, points, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .iri import _col

XSD = "http://www.w3.org/2001/XMLSchema#"
WKT = "http://www.opengis.net/ont/geosparql#wktLiteral"
LANG_STRING = "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString"
#: Datatypes by the stored type they are read as (fixed values).
LONGS = ("integer", "long", "int", "short", "byte", "nonNegativeInteger", "positiveInteger", "nonPositiveInteger", "negativeInteger", "unsignedLong", "unsignedInt", "unsignedShort", "unsignedByte")
DOUBLES = ("decimal", "double", "float")
#: The datatype that a stored type is written as (fixed values).
WRITTEN = {"long": "long", "double": "double", "boolean": "boolean", "datetime": "dateTime", "localdatetime": "dateTime", "date": "date", "string": "string"}
LANG = r"^([\s\S]*)@([a-zA-Z\-]+)$"
TYPED = r"^([\s\S]*)\^\^([\s\S]+)$"
POINT = r"(?i)^\s*(?:<[^>]*>\s*)?POINT\s*Z?\s*\(\s*(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)\s+(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)(?:\s+(-?[0-9.]+(?:[eE][-+]?[0-9]+)?))?\s*\)\s*$"


def _part(c: Column, pattern: str, group: int) -> Column:
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def lang_tag(value) -> Column:
    return _part(_col(value), LANG, 2)


def has_lang_tag(lang: str, value) -> Column:
    return F.coalesce(lang_tag(value) == F.lit(lang), F.lit(False))


def value_of(value) -> Column:
    """The value without its ``@lang`` or ``^^datatype``."""
    c = _col(value)
    return F.coalesce(_part(c, TYPED, 1), _part(c, LANG, 1), c)


def lang_value(lang: str, value) -> Column:
    """The text of a value tagged with ``lang``; null for others."""
    c = _col(value)
    return F.when(has_lang_tag(lang, c), _part(c, LANG, 1))


def lang_value_of(lang: str, values) -> Column:
    """The first value of an array that has the tag."""
    return F.try_element_at(F.filter(F.transform(_col(values), lambda v: lang_value(lang, v)), lambda v: v.isNotNull()), F.lit(1))


def datatype(value) -> Column:
    """The suffix datatype of a string, else the type of a plain string."""
    c = _col(value)
    return F.when(c.isNotNull(), F.coalesce(_part(c, TYPED, 2), F.when(c.rlike(LANG), F.lit(LANG_STRING)), F.lit(XSD + "string")))


def datatype_of(stored_type) -> Column:
    """The datatype IRI that a stored type is written as; null for an unknown one."""
    c, out = _col(stored_type), F.lit(None).cast("string")
    for t, x in WRITTEN.items():
        out = F.when(c == t, F.lit(XSD + x)).otherwise(out)
    return F.when(c == "point", F.lit(WKT)).otherwise(out)


def stored_type(datatype_iri, lexical, lang=None) -> Column:
    """The type under which a literal is stored; a lexical form that its datatype doesn't allow is a string."""
    d, x = _col(datatype_iri), _col(lexical)
    name = F.when(d.startswith(XSD), F.substring(d, len(XSD) + 1, 100))
    return (
        F.when(name.isin(*LONGS) & x.try_cast("long").isNotNull(), "long")
        .when(name.isin(*DOUBLES) & x.try_cast("double").isNotNull(), "double")
        .when((name == "boolean") & F.trim(x).isin("true", "false", "1", "0"), "boolean")
        .when((name == "date") & parse_date(x).isNotNull(), "date")
        .when((name == "dateTime") & x.rlike(r"(?:[+-]\d{2}:\d{2}|Z)$") & parse_datetime(x).isNotNull(), "datetime")
        .when((name == "dateTime") & parse_datetime(x).isNotNull(), "localdatetime")
        .when((d == WKT) & x.rlike(POINT), "point")
        .otherwise("string")
    )


def canonical(stored, lexical) -> Column:
    """The lexical form of a stored value."""
    t, x = _col(stored), _col(lexical)
    return (
        F.when(t == "long", x.try_cast("long").cast("string"))
        .when(t == "double", x.try_cast("double").cast("string"))
        .when(t == "boolean", F.when(F.trim(x).isin("true", "1"), "true").otherwise("false"))
        .when(t == "point", point_text(x))
        .otherwise(x)
    )


def parse_datetime(text) -> Column:
    """A point in time from an ISO or XSD dateTime; without a zone it is taken as UTC; null otherwise."""
    c = F.trim(_col(text))
    return F.when(c.rlike(r"^-?\d{4,}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:\d{2})?(?:\[[^\]]+\])?$"), F.regexp_replace(c, r"\[[^\]]+\]$", "").try_cast("timestamp"))


def parse_date(text) -> Column:
    """A date from its ISO form, with or without a zone; null otherwise."""
    c = F.trim(_col(text))
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}(?:Z|[+-]\d{2}:\d{2})?$"), F.substring(c, 1, 10).try_cast("date"))


def point(text) -> Column:
    """(x, y, z) of a WKT point; null for other text; z is null in two dimensions."""
    c = _col(text)
    parts = [F.nullif(F.regexp_extract(c, POINT, i), F.lit("")).try_cast("double") for i in (1, 2, 3)]
    return F.when(c.rlike(POINT), F.struct(*[p.alias(n) for p, n in zip(parts, "xyz", strict=True)]))


def point_text(text) -> Column:
    p = point(text)
    return F.when(p.isNotNull(), F.concat(F.lit("Point("), F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"), p["z"].cast("string")), F.lit(")")))


def check(kind: str, stored, lexical) -> Column:
    """Whether a stored value is of a datatype: date, dateTime, time, duration, wktLiteral, anyURI; false for others."""
    from .iri import is_iri

    t, x = _col(stored), _col(lexical)
    tests = {
        "date": t == "date",
        "dateTime": t.isin("datetime", "localdatetime"),
        "time": x.rlike(r"^\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})?$"),
        "duration": x.rlike(r"^-?P(?=.)(?:\d+Y)?(?:\d+M)?(?:\d+D)?(?:T(?=.)(?:\d+H)?(?:\d+M)?(?:\d+(?:\.\d+)?S)?)?$"),
        "wktLiteral": t == "point",
        "anyURI": is_iri(x),
    }
    return F.coalesce(tests.get(kind, F.lit(False)), F.lit(False))
