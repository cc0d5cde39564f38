"""What the parsers give: statements as plain tuples, in the order of the triples table."""

from __future__ import annotations

import re
from typing import NamedTuple
from urllib.parse import urljoin

from ..model import RDF, XSD

LANG_STRING = RDF + "langString"
_FORBIDDEN = re.compile(r'[\x00-\x20<>"{}|\\^`]').search


class ParseError(ValueError):
    """Text that its format doesn't allow."""


class Literal(NamedTuple):
    lex: str
    datatype: str = XSD + "string"
    lang: str | None = None


class Quoted(NamedTuple):
    """A statement as a term (RDF-star)."""

    s: object
    p: str
    o: object


class Statement(NamedTuple):
    subject: str
    predicate: str
    object: str
    isLiteral: bool
    literalType: str | None
    literalLang: str | None
    subjectSPO: list[str] | None
    graph: str | None
    ord: int


def text_of(term) -> str:
    if isinstance(term, Literal):
        return term.lex
    if isinstance(term, Quoted):
        return f"<< {text_of(term.s)} {term.p} {text_of(term.o)} >>"
    return term


def statement(s, p: str, o, graph: str | None, ord_: int) -> Statement:
    spo = [text_of(s.s), s.p, text_of(s.o)] if isinstance(s, Quoted) else None
    if isinstance(o, Literal):
        return Statement(text_of(s), p, o.lex, True, LANG_STRING if o.lang else o.datatype, o.lang, spo, graph, ord_)
    return Statement(text_of(s), p, text_of(o), False, None, None, spo, graph, ord_)


def resolve(base: str | None, iri: str) -> str:
    if not base or ":" in iri.split("/", 1)[0]:
        return iri
    if not iri:
        return base.split("#", 1)[0]
    if iri.startswith("#"):
        return base.split("#", 1)[0] + iri
    return urljoin(base, iri)


def check_iri(iri: str, strict: bool) -> str:
    """The IRI, if it has a scheme and no forbidden characters; otherwise an error, if ``strict``."""
    if strict and (":" not in iri or _FORBIDDEN(iri)):
        raise ParseError(f"not an IRI: <{iri}>")
    return iri
