"""Turtle, TriG, N-Triples and N-Quads with RDF-star, by recursive descent over one token pattern."""

from __future__ import annotations

import re

from ..model import RDF, XSD
from .terms import Literal, ParseError, Quoted, Statement, check_iri, resolve, statement

_TOKEN = re.compile(
    r"""\s*+(?:\#[^\n\r]*
    |(?P<long>\"\"\"(?:(?:\"|\"\")?(?:[^\"\\]|\\.))*\"\"\"|'''(?:(?:'|'')?(?:[^'\\]|\\.))*''')
    |(?P<string>\"(?:[^\"\\\n\r]|\\.)*\"|'(?:[^'\\\n\r]|\\.)*')
    |(?P<quote><<|>>)
    |(?P<iri><[^<>\n\r]*>)
    |(?P<dtype>\^\^)
    |(?P<word>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<number>[+-]?(?:\d+\.\d*[eE][+-]?\d+|\.?\d+[eE][+-]?\d+|\d*\.\d+|\d+)(?![\w:]))
    |(?P<bnode>_:[\w](?:[\w.\-\u00b7]*[\w\-\u00b7])?)
    |(?P<name>(?:[^\W\d_](?:[\w.\-\u00b7]*[\w\-\u00b7])?)?:(?:(?:[\w:]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%])(?:(?:[\w.\-\u00b7:]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%])*(?:[\w\-\u00b7:]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%]))?)?)
    |(?P<key>[A-Za-z]+)
    |(?P<mark>[.;,\[\](){}])
    |\Z)""",
    re.VERBOSE | re.DOTALL,
)
_SPACE = re.compile(r"\s*")
#: IRIs that a parser keeps by their tokens; beyond that it starts anew.
KNOWN = 20_000
_ESCAPE = re.compile(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", re.DOTALL)
_PLAIN = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}


def unescape(text: str) -> str:
    def one(m: re.Match) -> str:
        x = m[1]
        return chr(int(x[1:], 16)) if x[0] in "uU" and len(x) > 1 else _PLAIN.get(x, x)

    return _ESCAPE.sub(one, text) if "\\" in text else text


class TurtleParser:
    """Statements of a document. ``strict`` refuses malformed IRIs; ``graphs`` allows TriG blocks and a fourth term."""

    def __init__(self, text: str, base: str | None = None, strict: bool = True, graphs: bool = True):
        self.text, self.base, self.strict, self.graphs = text, base, strict, graphs
        self.prefixes: dict[str, str] = {}
        self.known: dict[str, str] = {}
        self.out: list[Statement] = []
        self.graph: str | None = None
        self.fresh = 0
        self.tokens = self._tokens()
        self.kind, self.value = "", ""
        self.advance()

    def _tokens(self):
        at, end, match = 0, len(self.text), _TOKEN.match
        while at < end:
            m = match(self.text, at)
            if m is None:
                at = _SPACE.match(self.text, at).end()
                raise ParseError(f"unexpected text at {at}: {self.text[at : at + 30]!r}")
            at, kind = m.end(), m.lastgroup
            if kind:
                yield kind, m[kind]
        while True:
            yield "end", ""

    def advance(self) -> tuple[str, str]:
        now = self.kind, self.value
        self.kind, self.value = next(self.tokens)
        return now

    def want(self, mark: str) -> None:
        if self.value != mark:
            raise ParseError(f"expected {mark!r}, found {self.value!r}")
        self.advance()

    def blank(self) -> str:
        self.fresh += 1
        return f"_:genid{self.fresh}"

    def add(self, s, p, o, graph=None) -> None:
        self.out.append(statement(s, p, o, graph or self.graph, len(self.out)))

    def parse(self) -> list[Statement]:
        while self.kind != "end":
            word = self.value.lower().lstrip("@")
            if self.kind in ("word", "key") and word in ("prefix", "base"):
                self.directive(word, self.kind == "word")
            elif self.value == "{" or (self.kind == "key" and word == "graph"):
                if word == "graph":
                    self.advance()
                self.block(None if self.value == "{" else self.term())
            else:
                self.triples_or_block()
        return self.out

    def directive(self, word: str, dotted: bool) -> None:
        self.advance()
        if word == "prefix":
            name = self.advance()[1]
            if not name.endswith(":"):
                raise ParseError(f"not a prefix: {name!r}")
            self.prefixes[name[:-1]] = self.iri(self.advance()[1])
        else:
            self.base = self.iri(self.advance()[1])
        self.known.clear()
        if dotted:
            self.want(".")

    def iri(self, token: str) -> str:
        if not token.startswith("<"):
            raise ParseError(f"expected an IRI, found {token!r}")
        return check_iri(resolve(self.base, unescape(token[1:-1])), self.strict)

    def full(self, name: str) -> str:
        prefix, local = name.split(":", 1)
        if prefix not in self.prefixes:
            raise ParseError(f"undefined prefix {prefix!r}")
        return check_iri(self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local), self.strict)

    def block(self, name) -> None:
        if not self.graphs:
            raise ParseError("named graphs aren't allowed here")
        self.want("{")
        self.graph = name
        while self.value != "}":
            self.triples()
            if self.value == ".":
                self.advance()
        self.advance()
        self.graph = None

    def triples_or_block(self) -> None:
        opened = self.value in ("[", "(")
        s = self.term()
        if self.value == "{":
            return self.block(s)
        if not (opened and self.value == "."):
            self.predicates(s)
            if self.kind in ("iri", "bnode", "name") and self.graphs and self.out:  # the fourth term of N-Quads
                last = self.out[-1]
                self.out[-1] = last._replace(graph=self.term())
        self.want(".")
        return None

    def triples(self) -> None:
        opened = self.value in ("[", "(")
        s = self.term()
        if not (opened and self.value in (".", "}")):
            self.predicates(s)

    def predicates(self, s) -> None:
        while True:
            p = RDF + "type" if self.kind == "key" and self.value == "a" else None
            p = p if p is not None and self.advance() else self.term()
            if not isinstance(p, str) or p.startswith("_:"):
                raise ParseError(f"not a predicate: {p!r}")
            while True:
                self.add(s, p, self.term())
                if self.value != ",":
                    break
                self.advance()
            if self.value != ";":
                return
            while self.value == ";":
                self.advance()
            if self.value in (".", "]", "}") or self.kind == "end":
                return

    def term(self):
        kind, value = self.advance()
        if kind == "iri" or kind == "name":
            found = self.known.get(value)
            if found is None:
                if len(self.known) >= KNOWN:
                    self.known.clear()
                found = self.known[value] = self.iri(value) if kind == "iri" else self.full(value)
            return found
        if kind == "bnode":
            return value
        if kind in ("string", "long"):
            lex = unescape(value[3:-3] if kind == "long" else value[1:-1])
            if self.kind == "word":
                return Literal(lex, RDF + "langString", self.advance()[1][1:])
            if self.kind == "dtype":
                self.advance()
                return Literal(lex, self.term())
            return Literal(lex)
        if kind == "number":
            return Literal(value, XSD + ("double" if "e" in value.lower() else "decimal" if "." in value else "integer"))
        if kind == "key" and value in ("true", "false"):
            return Literal(value, XSD + "boolean")
        if value == "[":
            node = self.blank()
            if self.value != "]":
                self.predicates(node)
            self.want("]")
            return node
        if value == "(":
            return self.collection()
        if value == "<<":
            s, p, o = self.term(), self.term(), self.term()
            self.want(">>")
            return Quoted(s, p, o)
        raise ParseError(f"unexpected {value!r}")

    def collection(self):
        items = []
        while self.value != ")":
            items.append(self.term())
        self.advance()
        head = RDF + "nil"
        cells = [self.blank() for _ in items]
        for i, (cell, item) in enumerate(zip(cells, items, strict=True)):
            self.add(cell, RDF + "first", item)
            self.add(cell, RDF + "rest", cells[i + 1] if i + 1 < len(cells) else head)
        return cells[0] if cells else head
