"""JSON-LD with in-line contexts, and plain JSON trees."""

from __future__ import annotations

import json

from ..model import RDF, XSD
from .terms import Literal, ParseError, Statement, check_iri, resolve, statement

VOCAB = "graph://voc#"


class JSONLDParser:
    def __init__(self, text: str, base: str | None = None, strict: bool = True):
        self.base, self.strict, self.fresh, self.out = base, strict, 0, []
        try:
            self.doc = json.loads(text)
        except ValueError as e:
            raise ParseError(str(e)) from e

    def parse(self) -> list[Statement]:
        for x in self.doc if isinstance(self.doc, list) else [self.doc]:
            self.top(x, {}, None)
        return self.out

    def blank(self) -> str:
        self.fresh += 1
        return f"_:genid{self.fresh}"

    def context(self, ctx: dict, new) -> dict:
        for c in new if isinstance(new, list) else [new]:
            if c is None:
                ctx = {}
            elif isinstance(c, dict):
                ctx = ctx | c
            else:
                raise ParseError(f"remote context {c!r}")
        return ctx

    def expand(self, ctx: dict, name: str, vocab: bool) -> str | None:
        """The IRI of a term, compact IRI or reference; null for a term that stands for nothing."""
        if name.startswith(("_:", "@")):
            return name
        if vocab and name in ctx:
            d = ctx[name]
            target = d.get("@id", name) if isinstance(d, dict) else d
            if target is None:
                return None
            return target if target == name and ":" in name else self.expand({k: v for k, v in ctx.items() if k != name}, target, True)
        prefix, colon, rest = name.partition(":")
        if colon and not rest.startswith("//") and prefix in ctx:
            d = ctx[prefix]
            return (self.expand(ctx, d["@id"] if isinstance(d, dict) else d, True) or "") + rest
        if colon:
            return name
        if vocab:
            return ctx["@vocab"] + name if ctx.get("@vocab") else None
        return resolve(ctx.get("@base", self.base), name)

    def add(self, s, p, o, g) -> None:
        self.out.append(statement(s, p, o, g, len(self.out)))

    def top(self, x: dict, ctx: dict, g) -> None:
        if not isinstance(x, dict):
            raise ParseError("a JSON-LD document is an object or a list of objects")
        ctx = self.context(ctx, x["@context"]) if "@context" in x else ctx
        keys = {k for k in x if k != "@context"}
        if keys == {"@graph"}:
            for y in x["@graph"] if isinstance(x["@graph"], list) else [x["@graph"]]:
                self.top(y, ctx, g)
        else:
            self.node(x, ctx, g)

    def alias(self, ctx: dict, key: str) -> str:
        d = ctx.get(key)
        return d if isinstance(d, str) and d.startswith("@") else key

    def node(self, x: dict, ctx: dict, g) -> str:
        ctx = self.context(ctx, x["@context"]) if "@context" in x else ctx
        items = {self.alias(ctx, k): v for k, v in x.items()}
        s = self.expand(ctx, items["@id"], False) if items.get("@id") is not None else self.blank()
        if not s.startswith("_:"):
            check_iri(s, self.strict)
        for t in _list(items.get("@type")):
            if (iri := self.expand(ctx, t, True) or (t if ":" in t else None)) is not None:
                self.add(s, RDF + "type", iri, g)
        for k, v in items.items():
            if k == "@graph":
                for y in _list(v):
                    self.node(y, ctx, s)
            elif k == "@reverse":
                for p, ys in v.items():
                    for y in _list(ys):
                        self.add(self.node(y, ctx, g), self.expand(ctx, p, True), s, g)
            elif not k.startswith("@") and (p := self.expand(ctx, k, True)) is not None and ":" in p:
                d = ctx.get(k) if isinstance(ctx.get(k), dict) else {}
                self.values(s, p, v, d, ctx, g)
        return s

    def values(self, s, p, v, d: dict, ctx: dict, g) -> None:
        box = d.get("@container")
        if box == "@language" and isinstance(v, dict):
            for lang, xs in v.items():
                for x in _list(xs):
                    self.add(s, p, Literal(x, RDF + "langString", lang), g)
            return
        if box == "@list" or (isinstance(v, dict) and "@list" in v):
            self.add(s, p, self.items(_list(v["@list"] if isinstance(v, dict) else v), d, ctx, g), g)
            return
        for x in _list(v["@set"] if isinstance(v, dict) and "@set" in v else v):
            if isinstance(x, list):
                self.values(s, p, x, d, ctx, g)
            elif x is not None:
                place = len(self.out)
                o = self.value(x, d, ctx, g)
                self.out.insert(place, statement(s, p, o, g, place))
                self.out[place:] = [y._replace(ord=place + i) for i, y in enumerate(self.out[place:])]

    def items(self, xs: list, d: dict, ctx: dict, g) -> str:
        cells = [self.blank() for _ in xs]
        for i, (c, x) in enumerate(zip(cells, xs, strict=True)):
            self.add(c, RDF + "first", self.value(x, d, ctx, g), g)
            self.add(c, RDF + "rest", cells[i + 1] if i + 1 < len(cells) else RDF + "nil", g)
        return cells[0] if cells else RDF + "nil"

    def value(self, x, d: dict, ctx: dict, g):
        kind = d.get("@type")
        if isinstance(x, dict):
            if "@value" in x:
                if x.get("@language"):
                    return Literal(str(x["@value"]), RDF + "langString", x["@language"])
                return _literal(x["@value"], self.expand(ctx, x["@type"], True) if x.get("@type") else None)
            if set(x) == {"@id"}:
                return self.expand(ctx, x["@id"], False)
            return self.node(x, ctx, g)
        if isinstance(x, str) and kind in ("@id", "@vocab"):
            return self.expand(ctx, x, kind == "@vocab")
        if isinstance(x, str) and not kind:
            lang = d.get("@language", ctx.get("@language"))
            return Literal(x, RDF + "langString", lang) if lang else Literal(x)
        return _literal(x, self.expand(ctx, kind, True) if kind and not kind.startswith("@") else None)


def _list(v) -> list:
    return [] if v is None else v if isinstance(v, list) else [v]


def _literal(x, kind: str | None) -> Literal:
    if isinstance(x, bool):
        return Literal(str(x).lower(), kind or XSD + "boolean")
    if isinstance(x, int) or (isinstance(x, float) and x.is_integer() and abs(x) < 1e21 and not kind):
        return Literal(str(int(x)), kind or XSD + "integer")
    if isinstance(x, float):
        return Literal(f"{x:.15E}".replace("E+0", "E").replace("E-0", "E-").replace("E+", "E"), kind or XSD + "double") if not kind else Literal(repr(x), kind)
    return Literal(str(x), kind or XSD + "string")


def json_tree(text: str, hook: str, rel: str = "_jsonTree") -> list[Statement]:
    """The statements of plain JSON hung on a node; no statements for empty JSON."""
    if not text or not text.strip():
        return []
    try:
        body = json.loads(text)
    except ValueError as e:
        raise ParseError(str(e)) from e
    if body in ({}, [], None):
        return []
    doc = {"@context": {"@vocab": VOCAB}, "@id": hook, rel: body}
    return JSONLDParser(json.dumps(doc), None, False).parse()
