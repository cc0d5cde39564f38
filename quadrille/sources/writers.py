"""Triples as text: N-Triples and N-Quads as lines of a DataFrame, the other formats for a set of statements."""

from __future__ import annotations

import json
from collections import defaultdict
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import split_iri
from ..model import RDF, XSD
from .terms import ParseError

MIME = {"Turtle": "text/turtle", "N-Triples": "application/n-triples", "RDF/XML": "application/rdf+xml", "JSON-LD": "application/ld+json", "TriG": "application/trig", "N-Quads": "application/n-quads", "Turtle-star": "application/x-turtlestar", "TriG-star": "application/x-trigstar"}


def negotiate(format_: str | None = None, accept: str | None = None) -> str:
    """The format: by a part of its name if one is given, else by MIME type, else Turtle."""
    if format_:
        for name in MIME:
            if format_.lower() in name.lower():
                return name
    for m in (accept or "").split(","):
        for name, mime in MIME.items():
            if m.split(";")[0].strip() == mime:
                return name
    return "Turtle"


# --- lines, in SQL expressions --------------------------------------------------------------------------------


def _escaped(c: Column) -> Column:
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _node(c: Column) -> Column:
    return F.when(c.startswith("_:"), c).when(c.startswith("<< "), c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))


def line(named: bool = False) -> Column:
    """A statement as a line of N-Triples, or of N-Quads if ``named``."""
    o, kind, lang = F.col("object"), F.col("literalType"), F.col("literalLang")
    literal = F.concat(F.lit('"'), _escaped(o), F.lit('"'), F.when(lang.isNotNull(), F.concat(F.lit("@"), lang)).when(kind.isNull() | (kind == XSD + "string"), F.lit("")).otherwise(F.concat(F.lit("^^<"), kind, F.lit(">"))))
    spo = F.col("subjectSPO")
    subject = F.when(spo.isNotNull(), F.concat(F.lit("<< "), _node(spo[0]), F.lit(" "), _node(spo[1]), F.lit(" "), _node(spo[2]), F.lit(" >>"))).otherwise(_node(F.col("subject")))
    parts = [subject, _node(F.col("predicate")), F.when(F.col("isLiteral"), literal).otherwise(_node(o))]
    if named:
        parts.append(F.when(F.col("graph").isNotNull(), _node(F.col("graph"))))
    return F.concat(F.concat_ws(" ", *parts), F.lit(" ."))


def write_lines(triples: DataFrame, path: str, named: bool = False) -> None:
    triples.select(line(named).alias("value")).write.mode("overwrite").text(path)


# --- documents ------------------------------------------------------------------------------------------------


def _q(text: str) -> str:
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t") + '"'


class Document:
    """A set of statements (records with the columns of the triples table) written as one document."""

    def __init__(self, rows, prefixes: dict[str, str] | None = None):
        seen = {}
        for r in rows:
            spo = tuple(r["subjectSPO"]) if r["subjectSPO"] else None
            seen[(r["subject"], r["predicate"], r["object"], bool(r["isLiteral"]), r["literalType"], r["literalLang"], spo, r.get("graph") if isinstance(r, dict) else None)] = None
        self.rows = sorted(seen, key=lambda x: tuple("" if v is None else str(v) for v in (x[7], *x[:7])))
        used = {split_iri(v)[0] for v in {v for r in self.rows for v in (r[0], r[1], None if r[3] else r[2], r[4]) if v}}
        self.prefixes = {p: n for p, n in sorted((prefixes or {}).items()) if n in used}
        self.short = {n: p for p, n in self.prefixes.items()}

    def iri(self, x: str) -> str:
        if x.startswith("_:"):
            return x
        ns, local = split_iri(x)
        if ns in self.short and local and all(c.isalnum() or c in "_-" for c in local) and local[0] not in "-":
            return f"{self.short[ns]}:{local}"
        return f"<{x}>"

    def object(self, r) -> str:
        if not r[3]:
            return self.iri(r[2])
        if r[5]:
            return _q(r[2]) + "@" + r[5]
        return _q(r[2]) + ("" if r[4] in (None, XSD + "string") else "^^" + self.iri(r[4]))

    def subject(self, r) -> str:
        return "<< " + " ".join(self.iri(x) for x in r[6]) + " >>" if r[6] else self.iri(r[0])

    def turtle(self, graphs: bool = False) -> str:
        out = [f"@prefix {p}: <{n}> ." for p, n in self.prefixes.items()]
        by: dict = defaultdict(lambda: defaultdict(lambda: defaultdict(list)))
        for r in self.rows:
            p = "a" if r[1] == RDF + "type" else self.iri(r[1])
            by[r[7] if graphs else None][self.subject(r)][p].append(self.object(r))
        for g, subjects in by.items():
            body = [s + " " + " ;\n    ".join(p + " " + ", ".join(os) for p, os in ps.items()) + " ." for s, ps in subjects.items()]
            out += [f"{self.iri(g)} {{", *body, "}"] if g else body
        return "\n".join(out) + "\n"

    def ntriples(self, graphs: bool = False) -> str:
        short, self.short = self.short, {}
        lines = [" ".join([self.subject(r), self.iri(r[1]), self.object(r), *([self.iri(r[7])] if graphs and r[7] else [])]) + " ." for r in self.rows]
        self.short = short
        return "\n".join(lines) + "\n" if lines else ""

    def rdfxml(self) -> str:
        spaces, body = dict(self.short) | {RDF: "rdf"}, defaultdict(list)
        for r in self.rows:
            if r[6]:
                raise ParseError("RDF/XML has no statements about statements")
            ns, local = split_iri(r[1])
            tag = f"{spaces.setdefault(ns, f'p{len(spaces)}')}:{local}"
            if not r[3]:
                ref = f"rdf:nodeID={quoteattr(r[2][2:])}" if r[2].startswith("_:") else f"rdf:resource={quoteattr(r[2])}"
                body[r[0]].append(f"    <{tag} {ref}/>")
            else:
                mark = f" xml:lang={quoteattr(r[5])}" if r[5] else "" if r[4] in (None, XSD + "string") else f" rdf:datatype={quoteattr(r[4])}"
                body[r[0]].append(f"    <{tag}{mark}>{escape(r[2])}</{tag}>")
        head = "".join(f' xmlns:{p}={quoteattr(n)}' for n, p in spaces.items())
        nodes = []
        for s, props in body.items():
            at = f"rdf:nodeID={quoteattr(s[2:])}" if s.startswith("_:") else f"rdf:about={quoteattr(s)}"
            nodes.append(f"  <rdf:Description {at}>\n" + "\n".join(props) + "\n  </rdf:Description>")
        return f'<?xml version="1.0" encoding="UTF-8"?>\n<rdf:RDF{head}>\n' + "\n".join(nodes) + "\n</rdf:RDF>\n"

    def jsonld(self) -> str:
        graphs: dict = defaultdict(dict)
        for r in self.rows:
            if r[6]:
                raise ParseError("JSON-LD has no statements about statements")
            node = graphs[r[7]].setdefault(r[0], {"@id": r[0]})
            if r[1] == RDF + "type" and not r[3]:
                node.setdefault("@type", []).append(r[2])
            else:
                v = {"@id": r[2]} if not r[3] else {"@value": r[2], "@language": r[5]} if r[5] else {"@value": r[2]} if r[4] in (None, XSD + "string") else {"@value": r[2], "@type": r[4]}
                node.setdefault(r[1], []).append(v)
        top = [*graphs.pop(None, {}).values(), *({"@id": g, "@graph": [*ns.values()]} for g, ns in graphs.items())]
        return json.dumps({"@graph": top}, ensure_ascii=False, indent=1)

    def write(self, fmt: str) -> str:
        made = {"Turtle": self.turtle, "Turtle-star": self.turtle, "N-Triples": self.ntriples, "RDF/XML": self.rdfxml, "JSON-LD": self.jsonld, "TriG": lambda: self.turtle(True), "TriG-star": lambda: self.turtle(True), "N-Quads": lambda: self.ntriples(True)}
        if fmt not in made:
            raise ParseError(f"Unrecognized serialization format: {fmt}")
        return made[fmt]()
