"""RDF/XML over the standard library's element tree."""

from __future__ import annotations

import xml.etree.ElementTree as ET

from ..model import RDF, XSD
from .terms import Literal, ParseError, Statement, check_iri, resolve, statement

_XML = "{http://www.w3.org/XML/1998/namespace}"
_R = "{" + RDF + "}"
_SYNTAX = {_R + x for x in ("about", "ID", "nodeID", "resource", "datatype", "parseType", "aboutEach", "bagID", "li")}


def _iri(tag: str) -> str:
    return tag[1:].replace("}", "", 1) if tag.startswith("{") else tag


class RDFXMLParser:
    def __init__(self, text: str, base: str | None = None, strict: bool = True):
        self.strict, self.base, self.fresh, self.out = strict, base, 0, []
        try:
            self.root = ET.fromstring(text)
        except ET.ParseError as e:
            raise ParseError(str(e)) from e

    def parse(self) -> list[Statement]:
        if self.root.tag == _R + "RDF":
            base, lang = self._scope(self.root, self.base, None)
            for node in self.root:
                self.node(node, base, lang)
        else:
            self.node(self.root, self.base, None)
        return self.out

    def _scope(self, el, base, lang):
        return el.get(_XML + "base", base), el.get(_XML + "lang", lang) or None

    def blank(self) -> str:
        self.fresh += 1
        return f"_:genid{self.fresh}"

    def iri(self, base, ref: str) -> str:
        return check_iri(resolve(base, ref), self.strict)

    def add(self, s, p, o) -> None:
        self.out.append(statement(s, p, o, None, len(self.out)))

    def subject(self, el, base) -> str:
        if (x := el.get(_R + "about")) is not None:
            return self.iri(base, x)
        if (x := el.get(_R + "ID")) is not None:
            return self.iri(base, "#" + x)
        if (x := el.get(_R + "nodeID")) is not None:
            return "_:" + x
        return self.blank()

    def node(self, el, base, lang) -> str:
        base, lang = self._scope(el, base, lang)
        s = self.subject(el, base)
        if el.tag != _R + "Description":
            self.add(s, RDF + "type", check_iri(_iri(el.tag), self.strict))
        self.attributes(s, el, base, lang)
        count = 0
        for prop in el:
            p = _iri(prop.tag)
            if prop.tag == _R + "li":
                count += 1
                p = f"{RDF}_{count}"
            self.property(s, p, prop, base, lang)
        return s

    def attributes(self, s, el, base, lang) -> bool:
        found = False
        for k, v in el.attrib.items():
            if k in _SYNTAX or k.startswith(_XML) or not k.startswith("{"):
                continue
            found = True
            if k == _R + "type":
                self.add(s, RDF + "type", self.iri(base, v))
            else:
                self.add(s, _iri(k), Literal(v, RDF + "langString", lang) if lang else Literal(v))
        return found

    def property(self, s, p, el, base, lang) -> None:
        base, lang = self._scope(el, base, lang)
        kind, at = el.get(_R + "parseType"), len(self.out)
        if kind == "Resource":
            o = self.blank()
            self.add(s, p, o)
            for prop in el:
                self.property(o, _iri(prop.tag), prop, base, lang)
        elif kind == "Collection":
            items = [self.node(x, base, lang) for x in el]
            cells = [self.blank() for _ in items]
            self.add(s, p, cells[0] if cells else RDF + "nil")
            for i, (c, x) in enumerate(zip(cells, items, strict=True)):
                self.add(c, RDF + "first", x)
                self.add(c, RDF + "rest", cells[i + 1] if i + 1 < len(cells) else RDF + "nil")
        elif kind is not None:
            inner = (el.text or "") + "".join(ET.tostring(x, encoding="unicode") for x in el)
            self.add(s, p, Literal(inner, RDF + "XMLLiteral"))
        elif (x := el.get(_R + "resource")) is not None or el.get(_R + "nodeID") is not None:
            o = self.iri(base, x) if x is not None else "_:" + el.get(_R + "nodeID")
            self.add(s, p, o)
            self.attributes(o, el, base, lang)
        elif len(el):
            place = len(self.out)
            o = self.node(el[0], base, lang)
            self.out.insert(place, statement(s, p, o, None, place))
            self.out[place:] = [x._replace(ord=place + i) for i, x in enumerate(self.out[place:])]
        elif (d := el.get(_R + "datatype")) is not None:
            self.add(s, p, Literal(el.text or "", self.iri(base, d)))
        elif not (el.text or "").strip() and any(k.startswith("{") and k not in _SYNTAX and not k.startswith(_XML) for k in el.attrib):
            o = self.blank()
            self.add(s, p, o)
            self.attributes(o, el, base, lang)
        else:
            self.add(s, p, Literal(el.text or "", RDF + "langString", lang) if lang else Literal(el.text or "", XSD + "string"))
        if (name := el.get(_R + "ID")) is not None and len(self.out) > at:  # reification
            r, st = self.iri(base, "#" + name), self.out[at]
            o = Literal(st.object, st.literalType, st.literalLang) if st.isLiteral else st.object
            for q, v in (("type", RDF + "Statement"), ("subject", st.subject), ("predicate", st.predicate), ("object", o)):
                self.add(r, RDF + q, v)
