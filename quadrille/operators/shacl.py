"""SHACL: shapes read from triples, each constraint compiled to a DataFrame plan over the property graph.

Shapes are small and are read on the driver into ``Constraint`` records. A plan starts from the focus nodes of a
target; all plans give the same nine columns and are united under one distinct(). Constraints whose target label
no node bears are left out before anything is planned.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Catalog
from ..functions.iri import is_iri
from ..functions.literals import XSD
from ..model import RDF, RDFS, RESOURCE, RESULTS, SH, TYPE, Graph
from .export import full_name

NIL, FIRST, REST = RDF + "nil", RDF + "first", RDF + "rest"
VIOLATION = SH + "Violation"
EMPTY = ", ".join(f"{c} string" for c in RESULTS)


NODE = ["uri", "graph"]


def _at() -> Column:
    """The named graph as a key of joins."""
    return F.coalesce("graph", F.lit("")).alias("graph")


class ShapeError(ValueError):
    """A shape that can't be compiled."""


@dataclass(frozen=True)
class Constraint:
    """One check: what kind, on which target and path, with which parameters."""

    kind: str
    target: str = ""
    target_query: str | None = None
    path: str | None = None
    inverse: bool = False
    shape: str = ""
    severity: str = VIOLATION
    message: str | None = None
    params: dict = field(default_factory=dict, hash=False)

    def rows(self) -> list[tuple[str, str, str, str]]:
        """As listed: (target, path, parameter, value)."""
        shown = lambda v: ",".join(map(str, v)) if isinstance(v, list | tuple) else str(v)
        return [(self.target or self.target_query or "", self.path or "", k, shown(v)) for k, v in self.params.items() if v is not None]


# --- reading shapes -------------------------------------------------------------------------------------------


class _Triples:
    def __init__(self, triples):
        self.by = defaultdict(list)
        for t in triples:
            self.by[t.subject, t.predicate].append(t)
        self.subjects = {t.subject for t in triples}

    def all(self, s: str, p: str) -> list:
        return self.by.get((s, p), [])

    def one(self, s: str, p: str):
        got = self.all(s, p)
        return got[0].object if got else None

    def items(self, head: str) -> list:
        out = []
        while head and head != NIL:
            out += self.all(head, FIRST)
            head = self.one(head, REST)
        return out


def _short(iri: str) -> str:
    return iri.rsplit("#", 1)[-1].rsplit("/", 1)[-1]


def read_shapes(triples: list) -> list[Constraint]:
    """The constraints of the node shapes in ``triples`` (rows or objects with the columns of the triples table)."""
    t = _Triples(triples)
    shapes = {x.subject for (_, p), xs in t.by.items() if p == TYPE for x in xs if x.object == SH + "NodeShape"} | {s for s, p in t.by if p in (SH + "targetClass", SH + "targetQuery", SH + "property")}
    inner = {x.object for (_, p), xs in t.by.items() if p == SH + "property" for x in xs}
    out: list[Constraint] = []
    for shape in sorted(shapes - inner):
        if t.one(shape, SH + "deactivated") == "true":
            continue
        targets = [(x.object, None) for x in t.all(shape, SH + "targetClass")]
        targets += [(shape, None)] if any(x.object == RDFS + "Class" for x in t.all(shape, TYPE)) else []
        targets += [("", x.object) for x in t.all(shape, SH + "targetQuery")]
        note = t.one(shape, SH + "message")
        level = t.one(shape, SH + "severity") or VIOLATION
        for target, query in targets or [("", None)]:
            common = {"target": target, "target_query": query}
            for ps in t.all(shape, SH + "property"):
                out += _property(t, ps.object, common, note)
            out += _node(t, shape, common, level, note)
    return out


def _property(t: _Triples, ps: str, common: dict, note: str | None) -> list[Constraint]:
    path, inverse = t.one(ps, SH + "path"), False
    if path is None or t.one(ps, SH + "deactivated") == "true":
        return []
    if (back := t.one(path, SH + "inversePath")) is not None:
        path, inverse = back, True
    elif path.startswith("_:") or path.startswith("bnode://"):
        return []  # other complex paths aren't supported
    base = common | {"path": path, "inverse": inverse, "shape": ps if not ps.startswith("_:") else "bnode://id/" + ps[2:], "severity": t.one(ps, SH + "severity") or VIOLATION, "message": t.one(ps, SH + "message") or note}
    one = lambda k: t.one(ps, SH + k)
    number = lambda k: None if one(k) is None else float(one(k))
    made: list[Constraint] = []
    add = lambda kind, **params: made.append(Constraint(kind, params=params, **base))
    if inverse:
        if one("minCount") is not None or one("maxCount") is not None:
            add("inverseCount", minCount=number("minCount"), maxCount=number("maxCount"))
        return made
    if one("datatype"):
        add("datatype", datatype=one("datatype"))
    for k in ("hasValue",):
        vals = t.all(ps, SH + k)
        iris, lits = [x.object for x in vals if not x.isLiteral], [x.object for x in vals if x.isLiteral]
        if iris:
            add("hasType" if path == TYPE else "hasIri", hasValue=iris)
        if lits:
            add("hasLiteral", hasValue=lits)
    if disjoint := [x.object for x in t.all(ps, SH + "disjoint")]:
        add("disjoint", disjoint=disjoint)
    if one("nodeKind"):
        add("nodeKind", nodeKind=_short(one("nodeKind")))
    for x in t.all(ps, SH + "class"):
        add("rangeClass", **{"class": x.object})
    for key, negated in (("in", False),):
        if (head := one(key)) is not None:
            items = t.items(head)
            _in(add, path, items, negated)
    if (no := one("not")) is not None and (head := t.one(no, SH + "in")) is not None:
        _in(add, path, t.items(head), True)
    if one("pattern") is not None:
        add("pattern", pattern=one("pattern"), flags=one("flags"))
    if one("minCount") is not None or one("maxCount") is not None:
        add("typeCount" if path == TYPE else "count", minCount=number("minCount"), maxCount=number("maxCount"))
    if one("minLength") is not None or one("maxLength") is not None:
        add("length", minLength=number("minLength"), maxLength=number("maxLength"))
    bounds = {k: number(k) for k in ("minInclusive", "maxInclusive", "minExclusive", "maxExclusive")}
    if any(v is not None for v in bounds.values()):
        add("range", **bounds)
    return made


def _in(add, path: str, items: list, negated: bool) -> None:
    key = "notIn" if negated else "in"
    iris, lits = [x.object for x in items if not x.isLiteral], [x.object for x in items if x.isLiteral]
    if iris:
        add("inTypes" if path == TYPE else "inIris", **{key: iris})
    if lits:
        add("inLiterals", **{key: lits})


def _node(t: _Triples, shape: str, common: dict, level: str, note: str | None) -> list[Constraint]:
    base = common | {"shape": shape, "severity": level, "message": note}
    out = []
    if t.one(shape, SH + "closed") == "true":
        ignored = [x.object for head in t.all(shape, SH + "ignoredProperties") for x in t.items(head.object)]
        allowed = [t.one(ps.object, SH + "path") for ps in t.all(shape, SH + "property")]
        out.append(Constraint("closed", params={"ignoredProperties": ignored, "allowed": [a for a in allowed if a]}, **base))
    for x in t.all(shape, SH + "class"):
        out.append(Constraint("requiredType", params={"class": x.object}, **base))
    for x in t.all(shape, SH + "not"):
        for y in t.all(x.object, SH + "class"):
            out.append(Constraint("forbiddenType", params={"not": y.object}, **base))
    return out


# --- compiling ------------------------------------------------------------------------------------------------


class Compiler:
    """Plans of constraints over one graph. ``touched`` (uri) narrows the focus nodes.

    A node is its uri and named graph: every table here has both, the default graph as an empty string, and every
    join goes by both.
    """

    def __init__(self, graph: Graph, catalog: Catalog | None = None, touched: DataFrame | None = None):
        self.graph, self.catalog, self.touched = graph, catalog or Catalog(), touched
        self.config = self.catalog.config

    # Names: shapes speak IRIs, the graph stored names.
    def stored(self, iri: str) -> str:
        mode = self.config.handleVocabUris if self.config else "IGNORE"
        if mode == "KEEP":
            return iri
        from ..config import split_iri

        ns, local = split_iri(iri)
        if mode in ("IGNORE", "MAP"):
            return self.catalog.mappings.name_of().get(iri, local)
        prefix = self.catalog.prefixes.prefix_of(ns)
        return f"{prefix}__{local}" if prefix else iri

    def shown(self, iri: str) -> str:
        return iri if self.config and self.config.is_rdf else self.stored(iri)

    def focus(self, c: Constraint) -> DataFrame:
        nodes = self.graph.nodes.select("uri", "graph", "labels")
        if c.target:
            nodes = nodes.where(F.array_contains("labels", self.stored(c.target)))
        elif c.target_query:
            nodes = nodes.where(F.expr(c.target_query))
        nodes = nodes.select("uri", _at(), "labels")
        if self.touched is not None:
            nodes = nodes.join(self.touched.select("uri").distinct(), "uri", "left_semi")
        return nodes

    def values(self, path: str) -> DataFrame:
        return self.graph.props.where(F.col("key") == self.stored(path)).select("uri", _at(), "type", "lex", "ord")

    def whole(self, path: str) -> DataFrame:
        """(uri, vals, offending): all values of a property of a node together; several are sorted and joined."""
        v = self.values(path).groupBy(*NODE).agg(F.array_sort(F.collect_list(F.struct("lex", "type"))).alias("vals"))
        return v.withColumn("offending", F.array_join(F.transform("vals", lambda x: x["lex"]), ", "))

    def edges(self, path: str) -> DataFrame:
        return self.graph.edges.where(F.col("type") == self.stored(path)).select(F.col("src").alias("uri"), _at(), "dst")

    def result(self, frame: DataFrame, c: Constraint, component: str, message: Column | str, offending: Column | None = None, path: Column | str | None = None) -> DataFrame:
        target = "[query-based selection]" if c.target_query else self.shown(c.target) if c.target else "[all nodes]"
        text = lambda x: F.lit(x) if x is None or isinstance(x, str) else x
        where = path if path is not None else self.shown(c.path) if c.path else None
        cols = (F.col("uri"), F.lit(target), F.lit(c.shape), F.lit(SH + component + "ConstraintComponent"), F.lit(None) if offending is None else offending, text(where), F.lit(c.severity), text(message), F.lit(c.message))
        return frame.select(*[x.cast("string").alias(n) for x, n in zip(cols, RESULTS, strict=True)])

    def plans(self, c: Constraint) -> list[DataFrame]:
        return getattr(self, "_" + c.kind)(c, c.params, self.focus(c))

    def _bounds(self, p: dict, low: str, high: str, both: str) -> str:
        lo, hi = p.get(low) is not None, p.get(high) is not None
        cap = lambda s: s[0].upper() + s[1:]
        return both if lo and hi else cap(low) if lo else cap(high)

    # Datatypes: a value of a property must be of the type; a relationship is none.
    def _datatype(self, c, p, focus):
        name = p["datatype"]
        ok = lambda v: _of_type(name, v["type"], v["lex"])
        bad = focus.join(self.whole(c.path), NODE).where(~F.forall("vals", ok))
        shown = self.shown(name) if self.config and self.config.is_rdf else _short(name)
        rel = focus.join(self.edges(c.path), NODE)
        return [self.result(bad, c, "Datatype", f"property value should be of type {shown}", F.col("offending")), self.result(rel, c, "Datatype", f"{self.shown(c.path)} should be a property, instead it  is a relationship", F.col("dst"))]

    def _required(self, focus, values):
        return focus.withColumn("want", F.explode(F.lit([*values])))

    @property
    def _types(self) -> str:
        return self.config.handleRDFTypes if self.config else "LABELS"

    def _hasType(self, c, p, focus):
        out = []
        if self._types in ("LABELS", "LABELS_AND_NODES"):
            want = self._required(focus, [self.stored(x) for x in p["hasValue"]]).where(~F.array_contains(F.col("labels"), F.col("want")))
            out.append(self.result(want, c, "HasValue", F.concat(F.lit("The required type "), F.col("want"), F.lit(" could not be found as a label of the focus node "))))
        if self._types in ("NODES", "LABELS_AND_NODES"):
            have = self.edges(c.path).withColumnRenamed("dst", "want")
            want = self._required(focus, p["hasValue"]).join(have, [*NODE, "want"], "left_anti")
            out.append(self.result(want, c, "HasValue", F.concat(F.lit("The required type "), F.col("want"), F.lit(f" could not be found as value of relationship {self.shown(c.path)}"))))
        return out

    def _hasIri(self, c, p, focus):
        want = self._required(focus, p["hasValue"]).join(self.edges(c.path).withColumnRenamed("dst", "want"), [*NODE, "want"], "left_anti")
        return [self.result(want, c, "HasValue", F.concat(F.lit("The required value "), F.col("want"), F.lit(f" could not be found as value of relationship {self.shown(c.path)}")))]

    def _hasLiteral(self, c, p, focus):
        want = self._required(focus, p["hasValue"]).join(self.values(c.path).withColumnRenamed("lex", "want"), [*NODE, "want"], "left_anti")
        return [self.result(want, c, "HasValue", F.concat(F.lit('The required value "'), F.col("want"), F.lit(f'" was not found in property {self.shown(c.path)}')))]

    def _disjoint(self, c, p, focus):
        names = [self.stored(x) for x in p["disjoint"]]
        other = self.graph.props.where(F.col("key").isin(names)).select("uri", _at(), "lex", "type")
        hit = self.values(c.path).join(other, [*NODE, "lex", "type"], "left_semi").select(*NODE).distinct()
        props = focus.join(self.whole(c.path), NODE).join(hit, NODE, "left_semi")
        to = self.graph.edges.where(F.col("type").isin(names)).select(F.col("src").alias("uri"), _at(), "dst")
        rels = focus.join(self.edges(c.path).join(to, [*NODE, "dst"], "left_semi").distinct(), NODE)
        return [self.result(props, c, "Disjoint", "property value overlaps with expected disjoint props", F.col("offending")), self.result(rels, c, "Disjoint", "relationship target overlaps with expected disjoint rels", F.col("dst"))]

    def _nodeKind(self, c, p, focus):
        name = self.shown(c.path)
        if p["nodeKind"] == "Literal":
            return [self.result(focus.join(self.edges(c.path), NODE, "left_semi"), c, "NodeKind", f"{name} should be a property ")]
        if p["nodeKind"] in ("IRI", "BlankNodeOrIRI", "BlankNode"):
            return [self.result(focus.join(self.values(c.path), NODE, "left_semi"), c, "NodeKind", f"{name} should be a relationship but it is a property")]
        return []

    def _rangeClass(self, c, p, focus):
        want = self.stored(p["class"])
        to = self.graph.nodes.select(F.col("uri").alias("dst"), _at(), F.col("labels").alias("to_labels"))
        bad = focus.join(self.edges(c.path), NODE).join(to, ["dst", "graph"], "left").where(~F.coalesce(F.array_contains("to_labels", want), F.lit(False)))
        prop = focus.join(self.whole(c.path), NODE)
        return [self.result(bad, c, "Class", f"value should be of type {self.shown(p['class'])}", F.col("dst")), self.result(prop, c, "Class", f"{self.stored(c.path)} should be a relationship but it is a property", F.col("offending"))]

    def _member(self, p: dict, x: Column, values) -> Column:
        return ~x.isin(*values) if "in" in p else x.isin(*values)

    def _inLiterals(self, c, p, focus):
        bad = focus.join(self.values(c.path), NODE).where(self._member(p, F.col("lex"), p.get("in") or p["notIn"]))
        return [self.result(bad, c, "In", F.concat(F.lit('The value "'), F.col("lex"), F.lit(f'" in property {self.shown(c.path)}is not in  the accepted list')), F.col("lex"))]

    def _inTypes(self, c, p, focus):
        out, iris = [], p.get("in") or p["notIn"]
        if self._types in ("LABELS", "LABELS_AND_NODES"):
            each = focus.withColumn("label", F.explode("labels")).where(F.col("label") != RESOURCE)
            bad = each.where(self._member(p, F.col("label"), [self.stored(x) for x in iris]))
            where = TYPE if self.config and self.config.is_rdf else "type"
            out.append(self.result(bad, c, "In", F.concat(F.lit('The label "'), F.col("label"), F.lit('" is not in  the accepted list')), F.col("label"), where))
        if self._types in ("NODES", "LABELS_AND_NODES"):
            bad = focus.join(self.edges(c.path), NODE).where(self._member(p, F.col("dst"), iris))
            out.append(self.result(bad, c, "In", F.concat(F.lit('The type "'), F.col("dst"), F.lit(f'" (node connected through property {self.shown(c.path)}) is not in  the accepted list')), F.col("dst")))
        return out

    def _inIris(self, c, p, focus):
        bad = focus.join(self.edges(c.path), NODE).where(self._member(p, F.col("dst"), p.get("in") or p["notIn"]))
        return [self.result(bad, c, "In", F.concat(F.lit('The value "'), F.col("dst"), F.lit(f'" in property {self.shown(c.path)} is not in  the accepted list')), F.col("dst"))]

    def _pattern(self, c, p, focus):
        flags = f"(?{p['flags']})" if p.get("flags") else ""
        bad = focus.join(self.values(c.path), NODE).where(~F.col("lex").rlike(f"^{flags}(?:{p['pattern']})$"))
        return [self.result(bad, c, "Pattern", "The value of the property does not match the specified regular expression", F.col("lex"))]

    def _outside(self, n: Column, lo, hi) -> Column:
        return (n < lo if lo is not None else F.lit(False)) | (n > hi if hi is not None else F.lit(False))

    def _count_result(self, frame, c, p, what: str):
        bad = frame.where(self._outside(F.col("n"), p.get("minCount"), p.get("maxCount")))
        return self.result(bad, c, self._bounds(p, "minCount", "maxCount", "Count"), F.concat(F.lit(f"{what} ("), F.col("n").cast("string"), F.lit(") is outside the defined min-max limits")))

    def _counted(self, focus, rows: DataFrame, name: str) -> DataFrame:
        return focus.join(rows.groupBy(*NODE).agg(F.count("*").alias(name)), NODE, "left").withColumn(name, F.coalesce(name, F.lit(0)))

    def _count(self, c, p, focus):
        n = self._counted(self._counted(focus, self.edges(c.path), "ne"), self.values(c.path), "np").withColumn("n", F.col("ne") + F.col("np"))
        return [self._count_result(n, c, p, "cardinality")]

    def _typeCount(self, c, p, focus):
        out = []
        if self._types in ("LABELS", "LABELS_AND_NODES"):
            out.append(self._count_result(focus.withColumn("n", F.size(F.array_remove("labels", RESOURCE))), c, p, "number of labels"))
        if self._types in ("NODES", "LABELS_AND_NODES"):
            out.append(self._count_result(self._counted(focus, self.edges(c.path), "n"), c, p, "type cardinality"))
        return out

    def _inverseCount(self, c, p, focus):
        into = self.graph.edges.where(F.col("type") == self.stored(c.path)).select(F.col("dst").alias("uri"), _at())
        return [self._count_result(self._counted(focus, into, "n"), c, p, "incoming cardinality")]

    def _length(self, c, p, focus):
        ok = lambda v: ~self._outside(F.length(v["lex"]), p.get("minLength"), p.get("maxLength"))
        bad = focus.join(self.whole(c.path), NODE).where(~F.forall("vals", ok))
        return [self.result(bad, c, self._bounds(p, "minLength", "maxLength", "Length"), "", F.col("offending"))]

    def _range(self, c, p, focus):
        def ok(v: Column) -> Column:
            x, out = v["lex"].try_cast("double"), F.lit(True)
            for k, test in (("minInclusive", lambda b: x >= b), ("maxInclusive", lambda b: x <= b), ("minExclusive", lambda b: x > b), ("maxExclusive", lambda b: x < b)):
                if p.get(k) is not None:
                    out = out & test(p[k])
            return out

        bad = focus.join(self.whole(c.path), NODE).where(~F.forall("vals", ok))
        used = [k for k in ("minInclusive", "minExclusive", "maxInclusive", "maxExclusive") if p.get(k) is not None]
        name = used[0][0].upper() + used[0][1:] if len(used) == 1 else "ValueRange"
        return [self.result(bad, c, name, "", F.col("offending"))]

    def _closed(self, c, p, focus):
        allowed = [self.stored(x) for x in [*p["allowed"], *p["ignoredProperties"]]]
        keys = self.graph.props.select("uri", _at(), F.col("key").alias("term"), F.col("lex").alias("what"))
        rels = self.graph.edges.select(F.col("src").alias("uri"), _at(), F.col("type").alias("term"), F.col("dst").alias("what"))
        extra = keys.unionByName(rels).where(~F.col("term").isin(allowed)).groupBy(*NODE, "term").agg(F.array_join(F.array_sort(F.collect_list("what")), ", ").alias("what"))
        shown = full_name(F.col("term"), self.catalog) if self.config and self.config.is_rdf else F.col("term")
        return [self.result(focus.join(extra, NODE), c, "Closed", "Closed type definition does not include this property/relationship", F.col("what"), shown)]

    def _type_path(self) -> str:
        return TYPE if self.config and self.config.handleVocabUris != "IGNORE" else "type"

    def _requiredType(self, c, p, focus):
        x = p["class"]
        return [self.result(focus.where(~F.array_contains("labels", self.stored(x))), c, "Class", f"type missing: {self.shown(x)}", F.lit(self.shown(x)), self._type_path())]

    def _forbiddenType(self, c, p, focus):
        x = p["not"]
        return [self.result(focus.where(F.array_contains("labels", self.stored(x))), c, "Not", f"type not allowed: {self.shown(x)}", F.lit(self.shown(x)), self._type_path())]


def _of_type(datatype: str, stored: Column, lex: Column) -> Column:
    name = datatype[len(XSD) :] if datatype.startswith(XSD) else _short(datatype)
    tests = {
        "boolean": stored == "boolean",
        "string": stored == "string",
        "integer": stored == "long",
        "int": stored == "long",
        "long": stored == "long",
        "float": stored == "double",
        "double": stored == "double",
        "decimal": stored == "double",
        "date": stored == "date",
        "dateTime": stored.isin("datetime", "localdatetime"),
        "wktLiteral": stored == "point",
        "anyURI": (stored == "string") & is_iri(lex),
    }
    if name not in tests:
        raise ShapeError(f"datatype {datatype} can't be checked")
    return tests[name]


def validate(graph: Graph, constraints: list[Constraint], catalog: Catalog | None = None, touched: DataFrame | None = None, prune: bool = True) -> DataFrame:
    """All violations, each once. ``touched`` (uri): check these nodes only."""
    compiler = Compiler(graph, catalog, touched)
    if prune and any(c.target for c in constraints):
        used = {r.label for r in graph.nodes.select(F.explode("labels").alias("label")).distinct().collect()}  # labels: a vocabulary, not data
        constraints = [c for c in constraints if not c.target or compiler.stored(c.target) in used]
    plans = [p for c in constraints for p in compiler.plans(c)]
    if not plans:
        return graph.nodes.sparkSession.createDataFrame([], EMPTY)
    return reduce(DataFrame.unionByName, plans).distinct()


def list_shapes(spark, constraints: list[Constraint]) -> DataFrame:
    return spark.createDataFrame([r for c in constraints for r in c.rows()], "target string, propertyOrRelationshipPath string, param string, value string")


def plan_texts(graph: Graph, constraints: list[Constraint], catalog: Catalog | None = None) -> list[tuple[str, str]]:
    """(kind of constraint, analysed plan) of each plan, for inspection."""
    compiler = Compiler(graph, catalog)
    return [(c.kind, p._jdf.queryExecution().analyzed().toString()) for c in constraints for p in compiler.plans(c)]


def check_target_query(graph: Graph, query: str) -> None:
    """Raises ``ShapeError`` if a target query is no predicate over uri, graph and labels."""
    try:
        if graph.nodes.where(F.expr(query)).schema is None:
            raise ShapeError(query)
    except Exception as e:
        raise ShapeError(f"target query {query!r}: {e}") from e
