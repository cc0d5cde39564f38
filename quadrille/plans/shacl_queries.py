"""One query a constraint component, over the table graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import Catalog, GraphConfig
from ..model import BASE, SH, TYPE, XSD, Graph
from ..operators import ingest
from ..operators.shacl import Constraint, read_shapes, validate
from ..registry import ORACLES, QUERIES
from ..sources.readers import parse_text
from . import tablegraph as tg

E = tg.ROOT
_COLS = "focusNode, nodeType, propertyShape, offendingValue, resultPath, resultMessage"


def _shacl(name: str, c: Constraint, sql: str, component: str) -> None:
    def run(spark, d):
        return validate(tg.graph(spark, d), [c], prune=False).selectExpr(*_COLS.split(", "))

    run.__doc__ = f"Violations of a {component} constraint."
    QUERIES[name] = run
    ORACLES[name] = sql


def _sql(focus: str, label: str | None, component: str, offending: str, path: str | None, message: str, rest: str) -> str:
    p = "NULL" if path is None else path if path.startswith("(") else f"'{path}'"
    return f"SELECT {focus} AS focusNode, '{label or '[all nodes]'}' AS nodeType, '{SH}{component}ConstraintComponent' AS propertyShape, {offending} AS offendingValue, {p} AS resultPath, {message} AS resultMessage {rest}"


C, P, O, N, S = (f"'{E}{k}/' || {c}" for k, c in (("customer", "c_custkey"), ("part", "p_partkey"), ("order", "o_orderkey"), ("nation", "n_nationkey"), ("supplier", "s_suppkey")))
V = lambda x: BASE + x


def _c(kind: str, target: str, path: str | None = None, **params) -> Constraint:
    inverse = kind == "inverseCount"
    return Constraint(kind, target=V(target) if target else "", path=V(path) if path else None, inverse=inverse, shape="http://ex.org/shape", params=params)


_shacl("shacl_datatype", _c("datatype", "Part", "size", datatype=XSD + "string"), _sql(P, "Part", "Datatype", "p_size::VARCHAR", "size", "'property value should be of type string'", "FROM part"), "datatype")
_shacl("shacl_datatype_rel", _c("datatype", "Nation", "SCO", datatype=XSD + "string"), _sql(N, "Nation", "Datatype", f"'{E}region/' || n_regionkey", "SCO", "'SCO should be a property, instead it  is a relationship'", "FROM nation"), "datatype on a relationship")
_shacl("shacl_has_type", Constraint("hasType", target=V("Customer"), path="http://www.w3.org/1999/02/22-rdf-syntax-ns#type", shape="http://ex.org/shape", params={"hasValue": [V("Customer"), V("Partner")]}), _sql(C, "Customer", "HasValue", "NULL", "type", "'The required type Partner could not be found as a label of the focus node '", "FROM customer"), "hasValue on types")
_shacl("shacl_has_iri", _c("hasIri", "Customer", "IN_CATEGORY", hasValue=[E + "nation/3"]), _sql(C, "Customer", "HasValue", "NULL", "IN_CATEGORY", f"'The required value {E}nation/3 could not be found as value of relationship IN_CATEGORY'", "FROM customer WHERE c_nationkey <> 3"), "hasValue")
_shacl("shacl_has_literal", _c("hasLiteral", "Customer", "mktsegment", hasValue=["BUILDING"]), _sql(C, "Customer", "HasValue", "NULL", "mktsegment", "'The required value \"BUILDING\" was not found in property mktsegment'", "FROM customer WHERE c_mktsegment <> 'BUILDING'"), "hasValue on literals")
_shacl("shacl_disjoint_props", _c("disjoint", "Order", "status", disjoint=[V("priority"), V("status")]), _sql(O, "Order", "Disjoint", "o_orderstatus", "status", "'property value overlaps with expected disjoint props'", "FROM orders"), "disjoint")
_shacl("shacl_disjoint_rels", _c("disjoint", "Nation", "SCO", disjoint=[V("SCO")]), _sql(N, "Nation", "Disjoint", f"'{E}region/' || n_regionkey", "SCO", "'relationship target overlaps with expected disjoint rels'", "FROM nation"), "disjoint on relationships")
_shacl("shacl_node_kind_literal", _c("nodeKind", "Customer", "IN_CATEGORY", nodeKind="Literal"), _sql(C, "Customer", "NodeKind", "NULL", "IN_CATEGORY", "'IN_CATEGORY should be a property '", "FROM customer"), "nodeKind literal")
_shacl("shacl_node_kind_iri", _c("nodeKind", "Customer", "name", nodeKind="IRI"), _sql(C, "Customer", "NodeKind", "NULL", "name", "'name should be a relationship but it is a property'", "FROM customer"), "nodeKind IRI")
_shacl("shacl_class_range", _c("rangeClass", "Customer", "IN_CATEGORY", **{"class": V("Region")}), _sql(C, "Customer", "Class", f"'{E}nation/' || c_nationkey", "IN_CATEGORY", "'value should be of type Region'", "FROM customer"), "class")
_shacl("shacl_class_on_property", _c("rangeClass", "Supplier", "name", **{"class": V("Region")}), _sql(S, "Supplier", "Class", "s_name", "name", "'name should be a relationship but it is a property'", "FROM supplier"), "class on a property")
_shacl("shacl_in_literals", _c("inLiterals", "Customer", "mktsegment", **{"in": ["BUILDING", "MACHINERY"]}), _sql(C, "Customer", "In", "c_mktsegment", "mktsegment", "'The value \"' || c_mktsegment || '\" in property mktsegmentis not in  the accepted list'", "FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"), "in")
_shacl("shacl_not_in_literals", _c("inLiterals", "Customer", "mktsegment", notIn=["BUILDING"]), _sql(C, "Customer", "In", "c_mktsegment", "mktsegment", "'The value \"' || c_mktsegment || '\" in property mktsegmentis not in  the accepted list'", "FROM customer WHERE c_mktsegment = 'BUILDING'"), "not in")
_shacl("shacl_in_types", Constraint("inTypes", target=V("Supplier"), path="http://www.w3.org/1999/02/22-rdf-syntax-ns#type", shape="http://ex.org/shape", params={"in": [V("Partner")]}), _sql(S, "Supplier", "In", "'Supplier'", "type", "'The label \"Supplier\" is not in  the accepted list'", "FROM supplier"), "in on types")
_shacl("shacl_in_iris", _c("inIris", "Nation", "SCO", **{"in": [E + "region/0", E + "region/1"]}), _sql(N, "Nation", "In", f"'{E}region/' || n_regionkey", "SCO", f"'The value \"{E}region/' || n_regionkey || '\" in property SCO is not in  the accepted list'", "FROM nation WHERE n_regionkey > 1"), "in on IRIs")
_shacl("shacl_pattern", _c("pattern", "Part", "brand", pattern="Brand#1[0-9]"), _sql(P, "Part", "Pattern", "p_brand", "brand", "'The value of the property does not match the specified regular expression'", "FROM part WHERE NOT regexp_full_match(p_brand, 'Brand#1[0-9]')"), "pattern")
_shacl("shacl_label_count", Constraint("typeCount", target=V("Supplier"), path="http://www.w3.org/1999/02/22-rdf-syntax-ns#type", shape="http://ex.org/shape", params={"minCount": 2.0}), _sql(S, "Supplier", "MinCount", "NULL", "type", "'number of labels (1) is outside the defined min-max limits'", "FROM supplier"), "minCount on types")
_shacl("shacl_count", _c("count", "Order", "CONTAINS", minCount=3.0, maxCount=5.0), _sql(O, "Order", "Count", "NULL", "CONTAINS", "'cardinality (' || n || ') is outside the defined min-max limits'", "FROM (SELECT o_orderkey, count(DISTINCT l_partkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) WHERE n < 3 OR n > 5"), "minCount and maxCount")
_shacl("shacl_max_count_inverse", _c("inverseCount", "Customer", "PLACED_BY", maxCount=12.0), _sql(C, "Customer", "MaxCount", "NULL", "PLACED_BY", "'incoming cardinality (' || n || ') is outside the defined min-max limits'", "FROM (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) WHERE n > 12"), "maxCount on an inverse path")
_shacl("shacl_min_length", _c("length", "Part", "name", minLength=12.0), _sql(P, "Part", "MinLength", "p_name", "name", "''", "FROM part WHERE length(p_name) < 12"), "minLength")
_shacl("shacl_length", _c("length", "Part", "brand", minLength=2.0, maxLength=7.0), _sql(P, "Part", "Length", "p_brand", "brand", "''", "FROM part WHERE length(p_brand) NOT BETWEEN 2 AND 7"), "minLength and maxLength")
_shacl("shacl_range", _c("range", "Part", "retailprice", minInclusive=950.5, maxExclusive=1500.0), _sql(P, "Part", "ValueRange", "p_retailprice::VARCHAR", "retailprice", "''", "FROM part WHERE NOT (p_retailprice >= 950.5 AND p_retailprice < 1500)"), "minInclusive and maxExclusive")
_shacl("shacl_closed", Constraint("closed", target=V("Supplier"), shape="http://ex.org/shape", params={"allowed": [V("name")], "ignoredProperties": [V("IN_CATEGORY")]}), _sql(S, "Supplier", "Closed", "s_acctbal::VARCHAR", "acctbal", "'Closed type definition does not include this property/relationship'", "FROM supplier"), "closed")
_shacl("shacl_required_type", Constraint("requiredType", target=V("Nation"), shape="http://ex.org/shape", params={"class": V("Place")}), _sql(N, "Nation", "Class", "'Place'", "type", "'type missing: Place'", "FROM nation"), "class on a node")
_shacl("shacl_forbidden_type", Constraint("forbiddenType", target="", target_query="uri LIKE '%/nation/%'", shape="http://ex.org/shape", params={"not": V("Nation")}), _sql(N, "[query-based selection]", "Not", "'Nation'", "type", "'type not allowed: Nation'", "FROM nation"), "not class, on a target query")


def _touched(spark, d):
    """Validation of a set of nodes."""
    g = tg.graph(spark, d)
    some = spark.createDataFrame([(f"{E}part/{i}",) for i in range(200)], "uri string")
    return validate(g, [_c("length", "Part", "name", minLength=12.0)], touched=some, prune=False).selectExpr(*_COLS.split(", "))


QUERIES["shacl_validate_set"] = _touched
ORACLES["shacl_validate_set"] = ORACLES["shacl_min_length"] + " AND p_partkey < 200"


# --- shapes as text, several at once, pruned by the labels in use --------------------------------------------------

SHAPES = """
@prefix sh: <http://www.w3.org/ns/shacl#> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
@prefix g: <graph://schema#> . @prefix : <http://ex.org/> .
:parts a sh:NodeShape ; sh:targetClass g:Part ;
  sh:property [ sh:path g:size ; sh:datatype xsd:string ] , [ sh:path g:brand ; sh:pattern "Brand#1[0-9]" ; sh:minLength 2 ; sh:maxLength 7 ] ,
    [ sh:path g:name ; sh:minLength 12 ] , [ sh:path g:retailprice ; sh:minInclusive 950.5 ; sh:maxExclusive 1500 ] .
:customers a sh:NodeShape ; sh:targetClass g:Customer ;
  sh:property [ sh:path g:IN_CATEGORY ; sh:hasValue <http://ex.org/nation/3> ; sh:nodeKind sh:Literal ; sh:class g:Region ] ,
    [ sh:path g:mktsegment ; sh:hasValue "BUILDING" ; sh:in ( "BUILDING" "MACHINERY" ) ] , [ sh:path g:name ; sh:nodeKind sh:IRI ] ,
    [ sh:path [ sh:inversePath g:PLACED_BY ] ; sh:maxCount 12 ] .
:orders a sh:NodeShape ; sh:targetClass g:Order ; sh:property [ sh:path g:CONTAINS ; sh:minCount 3 ; sh:maxCount 5 ] , [ sh:path g:status ; sh:disjoint g:priority , g:status ] .
:nations a sh:NodeShape ; sh:targetClass g:Nation ; sh:class g:Place ;
  sh:property [ sh:path g:SCO ; sh:datatype xsd:string ; sh:in ( <http://ex.org/region/0> <http://ex.org/region/1> ) ] .
:suppliers a sh:NodeShape ; sh:targetClass g:Supplier ; sh:closed true ; sh:ignoredProperties ( g:IN_CATEGORY ) ; sh:property [ sh:path g:name ] .
:unused a sh:NodeShape ; sh:targetClass g:Vessel ; sh:property [ sh:path g:flag ; sh:minCount 1 ] .
:off a sh:NodeShape ; sh:targetClass g:Part ; sh:deactivated true ; sh:property [ sh:path g:name ; sh:maxLength 1 ] .
"""
_IN_SHAPES = ("datatype", "pattern", "length", "min_length", "range", "has_iri", "node_kind_literal", "class_range", "has_literal", "in_literals", "node_kind_iri", "max_count_inverse", "count", "disjoint_props", "required_type", "datatype_rel", "in_iris", "closed")


def _validate_all(spark, d):
    """Violations of shapes given as Turtle: all components together, a shape without nodes pruned, one switched off."""
    return validate(tg.graph(spark, d), read_shapes(parse_text(SHAPES, "Turtle"))).selectExpr(*_COLS.split(", "))


QUERIES["shacl_validate_all"] = _validate_all
ORACLES["shacl_validate_all"] = " UNION ALL ".join(f"SELECT {_COLS} FROM ({ORACLES['shacl_' + k]})" for k in _IN_SHAPES)


# --- named graphs -------------------------------------------------------------------------------------------------


def _quad_graph(spark, d):
    from .ingest_queries import NS, _quads, _rows

    o = spark.read.parquet(f"{d}/orders.parquet")
    typed = _rows(o, tg.uri("customer", "o_custkey"), F.lit(TYPE), F.lit(NS + "Buyer"), graph=F.concat(F.lit(f"{E}graph/"), F.col("o_orderstatus")))
    return ingest.load(_quads(spark, d).unionByName(typed), Catalog(GraphConfig(handleVocabUris="IGNORE"))).graph, NS


def _quads_count(spark, d):
    """A node is counted in each named graph by itself."""
    g, ns = _quad_graph(spark, d)
    c = Constraint("count", target=ns + "Buyer", path=ns + "ordered", shape="http://ex.org/shape", params={"maxCount": 3.0})
    return validate(g, [c]).select("focusNode", "resultMessage")


QUERIES["shacl_quads_count"] = _quads_count
ORACLES["shacl_quads_count"] = f"SELECT DISTINCT '{E}customer/' || o_custkey AS focusNode, 'cardinality (' || n || ') is outside the defined min-max limits' AS resultMessage FROM (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) WHERE n > 3"


def _quads_range(spark, d):
    """A value is checked where it stands: the node's value in another graph doesn't count."""
    g, ns = _quad_graph(spark, d)
    c = Constraint("range", target=ns + "Buyer", path=ns + "latest", shape="http://ex.org/shape", params={"maxInclusive": 500.0})
    return validate(g, [c]).select("focusNode", "offendingValue")


QUERIES["shacl_quads_range"] = _quads_range
ORACLES["shacl_quads_range"] = f"SELECT DISTINCT '{E}customer/' || o_custkey AS focusNode, last::VARCHAR AS offendingValue FROM (SELECT o_custkey, max(o_orderkey) AS last FROM orders GROUP BY o_custkey, o_orderstatus) WHERE last > 500"


# --- every datatype -------------------------------------------------------------------------------------------------

#: Stored type and text of the value of an event, by event_id mod 9; the datatypes that take each.
_STORED = (("string", "x"), ("string", "http://ex.org/x"), ("long", "7"), ("double", "7.5"), ("boolean", "true"), ("date", "2024-01-02"), ("datetime", "2024-01-02T03:04:05Z"), ("localdatetime", "2024-01-02T03:04:05"), ("point", "POINT(1 2)"))
_TAKES = {"string": (0, 1), "anyURI": (1,), "integer": (2,), "int": (2,), "long": (2,), "float": (3,), "double": (3,), "decimal": (3,), "boolean": (4,), "date": (5,), "dateTime": (6, 7), "wktLiteral": (8,)}


def _datatypes(spark, d):
    """All twelve datatypes that can be checked, over values of nine kinds."""
    e, null = spark.read.parquet(f"{d}/events.parquet"), F.lit(None).cast("string")
    uri = tg.uri("event", "event_id")
    pick = lambda i: F.element_at(F.lit([x[i] for x in _STORED]), (F.col("event_id") % len(_STORED) + 1).cast("int"))
    nodes = e.select(uri.alias("uri"), null.alias("graph"), F.array(F.lit("Event")).alias("labels"))
    props = e.select(uri.alias("uri"), null.alias("graph"), F.lit("v").alias("key"), F.lit(0).cast("long").alias("ord"), pick(0).alias("type"), pick(1).alias("lex"), null.alias("lang"), null.alias("datatype"))
    none = Graph.empty(spark)
    where = {"wktLiteral": "http://www.opengis.net/ont/geosparql#"}
    cs = [_c("datatype", "Event", "v", datatype=where.get(k, XSD) + k) for k in _TAKES]
    return validate(Graph(nodes, props, none.edges, none.edge_props), cs).select("focusNode", "offendingValue", "resultMessage")


QUERIES["shacl_datatypes"] = _datatypes
_CASE = "CASE (event_id % 9)::INTEGER " + " ".join(f"WHEN {i} THEN '{x}'" for i, (_, x) in enumerate(_STORED)) + " END"
ORACLES["shacl_datatypes"] = " UNION ALL ".join(f"SELECT '{E}event/' || event_id AS focusNode, {_CASE} AS offendingValue, 'property value should be of type {k}' AS resultMessage FROM events WHERE event_id % 9 NOT IN ({', '.join(map(str, ok))})" for k, ok in _TAKES.items())


# --- types as nodes -------------------------------------------------------------------------------------------------


def _typed_nodes(spark, d):
    """Suppliers with an edge to class A, odd ones to class B too."""
    g, s = tg.graph(spark, d), spark.read.parquet(f"{d}/supplier.parquet")
    to = lambda x, k: x.select(tg.uri("supplier", "s_suppkey").alias("src"), F.lit("type").alias("type"), F.lit(f"{E}class/{k}").alias("dst"), F.lit(None).cast("string").alias("graph"))
    return g.with_(edges=to(s, "A").unionByName(to(s.where("s_suppkey % 2 = 1"), "B")))


def _in_nodes(name: str, kind: str, params: dict, sql: str) -> None:
    def run(spark, d):
        catalog = Catalog(GraphConfig(handleVocabUris="IGNORE", handleRDFTypes="NODES"))
        c = Constraint(kind, target=V("Supplier"), path=TYPE, shape="http://ex.org/shape", params=params)
        return validate(_typed_nodes(spark, d), [c], catalog).selectExpr(*_COLS.split(", "))

    run.__doc__ = f"{kind} where types are nodes."
    QUERIES[name] = run
    ORACLES[name] = sql


_in_nodes("shacl_has_type_nodes", "hasType", {"hasValue": [E + "class/A", E + "class/B"]}, _sql(S, "Supplier", "HasValue", "NULL", "type", f"'The required type {E}class/B could not be found as value of relationship type'", "FROM supplier WHERE s_suppkey % 2 = 0"))
_in_nodes("shacl_in_types_nodes", "inTypes", {"in": [E + "class/A"]}, _sql(S, "Supplier", "In", f"'{E}class/B'", "type", f"'The type \"{E}class/B\" (node connected through property type) is not in  the accepted list'", "FROM supplier WHERE s_suppkey % 2 = 1"))
_in_nodes("shacl_type_count_nodes", "typeCount", {"minCount": 2.0}, _sql(S, "Supplier", "MinCount", "NULL", "type", "'type cardinality (1) is outside the defined min-max limits'", "FROM supplier WHERE s_suppkey % 2 = 0"))
