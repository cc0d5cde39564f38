"""Ontologies, SKOS, RDF-mode exports, documents and lenient imports over triples made of the tables, with oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Catalog, GraphConfig, ParserConfig
from ..engine import Engine
from ..model import BASE, OWL, RDF, RDFS, SKOS, SKOSXL, TYPE, XSD, Graph
from ..operators import collect, delete, export, infer, ingest, onto, similarity
from ..sources.readers import _lines, parse_text
from . import tablegraph as tg
from .graph_queries import E, query, t
from .ingest_queries import _FIRST, NS, _catalog, _quads, _rows, event_triples

L = F.lit


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _u(kind: str, key) -> F.Column:
    return tg.uri(kind, F.expr(key) if isinstance(key, str) else key)


# --- ontologies -----------------------------------------------------------------------------------------------


def ontology_triples(spark, d):
    """Nations as classes under regions, parts as properties between them, restrictions behind blank nodes."""
    n, r, p = t(spark, d, "nation"), t(spark, d, "region"), t(spark, d, "part")
    kind = F.when(F.expr("p_partkey % 3 = 0"), OWL + "ObjectProperty").when(F.expr("p_partkey % 3 = 1"), OWL + "DatatypeProperty").otherwise(RDF + "Property")
    blank = F.concat(L("_:r"), F.col("n_nationkey"))
    counted = n.where("n_nationkey % 3 = 0")
    return _union([
        _rows(n, _u("cls", "n_nationkey"), L(TYPE), L(OWL + "Class")),
        _rows(r, _u("cls", "100 + r_regionkey"), L(TYPE), L(RDFS + "Class")),
        _rows(n, _u("cls", "n_nationkey"), L(RDFS + "subClassOf"), _u("cls", "100 + n_regionkey")),
        _rows(r, _u("cls", "100 + r_regionkey"), L(OWL + "equivalentClass"), _u("ext", "r_regionkey")),
        _rows(p, _u("prop", "p_partkey"), L(TYPE), kind),
        _rows(p.where("p_partkey % 3 = 0 and p_partkey > 0"), _u("prop", "p_partkey"), L(RDFS + "subPropertyOf"), _u("prop", "0")),
        _rows(p, _u("prop", "p_partkey"), L(RDFS + "domain"), _u("cls", "p_partkey % 25")),
        _rows(p.where("p_partkey % 3 <> 1"), _u("prop", "p_partkey"), L(RDFS + "range"), _u("cls", "100 + p_partkey % 5")),
        _rows(p.where("p_partkey % 6 = 0"), _u("prop", "p_partkey"), L(TYPE), L(OWL + "TransitiveProperty")),
        _rows(p, _u("prop", "p_partkey"), L(RDFS + "label"), F.col("p_name"), RDF + "langString", lang=F.when(F.expr("p_partkey % 2 = 0"), "en").otherwise("de")),
        _rows(p.where("p_partkey % 10 = 0"), _u("ghost", "p_partkey"), L(RDFS + "comment"), F.col("p_name"), XSD + "string"),
        _rows(n, _u("cls", "n_nationkey"), L(RDFS + "subClassOf"), blank),
        _rows(n.where("n_nationkey % 7 <> 0"), blank, L(OWL + "onProperty"), _u("prop", "n_nationkey")),
        _rows(counted, blank, L(OWL + "minQualifiedCardinality"), F.col("n_nationkey"), XSD + "nonNegativeInteger"),
        _rows(counted, blank, L(OWL + "onClass"), _u("cls", "100 + n_regionkey")),
        _rows(n.where("n_nationkey % 3 <> 0"), blank, L(OWL + "someValuesFrom"), _u("cls", "100 + n_regionkey")),
    ])


def _ontology(spark, d, **params):
    return onto.load_ontology(ontology_triples(spark, d), _catalog(**params))


@query(f"""SELECT DISTINCT '{E}' || uri AS uri, labels FROM (
  SELECT 'cls/' || n_nationkey AS uri, 'Class,Resource' AS labels FROM nation UNION ALL SELECT 'cls/' || (100 + r_regionkey), 'Class,Resource' FROM region UNION ALL SELECT 'ext/' || r_regionkey, 'Class,Resource' FROM region
  UNION ALL SELECT 'prop/' || p_partkey, CASE WHEN p_partkey % 3 = 1 THEN 'Property,Resource' ELSE 'Relationship,Resource' END FROM part UNION ALL SELECT 'prop/0', 'Relationship,Resource')""")
def onto_nodes(spark, d):
    """Classes and properties, declared or implied by the links they are in."""
    return _ontology(spark, d).graph.nodes.select("uri", F.array_join("labels", ",").alias("labels"))


@query(f"""SELECT '{E}' || src AS src, type, '{E}' || dst AS dst FROM (
  SELECT 'cls/' || n_nationkey AS src, 'SCO' AS type, 'cls/' || (100 + n_regionkey) AS dst FROM nation UNION ALL SELECT 'cls/' || (100 + r_regionkey), 'EQC', 'ext/' || r_regionkey FROM region
  UNION ALL SELECT 'prop/' || p_partkey, 'SPO', 'prop/0' FROM part WHERE p_partkey % 3 = 0 AND p_partkey > 0 UNION ALL SELECT 'prop/' || p_partkey, 'DOMAIN', 'cls/' || (p_partkey % 25) FROM part
  UNION ALL SELECT 'prop/' || p_partkey, 'RANGE', 'cls/' || (100 + p_partkey % 5) FROM part WHERE p_partkey % 3 <> 1 UNION ALL SELECT 'cls/' || n_nationkey, 'SCO_RESTRICTION', 'cls/' || (100 + n_regionkey) FROM nation WHERE n_nationkey % 7 <> 0)""")
def onto_links(spark, d):
    """Hierarchies, domains, ranges, equivalents and restrictions; incomplete restrictions go."""
    return _ontology(spark, d).graph.edges.select("src", "type", "dst")


@query(f"""SELECT '{E}cls/' || n AS src, key, lex FROM (
  SELECT n_nationkey AS n, 'onPropertyURI' AS key, '{E}prop/' || n_nationkey AS lex FROM nation UNION ALL SELECT n_nationkey, 'onPropertyName', n_nationkey::VARCHAR FROM nation
  UNION ALL SELECT n_nationkey, 'restrictionType', CASE WHEN n_nationkey % 3 = 0 THEN 'MINQUALIFIEDCARDINALITY' ELSE 'SOME' END FROM nation UNION ALL SELECT n_nationkey, 'cardinalityVal', n_nationkey::VARCHAR FROM nation WHERE n_nationkey % 3 = 0) WHERE n % 7 <> 0""")
def onto_restrictions(spark, d):
    """What is known of a restriction, on its edge."""
    return _ontology(spark, d).graph.edge_props.select("src", "key", "lex")


@query(f"""SELECT '{E}prop/' || p_partkey AS uri, 'label' AS key, p_name AS lex, CASE WHEN p_partkey % 2 = 0 THEN 'en' ELSE 'de' END AS lang FROM part
  UNION ALL SELECT '{E}prop/' || p_partkey, 'propCharacteristics', 'Transitive', NULL FROM part WHERE p_partkey % 6 = 0
  UNION ALL SELECT '{E}cls/' || n_nationkey, 'name', n_nationkey::VARCHAR, NULL FROM nation UNION ALL SELECT '{E}cls/' || (100 + r_regionkey), 'name', (100 + r_regionkey)::VARCHAR, NULL FROM region""")
def onto_annotations(spark, d):
    """Labels with their language and characteristics of properties, names of classes; nothing of subjects never typed."""
    p = _ontology(spark, d, keepLangTag=True).graph.props
    return p.where(~((F.col("key") == "name") & ~F.col("uri").startswith(f"{E}cls/"))).select("uri", "key", "lex", "lang")


@query("""SELECT n + r + p + n + r + spo + p + rng + 2 * n + tr + p AS loaded, n + r + n + r + p + spo + p + rng + tr + p + gh + n + (SELECT count(*) FROM nation WHERE n_nationkey % 7 <> 0) + (SELECT count(*) FROM nation WHERE n_nationkey % 3 = 0) + n AS parsed FROM
  (SELECT (SELECT count(*) FROM nation) AS n, (SELECT count(*) FROM region) AS r, count(*) AS p, count(*) FILTER (p_partkey % 3 = 0 AND p_partkey > 0) AS spo, count(*) FILTER (p_partkey % 3 <> 1) AS rng, count(*) FILTER (p_partkey % 6 = 0) AS tr, count(*) FILTER (p_partkey % 10 = 0) AS gh FROM part)""")
def onto_counts(spark, d):
    """Statements loaded, without those of subjects never typed, and parsed."""
    got = _ontology(spark, d)
    return spark.createDataFrame([(got.triplesLoaded, got.triplesParsed)], "loaded long, parsed long")


@query(f"SELECT '{E}prop/' || p_partkey AS uri, 'gsch__label' AS key, p_name AS lex FROM part WHERE p_partkey % 2 = 0")
def onto_shorten_language(spark, d):
    """Names under the registered base prefix, labels of one language only."""
    got = onto.load_ontology(ontology_triples(spark, d), Catalog(GraphConfig()), ParserConfig(languageFilter="en"))
    return got.graph.props.where("key = 'gsch__label'").select("uri", "key", "lex")


# --- SKOS -----------------------------------------------------------------------------------------------------


def skos_triples(spark, d):
    """Parts as concepts in a tree, labelled directly and by SKOS-XL."""
    p = t(spark, d, "part")
    me, up, xl = _u("concept", "p_partkey"), _u("concept", "p_partkey div 3"), F.concat(L("_:l"), F.col("p_partkey"))
    return _union([
        _rows(p, me, L(TYPE), L(SKOS + "Concept")),
        _rows(p.where("p_partkey % 2 = 0"), me, L(SKOS + "broader"), up),
        _rows(p.where("p_partkey % 3 = 0"), up, L(SKOS + "narrower"), me),
        _rows(p.where("p_partkey % 5 = 0"), me, L(SKOS + "related"), _u("concept", "p_partkey div 2")),
        _rows(p, me, L(SKOS + "prefLabel"), F.col("p_name"), RDF + "langString", lang=L("en")),
        _rows(p.where("p_partkey % 2 = 1"), me, L(SKOS + "altLabel"), F.col("p_brand"), XSD + "string"),
        _rows(p, me, L(SKOSXL + "hiddenLabel"), xl),
        _rows(p, xl, L(SKOSXL + "literalForm"), F.concat(L("h"), F.col("p_partkey")), XSD + "string"),
    ])


_LINKED = "SELECT p_partkey AS a, 'SCO' AS type, p_partkey // 3 AS b FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 'RELATED', p_partkey // 2 FROM part WHERE p_partkey % 5 = 0"


@query(f"SELECT '{E}concept/' || a AS src, type, '{E}concept/' || b AS dst FROM ({_LINKED})")
def skos_hierarchy(spark, d):
    """Broader and narrower as one hierarchy, each link once; related beside it."""
    return onto.load_skos(skos_triples(spark, d), _catalog()).graph.edges.select("src", "type", "dst")


@query(f"SELECT DISTINCT '{E}concept/' || k AS uri, 'Class,Resource' AS labels FROM (SELECT p_partkey AS k FROM part UNION SELECT a FROM ({_LINKED}) UNION SELECT b FROM ({_LINKED}))")
def skos_concepts(spark, d):
    """Concepts and ends of links as classes."""
    return onto.load_skos(skos_triples(spark, d), _catalog()).graph.nodes.select("uri", F.array_join("labels", ",").alias("labels"))


@query(f"""SELECT '{E}concept/' || p_partkey AS uri, 'prefLabel' AS key, p_name AS lex, 'en' AS lang FROM part UNION ALL SELECT '{E}concept/' || p_partkey, 'altLabel', p_brand, NULL FROM part WHERE p_partkey % 2 = 1
  UNION ALL SELECT '{E}concept/' || p_partkey, 'hiddenLabel', 'h' || p_partkey, NULL FROM part""")
def skos_labels(spark, d):
    """Labels of concepts, direct ones and those behind a label node."""
    return onto.load_skos(skos_triples(spark, d), _catalog(keepLangTag=True)).graph.props.where("key <> 'name'").select("uri", "key", "lex", "lang")


# --- import and delete ----------------------------------------------------------------------------------------


@query(f"""SELECT 'http://ex.org/user/' || user_id AS uri, CASE WHEN mixed AND num AND NOT fst THEN event_id || '^^xsd__long' ELSE event_id::VARCHAR END AS value, CASE WHEN mixed OR NOT fst THEN 'string' ELSE 'long' END AS type
  FROM (SELECT *, bool_or(num <> fst) OVER (PARTITION BY user_id) AS mixed FROM ({_FIRST}))""")
def ingest_hetero_lenient(spark, d):
    """Values of several types become strings; those of another type than the first keep theirs behind."""
    g = ingest.load(event_triples(spark, d), _catalog(handleMultival="ARRAY"), ParserConfig(strictDataTypeCheck=False)).graph
    return g.props.where("key = 'mixed'").select("uri", F.col("lex").alias("value"), "type")


@query("SELECT 'http://ex.org/user/' || user_id AS uri, event_type AS value FROM (SELECT DISTINCT user_id, event_type FROM events EXCEPT SELECT user_id, event_type FROM events WHERE event_id % 3 = 0 AND user_id % 2 = 0)")
def delete_array_values(spark, d):
    """Single values leave a set of values; the others stay."""
    config = _catalog(handleMultival="ARRAY")
    g = ingest.load(event_triples(spark, d), config).graph
    e = t(spark, d, "events").where("event_id % 3 = 0 and user_id % 2 = 0")
    gone = _rows(e, tg.uri("user", "user_id"), L(NS + "last"), F.col("event_type"), XSD + "string")
    return delete.delete(g, gone, config).graph.props.where("key = 'last'").select("uri", F.col("lex").alias("value"))


@query("SELECT '1 statements with blank nodes were not deleted.' AS info, count(DISTINCT user_id) FILTER (user_id % 2 = 0) AS deleted, count(DISTINCT user_id) FILTER (user_id % 2 = 1) AS left_over FROM events")
def delete_labels(spark, d):
    """Types taken from some nodes; a statement on a blank node is counted, not deleted."""
    config = _catalog()
    g = ingest.load(event_triples(spark, d), config).graph
    e = t(spark, d, "events").where("user_id % 2 = 0").select("user_id").distinct()
    blank = _rows(spark.range(1), L("_:b"), L(TYPE), L(NS + "User"))
    got = delete.delete(g, _rows(e, tg.uri("user", "user_id"), L(TYPE), L(NS + "User")).unionByName(blank), config)
    left = got.graph.nodes.where(F.array_contains("labels", "User")).agg(F.count("*").alias("left_over"))
    return left.select(L(got.extraInfo).alias("info"), L(got.triplesDeleted).cast("long").alias("deleted"), "left_over")


@query("SELECT DISTINCT 'http://ex.org/user/' || user_id AS src, 'DID' AS type, 'kind/' || event_type AS dst, 'Resource,User' AS labels FROM events")
def ingest_naming(spark, d):
    """Relationship names in capitals, labels with a capital first."""
    rows = event_triples(spark, d).withColumn("object", F.when(F.col("predicate") == TYPE, NS + "user").otherwise(F.col("object")))
    g = ingest.load(rows, _catalog(applyNaming=True)).graph
    return g.edges.join(g.nodes.select(F.col("uri").alias("src"), "labels"), "src").select("src", "type", F.regexp_replace("dst", E, "").alias("dst"), F.array_join("labels", ",").alias("labels"))


@query(f"SELECT DISTINCT 'http://ex.org/user/' || user_id AS src, 'type' AS type, '{NS}User' AS dst FROM events")
def ingest_types_as_nodes(spark, d):
    """Types as edges to nodes, not as labels."""
    return ingest.load(event_triples(spark, d), _catalog(handleRDFTypes="NODES")).graph.edges.where("type = 'type'").select("src", "type", "dst")


@query(f"SELECT DISTINCT '{E}order/' || l_orderkey AS src, 'has' AS type, '{E}part/' || l_partkey AS dst, 'quantity' AS key, sum(l_quantity::BIGINT)::BIGINT::VARCHAR AS value FROM lineitem GROUP BY l_orderkey, l_partkey")
def ingest_edge_properties(spark, d):
    """Statements about statements become properties of edges."""
    q = t(spark, d, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"))
    spo = F.array(tg.uri("order", "l_orderkey"), L(NS + "has"), tg.uri("part", "l_partkey"))
    rows = _rows(q, F.concat(L("<< "), F.array_join(spo, " "), L(" >>")), L(NS + "quantity"), F.col("qty"), XSD + "long")
    rows = rows.drop("subjectSPO").withColumn("subjectSPO", F.split(F.regexp_replace("subject", "^<< | >>$", ""), " "))
    g = ingest.load(rows.select("subject", "predicate", "object", "isLiteral", "literalType", "literalLang", "subjectSPO", "graph", "ord"), _catalog()).graph
    return g.edge_props.select("src", F.col("type_").alias("type"), "dst", "key", F.col("lex").alias("value"))


@query("SELECT DISTINCT 'bnode://n' || n_nationkey AS src, 'near' AS type, 'bnode://r' || n_regionkey AS dst FROM nation")
def ingest_blank_nodes(spark, d):
    """Blank nodes get IRIs of their own scheme at either end."""
    n = t(spark, d, "nation")
    rows = _rows(n, F.concat(L("_:n"), F.col("n_nationkey")), L(NS + "near"), F.concat(L("_:r"), F.col("n_regionkey")))
    return ingest.load(rows, _catalog()).graph.edges.select("src", "type", "dst")


@query(f"SELECT '{E}part/' || p_partkey AS uri, p_name AS name FROM part WHERE p_partkey % 2 = 0")
def ingest_language_filter(spark, d):
    """Only values of the language, or of none, are loaded."""
    p = t(spark, d, "part")
    rows = _rows(p, tg.uri("part", "p_partkey"), L(NS + "name"), F.col("p_name"), RDF + "langString", lang=F.when(F.expr("p_partkey % 4 = 0"), "en").when(F.expr("p_partkey % 2 = 1"), "de"))
    g = ingest.load(rows, _catalog(), ParserConfig(languageFilter="en")).graph
    return g.props.select("uri", F.col("lex").alias("name"))


@query(f"SELECT '{E}customer/' || c_custkey AS uri, CASE WHEN c_custkey % 2 = 0 THEN 'Customer,Resource,Vip' ELSE 'Customer,Resource' END AS labels, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE c_name END AS name FROM customer")
def merge_into_graph(spark, d):
    """A second import unites labels and replaces single values."""
    c, config = t(spark, d, "customer"), _catalog()
    me = tg.uri("customer", "c_custkey")
    first = ingest.load(_rows(c, me, L(TYPE), L(NS + "Customer")).unionByName(_rows(c, me, L(NS + "name"), F.col("c_name"), XSD + "string")), config).graph
    even = c.where("c_custkey % 2 = 0")
    g = ingest.load(_rows(even, me, L(TYPE), L(NS + "Vip")).unionByName(_rows(even, me, L(NS + "name"), L("new"), XSD + "string")), config, into=first).graph
    return g.nodes.select("uri", F.array_join("labels", ",").alias("labels")).join(g.props.where("key = 'name'").select("uri", F.col("lex").alias("name")), "uri")


@query("SELECT count(*) FILTER (o_orderkey % 2 = 1) AS n, o_orderstatus AS status FROM orders GROUP BY 2")
def quad_delete(spark, d):
    """Edges of one named graph are deleted there only."""
    config = _catalog()
    g = ingest.load(_quads(spark, d), config).graph
    gone = _quads(spark, d).where(F.col("predicate") == NS + "ordered").where(F.regexp_extract("object", "([0-9]+)$", 1).cast("long") % 2 == 0)
    left = delete.delete(g, gone, config).graph.edges
    every = g.edges.select("graph").distinct().join(left.groupBy("graph").agg(F.count("*").alias("n")), "graph", "left")
    return every.select(F.coalesce("n", L(0)).cast("long").alias("n"), F.regexp_extract("graph", "([A-Z])$", 1).alias("status"))


# --- export in RDF mode ---------------------------------------------------------------------------------------

_EVENT_FACTS = f"""SELECT DISTINCT 'http://ex.org/user/' || user_id AS subject, '{TYPE}' AS predicate, '{NS}User' AS object, false AS isLiteral, NULL AS literalType FROM events
  UNION ALL SELECT DISTINCT 'http://ex.org/user/' || user_id, '{NS}last', event_type, true, '{XSD}string' FROM events UNION ALL SELECT DISTINCT 'http://ex.org/user/' || user_id, '{NS}did', 'http://ex.org/kind/' || event_type, false, NULL FROM events"""


def _exported(mode: str):
    def run(spark, d):
        catalog = Catalog(GraphConfig(handleVocabUris=mode, handleMultival="ARRAY"))
        g = ingest.load(event_triples(spark, d), catalog, ParserConfig(predicateExclusionList=(NS + "mixed",))).graph
        return export.triples_view(g, catalog).select("subject", "predicate", "object", "isLiteral", "literalType")

    run.__doc__ = f"Statements imported under {mode} come out with their IRIs."
    return run


query(_EVENT_FACTS, "export_shorten")(_exported("SHORTEN"))
query(_EVENT_FACTS, "export_keep")(_exported("KEEP"))


@query(f"""SELECT '{E}part/' || p_partkey AS subject, '{NS}label' AS predicate, p_name AS object, '{RDF}langString' AS literalType, CASE WHEN p_partkey % 2 = 0 THEN 'en' ELSE 'fr' END AS literalLang FROM part
  UNION ALL SELECT '{E}part/' || p_partkey, '{NS}weight', p_size::VARCHAR, '{NS}kg', NULL FROM part UNION ALL SELECT '{E}part/' || p_partkey, '{NS}size', p_size::VARCHAR, '{XSD}long', NULL FROM part""")
def export_languages_and_datatypes(spark, d):
    """Languages and custom datatypes that were kept are exported again."""
    p, me = t(spark, d, "part"), tg.uri("part", "p_partkey")
    rows = _union([
        _rows(p, me, L(NS + "label"), F.col("p_name"), RDF + "langString", lang=F.when(F.expr("p_partkey % 2 = 0"), "en").otherwise("fr")),
        _rows(p, me, L(NS + "weight"), F.col("p_size"), NS + "kg"),
        _rows(p, me, L(NS + "size"), F.col("p_size"), XSD + "int"),
    ])
    catalog = Catalog(GraphConfig(keepLangTag=True, keepCustomDataTypes=True))
    return export.triples_view(ingest.load(rows, catalog).graph, catalog).select("subject", "predicate", "object", "literalType", "literalLang")


@query(f"SELECT 'http://ex.org/customer/' || o_custkey AS subject, '{NS}ordered' AS predicate, '{E}order/' || o_orderkey AS object FROM orders WHERE o_custkey = 5 AND o_orderstatus = 'F' UNION ALL SELECT 'http://ex.org/customer/5', '{NS}latest', max(o_orderkey)::VARCHAR FROM orders WHERE o_custkey = 5 AND o_orderstatus = 'F' HAVING count(*) > 0")
def describe_in_graph(spark, d):
    """A node's statements in one named graph, in RDF mode."""
    catalog = Catalog(GraphConfig())
    g = ingest.load(_quads(spark, d), catalog).graph
    return export.describe(g, f"{E}customer/5", catalog, f"{E}graph/F").select("subject", "predicate", "object")


@query(f"SELECT 'http://ex.org/user/' || user_id AS subject, event_type AS object FROM events WHERE user_id = 3 GROUP BY ALL")
def spo_rdf_mode(spark, d):
    """A pattern over a graph with short names."""
    catalog = Catalog(GraphConfig(handleMultival="ARRAY"))
    g = ingest.load(event_triples(spark, d), catalog, ParserConfig(predicateExclusionList=(NS + "mixed",))).graph
    return export.spo(export.triples_view(g, catalog), "http://ex.org/user/3", NS + "last").select("subject", "object")


# --- documents ------------------------------------------------------------------------------------------------


PARSED = "k int, subject string, predicate string, object string, literalType string"


def _documents(fmt: str, name: str):
    """Groups of statements written as documents and parsed again, both on executors."""

    def run(spark, d):
        view = export.triples_view(tg.graph(spark, d), rel_props=False).where(F.col("subject").startswith(f"{E}nation/") | F.col("subject").startswith(f"{E}supplier/"))
        view = view.withColumn("k", F.expr("cast(regexp_extract(subject, '([0-9]+)$', 1) as int) % 7"))
        texts = collect.collect(view, fmt, "k", prefixes={"b": BASE})

        def parsed(batches):
            import pandas as pd

            for b in batches:
                rows = [(int(k), s.subject, s.predicate, s.object, s.literalType) for k, x in zip(b["k"], b["rdf"], strict=True) for s in parse_text(x, name)]
                yield pd.DataFrame(rows, columns=["k", "subject", "predicate", "object", "literalType"])

        return texts.mapInPandas(parsed, PARSED)

    run.__doc__ = f"Statements written as {name} and parsed again."
    return run


_NATIONS = f"WITH {tg.triples_sql()} SELECT regexp_extract(subject, '([0-9]+)$', 1)::INTEGER % 7 AS k, subject, predicate, object, literalType FROM triples WHERE subject LIKE '{E}nation/%' OR subject LIKE '{E}supplier/%'"
query(_NATIONS, "turtle_round_trip")(_documents("ttl", "Turtle"))
query(_NATIONS, "rdfxml_round_trip")(_documents("xml", "RDF/XML"))
query(_NATIONS, "jsonld_round_trip")(_documents("json", "JSON-LD"))
_QTY = f"SELECT l_orderkey % 7 AS k, '{E}order/' || l_orderkey AS subject, '{BASE}qty' AS predicate, sum(l_quantity::BIGINT)::BIGINT::VARCHAR AS object, '{XSD}long' AS literalType FROM lineitem GROUP BY l_orderkey, l_partkey"


@query(_QTY.replace("l_orderkey % 7", "(l_orderkey % 7)::INTEGER"))
def turtle_star_round_trip(spark, d):
    """Statements about statements written as Turtle-star and parsed again; a group as many documents as it takes."""
    g = tg.graph(spark, d)
    view = export.triples_view(g.with_(nodes=g.nodes.limit(0), props=g.props.limit(0), edges=g.edges.limit(0)))
    view = view.withColumn("k", F.expr("cast(regexp_extract(subject, 'order/([0-9]+)', 1) as int) % 7"))

    def parsed(key, text):
        return [(*key, s.subjectSPO[0], s.predicate, s.object, s.literalType) for s in parse_text(text, "Turtle-star") if s.predicate.endswith("qty")]

    return collect.collect_parts(view, "ttlstar", "k", prefixes={"b": BASE}, then=parsed, schema=PARSED)


@query("SELECT n_nationkey AS k, n_name || chr(9) || chr(233) || chr(128512) || chr(92) || 'U0001F600' || chr(34) || chr(10) || chr(128512) AS object FROM nation")
def ntriples_escapes(spark, d):
    """All kinds of escapes of N-Triples strings, those beyond U+FFFF and escaped backslashes among them."""
    n = t(spark, d, "nation")
    text = F.concat(L(f"<{E}nation/"), F.col("n_nationkey"), L(f'> <{BASE}name> "'), F.col("n_name"), L('\\t\\u00E9\\U0001F600\\\\U0001F600\\"\\n\U0001f600" .'))
    return _lines(n.select(text.alias("value")), ParserConfig()).select(F.regexp_extract("subject", "([0-9]+)$", 1).cast("int").alias("k"), "object")


# --- inference over a stored ontology ---------------------------------------------------------------------------


def _rel_engine(spark, d) -> Engine:
    """Nations and regions as classes, suppliers as relationships: from their nation, odd ones from the one before's too."""
    n, r, s = t(spark, d, "nation"), t(spark, d, "region"), t(spark, d, "supplier")
    null = F.lit(None).cast("string")
    nodes = _union([x.select(u.alias("uri"), null.alias("graph"), F.array(L(k)).alias("labels")) for x, u, k in ((n, _u("nation", "n_nationkey"), "Class"), (r, _u("region", "r_regionkey"), "Class"), (s, _u("supplier", "s_suppkey"), "Relationship"))])
    named = lambda x, u, c: x.select(u.alias("uri"), null.alias("graph"), L("name").alias("key"), L(0).cast("long").alias("ord"), L("string").alias("type"), F.col(c).alias("lex"), null.alias("lang"), null.alias("datatype"))
    props = _union([named(n, _u("nation", "n_nationkey"), "n_name"), named(r, _u("region", "r_regionkey"), "r_name"), named(s, _u("supplier", "s_suppkey"), "s_name")])
    edge = lambda x, a, k, b: x.select(a.alias("src"), L(k).alias("type"), b.alias("dst"), null.alias("graph"))
    me = _u("supplier", "s_suppkey")
    before = s.select((F.col("s_suppkey") + 1).alias("s_suppkey"), F.col("s_nationkey").alias("old")).where("s_suppkey % 2 = 1").join(s.select("s_suppkey"), "s_suppkey")
    edges = _union([
        edge(n, _u("nation", "n_nationkey"), "SCO", _u("region", "n_regionkey")),
        edge(s, me, "DOMAIN", _u("nation", "s_nationkey")), edge(before, me, "DOMAIN", _u("nation", "old")),
        edge(s, me, "RANGE", _u("region", "s_suppkey % 5")), edge(before, me, "SPO", _u("supplier", "s_suppkey - 1")),
    ]).distinct()
    return Engine(spark, Graph(nodes, props, edges, Graph.empty(spark).edge_props), Catalog(GraphConfig(handleVocabUris="IGNORE")))


_DOMAINS = """WITH dom AS (SELECT s_suppkey AS s, s_nationkey AS n FROM supplier UNION SELECT b.s_suppkey, a.s_nationkey FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1 AND b.s_suppkey % 2 = 1),
  named AS (SELECT n_name AS node, s_name AS term, s FROM dom JOIN nation ON n_nationkey = n JOIN supplier ON s_suppkey = s)"""


@query(f"{_DOMAINS} SELECT node, term FROM named a WHERE NOT EXISTS (SELECT 1 FROM named b WHERE b.node = a.node AND b.s = a.s + 1 AND b.s % 2 = 1)")
def class_outgoing_rels(spark, d):
    """Relationships from each class; one gives way to a more special one from there."""
    e = _rel_engine(spark, d)
    starts = t(spark, d, "nation").select(F.col("n_name").alias("node"))
    return infer.class_terms(starts, e._classes(), e._named_links("DOMAIN", "Relationship"), e._properties("Relationship"))


@query("SELECT n_name AS node, s_name AS term FROM nation JOIN supplier ON s_suppkey % 5 = n_regionkey")
def class_incoming_rels(spark, d):
    """Relationships into each nation, inherited from its region."""
    e = _rel_engine(spark, d)
    starts = t(spark, d, "nation").select(F.col("n_name").alias("node"))
    return infer.class_terms(starts, e._classes(), e._named_links("RANGE", "Relationship"), e._properties("Relationship"), True)


@query(f"{_DOMAINS}, up AS (SELECT s_suppkey AS s, s_suppkey AS a FROM supplier UNION ALL SELECT b.s_suppkey, a.s_suppkey FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1 AND b.s_suppkey % 2 = 1) SELECT DISTINCT s_name AS node, n_name AS term FROM up JOIN supplier ON s_suppkey = up.s JOIN dom ON dom.s = up.a JOIN nation ON n_nationkey = n")
def rel_source_classes(spark, d):
    """Classes that each relationship comes from, its own and those of the one above it."""
    e = _rel_engine(spark, d)
    links = e._named_links("DOMAIN", "Relationship").select(F.col("term").alias("end"), F.col("end").alias("term"))
    return infer.rel_classes(t(spark, d, "supplier").select(F.col("s_name").alias("node")), e._properties("Relationship"), links, e._classes(), True)


@query(f"""WITH RECURSIVE {tg.TREE_SQL}, up(node, anc, n) AS (SELECT i, i, 0 FROM (SELECT unnest(range(10, 31)) AS i) UNION ALL SELECT node, parent, n + 1 FROM up JOIN tree ON child = anc),
  p AS (SELECT i AS a, i + 1 AS b FROM (SELECT unnest(range(10, 30)) AS i)), m AS (SELECT a, b, x.n + y.n AS n FROM p JOIN up x ON x.node = a JOIN up y ON y.node = b AND y.anc = x.anc)
  SELECT a::VARCHAR AS a, b::VARCHAR AS b, min(n)::INTEGER AS steps FROM m GROUP BY ALL""")
def pathsim_path(spark, d):
    """The steps between neighbours in a tree, up to where they meet and down."""
    e = tg.tree(spark, d).select(F.col("child").cast("string").alias("child"), F.col("parent").cast("string").alias("parent"))
    pairs = spark.createDataFrame([(str(i), str(i + 1)) for i in range(10, 30)], "a string, b string")
    return similarity.paths(e, pairs).select("a", "b", F.size("path").alias("steps"))
