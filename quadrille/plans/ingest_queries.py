"""Import, delete, quads, aggregates and JSON trees over triples made from the tables, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import Catalog, GraphConfig
from ..model import BASE, TYPE, XSD
from ..operators import collect, delete, export, ingest

from . import tablegraph as tg
from .graph_queries import E, query, t

NS = "http://ex.org/voc#"


def _rows(frame, subject, predicate, obj, literal=None, ord_=None, graph=None, lang=None):
    null = F.lit(None).cast("string")
    return frame.select(subject.alias("subject"), predicate.alias("predicate"), obj.cast("string").alias("object"), F.lit(literal is not None).alias("isLiteral"), (null if literal is None else F.lit(literal) if isinstance(literal, str) else literal).alias("literalType"), (null if lang is None else lang).alias("literalLang"), F.lit(None).cast("array<string>").alias("subjectSPO"), (null if graph is None else graph).alias("graph"), (F.lit(0) if ord_ is None else ord_).cast("long").alias("ord"))


def event_triples(spark, d):
    """Users with the types, values and times of their events, in the order of events."""
    e, voc = t(spark, d, "events"), lambda n: F.lit(NS + n)
    user, o = tg.uri("user", "user_id"), F.col("event_id")
    kind = F.when(o % 5 == 0, XSD + "integer").otherwise(XSD + "string")
    return (
        _rows(e, user, F.lit(TYPE), voc("User"), ord_=o)
        .unionByName(_rows(e, user, voc("last"), F.col("event_type"), XSD + "string", o))
        .unionByName(_rows(e, user, voc("mixed"), o, kind, o))
        .unionByName(_rows(e, user, voc("did"), F.concat(F.lit(f"{E}kind/"), F.col("event_type")), ord_=o))
    )


def _catalog(**params) -> Catalog:
    return Catalog(GraphConfig(handleVocabUris="IGNORE", **params))


@query("SELECT DISTINCT 'http://ex.org/user/' || user_id AS uri, last_value(event_type) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS value FROM events")
def ingest_overwrite_last_wins(spark, d):
    """The last value in document order stays."""
    g = ingest.load(event_triples(spark, d), _catalog()).graph
    return g.props.where("key = 'last'").select("uri", F.col("lex").alias("value"))


@query("SELECT DISTINCT 'http://ex.org/user/' || user_id AS uri, event_type AS value FROM events")
def ingest_array_distinct(spark, d):
    """All values stay, each once."""
    g = ingest.load(event_triples(spark, d), _catalog(handleMultival="ARRAY")).graph
    return g.props.where("key = 'last'").select("uri", F.col("lex").alias("value"))


_FIRST = "SELECT user_id, event_id, event_id % 5 = 0 AS num, first_value(event_id % 5 = 0) OVER (PARTITION BY user_id ORDER BY event_id) AS fst FROM events"


@query(f"SELECT 'http://ex.org/user/' || user_id AS uri, event_id::VARCHAR AS value, CASE WHEN num THEN 'long' ELSE 'string' END AS type FROM ({_FIRST}) WHERE num = fst")
def ingest_hetero_strict(spark, d):
    """Values of another type than the first one's are dropped."""
    g = ingest.load(event_triples(spark, d), _catalog(handleMultival="ARRAY")).graph
    return g.props.where("key = 'mixed'").select("uri", F.col("lex").alias("value"), "type")


@query("SELECT DISTINCT 'http://ex.org/user/' || user_id AS src, 'did' AS type, 'http://ex.org/kind/' || event_type AS dst FROM events")
def ingest_edge_dedup(spark, d):
    """One edge for repeated statements."""
    return ingest.load(event_triples(spark, d), _catalog()).graph.edges.select("src", "type", "dst")


@query("SELECT DISTINCT 'http://ex.org/user/' || user_id AS uri, 'Resource,User' AS labels FROM events UNION ALL SELECT DISTINCT 'http://ex.org/kind/' || event_type, 'Resource' FROM events")
def ingest_labels(spark, d):
    """Nodes with their labels, ends of edges included."""
    return ingest.load(event_triples(spark, d), _catalog()).graph.nodes.select("uri", F.array_join("labels", ",").alias("labels"))


@query(f"SELECT 4 * (SELECT count(*) FROM events) AS parsed, 3 * (SELECT count(*) FROM events) - (SELECT count(*) FROM ({_FIRST}) WHERE num <> fst) AS loaded")
def ingest_counts(spark, d):
    """Statements parsed and loaded, with an excluded predicate and values dropped for their type."""
    from ..config import ParserConfig

    r = ingest.load(event_triples(spark, d), _catalog(handleMultival="ARRAY"), ParserConfig(predicateExclusionList=(NS + "did",)))
    return spark.createDataFrame([(r.triplesParsed, r.triplesLoaded)], "parsed long, loaded long")


def _quads(spark, d):
    o = t(spark, d, "orders")
    at = F.concat(F.lit(f"{E}graph/"), F.col("o_orderstatus"))
    s = tg.uri("customer", "o_custkey")
    return _rows(o, s, F.lit(NS + "ordered"), tg.uri("order", "o_orderkey"), ord_=F.col("o_orderkey"), graph=at).unionByName(_rows(o, s, F.lit(NS + "latest"), F.col("o_orderkey"), XSD + "long", F.col("o_orderkey"), at))


@query("SELECT 'http://ex.org/customer/' || o_custkey AS uri, 'http://ex.org/graph/' || o_orderstatus AS graph, max(o_orderkey)::VARCHAR AS latest, count(*) AS edges FROM orders GROUP BY ALL")
def quad_by_graph(spark, d):
    """A node has its own properties and edges in each named graph."""
    g = ingest.load(_quads(spark, d), _catalog()).graph
    edges = g.edges.groupBy(F.col("src").alias("uri"), "graph").agg(F.count("*").alias("edges"))
    return g.props.where("key = 'latest'").select("uri", "graph", F.col("lex").alias("latest")).join(edges, ["uri", "graph"])


@query("SELECT predicate, count(*) AS n FROM (SELECT 'name' AS predicate FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT 'acctbal' FROM customer UNION ALL SELECT 'mktsegment' FROM customer UNION ALL SELECT 'IN_CATEGORY' FROM customer WHERE c_custkey % 5 <> 0) GROUP BY 1")
def delete_triples(spark, d):
    """What is left of customers after names and categories of some are deleted."""
    g = _customers(spark, d)
    c = t(spark, d, "customer")
    gone = _rows(c.where("c_custkey % 3 = 0"), tg.uri("customer", "c_custkey"), F.lit(BASE + "name"), F.col("c_name"), XSD + "string").unionByName(_rows(c.where("c_custkey % 5 = 0"), tg.uri("customer", "c_custkey"), F.lit(BASE + "IN_CATEGORY"), tg.uri("nation", "c_nationkey")))
    left = delete.delete(g, gone, _catalog()).graph
    return left.props.select(F.col("key").alias("predicate")).unionByName(left.edges.select(F.col("type").alias("predicate"))).groupBy("predicate").agg(F.count("*").alias("n"))


def _customers(spark, d):
    g = tg.graph(spark, d)
    mine = F.col("uri").startswith(f"{E}customer/")
    nations = g.edges.where((F.col("type") == "IN_CATEGORY") & F.col("src").startswith(f"{E}customer/"))
    bare = nations.select(F.col("dst").alias("uri")).distinct().select("uri", F.lit(None).cast("string").alias("graph"), F.array(F.lit("Resource")).alias("labels"))
    return tg.Graph(g.nodes.where(mine).unionByName(bare), g.props.where(mine), nations, g.edge_props.limit(0))


@query("SELECT 'http://ex.org/nation/' || n_nationkey AS uri FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey <> 3) AND n_nationkey IN (SELECT c_nationkey FROM customer)")
def delete_orphans(spark, d):
    """Nodes without label, property and edge vanish with their last edge."""
    g, c = _customers(spark, d), t(spark, d, "customer").where("c_nationkey = 3")
    gone = _rows(c, tg.uri("customer", "c_custkey"), F.lit(BASE + "IN_CATEGORY"), tg.uri("nation", "c_nationkey"))
    left = delete.delete(g, gone, _catalog()).graph
    return g.nodes.select("uri").join(left.nodes.select("uri"), "uri", "left_anti")


@query(f"SELECT c_nationkey AS nation, string_agg('<{E}customer/' || c_custkey || '> <{BASE}acctbal> \"' || c_acctbal::VARCHAR || '\"^^<{XSD}double> .', chr(10) ORDER BY '<{E}customer/' || c_custkey || '> <{BASE}acctbal> \"' || c_acctbal::VARCHAR || '\"^^<{XSD}double> .') || chr(10) AS rdf FROM customer GROUP BY 1")
def collect_nt(spark, d):
    """Statements of a group as one N-Triples text."""
    view = export.triples_view(tg.graph(spark, d)).where(F.col("predicate") == BASE + "acctbal")
    nation = t(spark, d, "customer").select(tg.uri("customer", "c_custkey").alias("subject"), F.col("c_nationkey").alias("nation"))
    return collect.collect_nt(view.join(nation, "subject"), "nation")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS object FROM events")
def json_tree(spark, d):
    """JSON documents hung on nodes as triples, parsed a batch at a time."""
    import pandas as pd

    from ..sources.jsonld import VOCAB
    from ..sources.jsonld import json_tree as tree

    def run(batches):
        for b in batches:
            rows = [(k, s.object) for k, x in zip(b["event_id"], b["props"], strict=True) for s in tree(x, f"{E}event/{k}", NS + "props") if s.predicate == VOCAB + "k"]
            yield pd.DataFrame(rows, columns=["event_id", "object"])

    return t(spark, d, "events").select("event_id", "props").mapInPandas(run, "event_id long, object string")


@query("SELECT n_nationkey AS k, 'http://ex.org/nation/' || n_nationkey AS subject, n_name AS object FROM nation")
def ntriples_round_trip(spark, d):
    """Statements written as N-Triples lines and read back by the line parser."""
    from ..config import ParserConfig
    from ..sources.readers import _lines
    from ..sources.writers import line

    n = t(spark, d, "nation")
    text = _rows(n, tg.uri("nation", "n_nationkey"), F.lit(BASE + "name"), F.col("n_name"), XSD + "string").select(line().alias("value"))
    return _lines(text, ParserConfig()).select(F.regexp_extract("subject", "([0-9]+)$", 1).cast("int").alias("k"), "subject", "object")


