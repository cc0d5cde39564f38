"""Queries over the table graph, each beside the DuckDB SQL that checks it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import Catalog, GraphConfig, Mappings, Prefixes
from ..functions import iri, literals
from ..model import BASE, TYPE, XSD
from ..operators import closure, export, infer, similarity
from ..registry import ORACLES, QUERIES
from . import tablegraph as tg

T = tg.triples_sql()
E = tg.ROOT


def query(sql: str | None = None, name: str | None = None):
    def add(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn

    return add


def view(spark, d):
    return export.triples_view(tg.graph(spark, d), rel_props=False)


def t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


SPO = ("subject", "predicate", "object", "isLiteral", "literalType")
_S = "SELECT subject, predicate, object, isLiteral, literalType FROM triples WHERE"


def _pattern(name: str, where: str, **bound):
    QUERIES[name] = lambda spark, d: export.spo(view(spark, d), **bound).select(*SPO)
    ORACLES[name] = f"WITH {T} {_S} {where}"


_pattern("spo_predicate", f"predicate = '{BASE}acctbal'", predicate=BASE + "acctbal")
_pattern("spo_subject", f"subject = '{E}customer/7'", subject=E + "customer/7")
_pattern("spo_subject_predicate", f"subject = '{E}part/5' AND predicate = '{BASE}name'", subject=E + "part/5", predicate=BASE + "name")
_pattern("spo_object_iri", f"object = '{E}nation/3' AND NOT isLiteral", object_=E + "nation/3")
_pattern("spo_object_literal", f"object = 'BUILDING' AND isLiteral AND literalType = '{XSD}string'", object_="BUILDING", is_literal=True)
_pattern("spo_predicate_object", f"predicate = '{BASE}IN_CATEGORY' AND object = '{E}nation/3' AND NOT isLiteral", predicate=BASE + "IN_CATEGORY", object_=E + "nation/3")
_pattern("spo_predicate_typed_literal", f"predicate = '{BASE}size' AND object = '7' AND isLiteral AND literalType = '{XSD}long'", predicate=BASE + "size", object_="7", is_literal=True, literal_type=XSD + "integer")
_pattern("spo_subject_object", f"subject = '{E}nation/3' AND object = '{E}region/' || (SELECT n_regionkey FROM nation WHERE n_nationkey = 3) AND NOT isLiteral", subject=E + "nation/3", object_=E + "region/3")
_pattern("spo_all_bound", f"subject = '{E}nation/7' AND predicate = '{TYPE}' AND object = '{BASE}Nation' AND NOT isLiteral", subject=E + "nation/7", predicate=TYPE, object_=BASE + "Nation")
ORACLES["spo_subject_object"] = f"WITH {T} {_S} subject = '{E}nation/3' AND object = '{E}region/3' AND NOT isLiteral"


@query(f"WITH {T} SELECT predicate, isLiteral, count(*) AS n, count(DISTINCT subject) AS subjects FROM triples GROUP BY ALL")
def spo_unbound_counts(spark, d):
    """All statements, counted by predicate."""
    return view(spark, d).groupBy("predicate", "isLiteral").agg(F.count("*").alias("n"), F.count_distinct("subject").alias("subjects"))


# --- scalar functions -----------------------------------------------------------------------------------------

_LOCAL = r"CASE WHEN contains(url, '#') THEN regexp_extract(url, '([^#]*)$', 1) WHEN contains(url, '/') THEN regexp_extract(url, '([^/]*)$', 1) WHEN contains(url, ':') THEN regexp_extract(url, '([^:]*)$', 1) END"
_TAGGED = "text || '@' || lang"


@query(f"SELECT page_id, {_LOCAL} AS local_name, substring(url, 1, length(url) - length({_LOCAL})) AS namespace FROM pages")
def iri_local_name(spark, d):
    """Local names and namespaces of page addresses."""
    return t(spark, d, "pages").select("page_id", iri.local_name("url").alias("local_name"), iri.namespace("url").alias("namespace"))


@query("SELECT page_id, regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*:[^\\s<>\"{}|\\\\^`]*$') AS ok, regexp_matches(html, '^[A-Za-z][A-Za-z0-9+.-]*:[^\\s<>\"{}|\\\\^`]*$') AS no FROM pages")
def is_iri(spark, d):
    """Which texts are IRIs."""
    return t(spark, d, "pages").select("page_id", iri.is_iri("url").alias("ok"), iri.is_iri("html").alias("no"))


@query("SELECT doc_id, lang AS tag, text AS value, lang = 'en' AS is_en, CASE WHEN lang = 'en' THEN text END AS en FROM documents")
def lang_functions(spark, d):
    """Tag, value, test and selection of language-tagged texts."""
    tagged = F.concat("text", F.lit("@"), "lang")
    return t(spark, d, "documents").select("doc_id", literals.lang_tag(tagged).alias("tag"), literals.value_of(tagged).alias("value"), literals.has_lang_tag("en", tagged).alias("is_en"), literals.lang_value("en", tagged).alias("en"))


@query("SELECT p_partkey, 'http://ex.org/money' AS dt, CAST(p_retailprice AS VARCHAR) AS value, 'http://www.w3.org/2001/XMLSchema#string' AS plain FROM part")
def data_type(spark, d):
    """Datatype and value of suffixed and plain strings."""
    typed = F.concat(F.col("p_retailprice").cast("string"), F.lit("^^http://ex.org/money"))
    return t(spark, d, "part").select("p_partkey", literals.datatype(typed).alias("dt"), literals.value_of(typed).alias("value"), literals.datatype("p_name").alias("plain"))


@query("SELECT doc_id, lang || ':' || source AS first_de FROM documents WHERE lang = 'de'")
def lang_value_of_list(spark, d):
    """The first value in a language out of a list of tagged values."""
    values = F.array(F.lit("plain"), F.concat("lang", F.lit(":"), "source", F.lit("@"), "lang"))
    return t(spark, d, "documents").select("doc_id", literals.lang_value_of("de", values).alias("first_de")).where("first_de is not null")


@query("SELECT s_suppkey, CAST(s_suppkey AS DOUBLE) AS x, s_acctbal AS y, 'Point(' || CAST(CAST(s_suppkey AS DOUBLE) AS VARCHAR) || ' ' || CAST(s_acctbal AS VARCHAR) || ')' AS text FROM supplier")
def wkt_points(spark, d):
    """Points parsed from WKT and written again."""
    wkt = F.concat(F.lit("POINT ("), F.col("s_suppkey").cast("string"), F.lit(" "), F.col("s_acctbal").cast("string"), F.lit(")"))
    p = literals.point(wkt)
    return t(spark, d, "supplier").select("s_suppkey", p["x"].alias("x"), p["y"].alias("y"), literals.point_text(wkt).alias("text"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, epoch(o_orderdate)::BIGINT AS seconds, true AS is_date, false AS is_time FROM orders")
def date_parsing(spark, d):
    """Dates and date-times from their lexical forms, and the datatype check."""
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    stored = literals.stored_type(F.lit(XSD + "date"), day)
    return t(spark, d, "orders").select("o_orderkey", literals.parse_date(day).cast("string").alias("day"), F.unix_timestamp(literals.parse_datetime(F.concat(stamp, F.lit("Z")))).alias("seconds"), literals.check("date", stored, day).alias("is_date"), literals.check("time", stored, day).alias("is_time"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'long' WHEN event_id % 4 = 1 THEN 'double' WHEN event_id % 4 = 2 THEN 'string' ELSE 'boolean' END AS stored, CASE WHEN event_id % 4 = 1 THEN CAST(CAST(event_id AS DOUBLE) AS VARCHAR) WHEN event_id % 4 = 3 THEN 'true' ELSE CAST(event_id AS VARCHAR) END AS lex FROM events")
def typed_literals(spark, d):
    """Typing of literals by datatype; what the datatype doesn't allow is a string."""
    kind = F.concat(F.lit(XSD), F.element_at(F.array(*map(F.lit, ("integer", "decimal", "dateTime", "boolean"))), (F.col("event_id") % 4 + 1).cast("int")))
    lex = F.when(F.col("event_id") % 4 == 3, "1").otherwise(F.col("event_id").cast("string"))
    stored = literals.stored_type(kind, lex)
    return t(spark, d, "events").select("event_id", stored.alias("stored"), literals.canonical(stored, lex).alias("lex"))


def _page_prefixes() -> dict[str, str]:
    p = Prefixes()
    p.add("ex", E + "nation/")
    return p.all()


@query(f"SELECT n_nationkey, 'ex__' || n_nationkey AS short, '{E}nation/' || n_nationkey AS full_iri FROM nation")
def shorten_expand_iri(spark, d):
    """IRIs to short forms by prefix and back."""
    short = iri.shorten(tg.uri("nation", "n_nationkey"), _page_prefixes())
    return t(spark, d, "nation").select("n_nationkey", short.alias("short"), iri.expand(short, _page_prefixes()).alias("full_iri"))


@query(f"WITH {T} SELECT subject, replace(replace(predicate, '{BASE}acctbal', 'http://schema.org/balance'), '{BASE}name', 'http://schema.org/name') AS predicate, object FROM triples WHERE predicate IN ('{BASE}acctbal', '{BASE}name')")
def map_vocab(spark, d):
    """Export under a vocabulary mapping, mapped elements only."""
    c = Catalog(GraphConfig(handleVocabUris="MAP"))
    c.mappings = Mappings()
    for name, term in (("acctbal", "balance"), ("name", "name")):
        c.mappings.add("http://schema.org/" + term, name, c.prefixes)
    return export.triples_view(tg.graph(spark, d), c, mapped_only=True).select("subject", "predicate", "object")


# --- hierarchies ----------------------------------------------------------------------------------------------

_UP = "WITH RECURSIVE {v}, up AS (SELECT child AS node, parent AS ancestor, 1 AS depth FROM {n} UNION {a} SELECT u.node, e.parent, u.depth + 1 FROM up u JOIN {n} e ON e.child = u.ancestor)"
TREE_UP = _UP.format(v=tg.TREE_SQL, n="tree", a="ALL")
DAG_UP = _UP.format(v=tg.DAG_SQL, n="dag", a="")


@query(f"{TREE_UP} SELECT node, ancestor, depth FROM up")
def closure_tree(spark, d):
    """All ancestors in a tree, by one recursive query."""
    return closure.forest_ancestors(tg.tree(spark, d))


@query(f"{DAG_UP} SELECT node, ancestor, min(depth) AS depth FROM up GROUP BY ALL UNION ALL SELECT DISTINCT child, child, 0 FROM dag")
def closure_up(spark, d):
    """All ancestors and the shortest way to each, in a hierarchy with diamonds."""
    return closure.ancestors(tg.dag(spark, d))


@query(f"{DAG_UP} SELECT ancestor AS root, node, min(depth) AS depth FROM up WHERE ancestor IN (2, 5) GROUP BY ALL")
def closure_down(spark, d):
    """All below two roots."""
    return closure.descendants(tg.dag(spark, d), spark.createDataFrame([(2,), (5,)], "root long"), reflexive=False)


@query(f"WITH RECURSIVE {tg.DAG_SQL}, up AS (SELECT DISTINCT child AS node, child AS ancestor, 0 AS depth FROM dag UNION ALL SELECT u.node, e.parent, u.depth + 1 FROM up u JOIN dag e ON e.child = u.ancestor) SELECT node, ancestor, count(*) AS paths, max(depth) AS longest FROM up GROUP BY ALL")
def closure_path_count(spark, d):
    """Numbers of ways and the longest one."""
    return closure.path_counts(tg.dag(spark, d))


@query(f"WITH {tg.DAG_SQL} SELECT child AS node, 'leaf' AS kind FROM dag WHERE child NOT IN (SELECT parent FROM dag) UNION SELECT parent, 'root' FROM dag WHERE parent NOT IN (SELECT child FROM dag)")
def leaf_root(spark, d):
    """Leaves and roots of a hierarchy."""
    e = tg.dag(spark, d)
    return closure.leaves(e).withColumn("kind", F.lit("leaf")).unionByName(closure.roots(e).withColumn("kind", F.lit("root")))


# --- inference ------------------------------------------------------------------------------------------------

_AFRICA = "(SELECT r_regionkey FROM region WHERE r_name = 'AFRICA')"
_IN_REGION = f"FROM (SELECT '{E}customer/' || c_custkey AS uri, c_nationkey AS k FROM customer UNION ALL SELECT '{E}supplier/' || s_suppkey, s_nationkey FROM supplier) JOIN nation ON k = n_nationkey WHERE n_regionkey = 0"


@query(f"SELECT DISTINCT uri {_IN_REGION}")
def nodes_in_category(spark, d):
    """Customers and suppliers in a region, through its nations."""
    return infer.nodes_in_category(tg.graph(spark, d), E + "region/0", "IN_CATEGORY", "SCO")


@query(f"SELECT uri {_IN_REGION} UNION ALL SELECT uri {_IN_REGION} AND k % 2 = 0")
def nodes_in_category_bag(spark, d):
    """The same, a row for each way: nations with an even key lead to their region by a zone too."""
    g, n = tg.graph(spark, d), t(spark, d, "nation").where("n_nationkey % 2 = 0")
    null = F.lit(None).cast("string")
    link = lambda a, b: n.select(a.alias("src"), F.lit("SCO").alias("type"), b.alias("dst"), null.alias("graph"))
    zone = tg.uri("zone", "n_nationkey")
    more = link(tg.uri("nation", "n_nationkey"), zone).unionByName(link(zone, tg.uri("region", "n_regionkey")))
    return infer.nodes_in_category(g.with_(edges=g.edges.unionByName(more)), E + "region/0", "IN_CATEGORY", "SCO", distinct=False)


def _classes(spark):
    """A hierarchy of labels: customers and suppliers are partners, partners agents; parts are products."""
    return spark.createDataFrame([("Customer", "Partner"), ("Supplier", "Partner"), ("Partner", "Agent"), ("Agent", "Thing"), ("Part", "Product"), ("Product", "Thing")], "child string, parent string")


@query(f"SELECT '{E}customer/' || c_custkey AS uri FROM customer UNION ALL SELECT '{E}supplier/' || s_suppkey FROM supplier")
def nodes_labelled(spark, d):
    """Nodes with a label or one below it."""
    return infer.nodes_labelled(tg.graph(spark, d), "Agent", _classes(spark))


@query("SELECT unnest(['Region', 'Nation', 'Customer', 'Supplier', 'Part', 'Order', 'Partner', 'Agent', 'Thing', 'Product']) AS label")
def inferred_labels(spark, d):
    """Labels in use and those above them."""
    return infer.inferred_labels(tg.graph(spark, d), _classes(spark))


@query(f"SELECT '{E}customer/' || c_custkey AS uri, true AS is_partner FROM customer UNION ALL SELECT '{E}supplier/' || s_suppkey, true FROM supplier UNION ALL SELECT '{E}part/' || p_partkey, false FROM part UNION ALL SELECT '{E}order/' || o_orderkey, false FROM orders UNION ALL SELECT '{E}nation/' || n_nationkey, false FROM nation UNION ALL SELECT '{E}region/' || r_regionkey, false FROM region")
def has_label(spark, d):
    """Whether each node has a label or one below it."""
    g = tg.graph(spark, d)
    return infer.has_label(g.nodes, "Partner", _classes(spark)).select("uri", F.col("has_label").alias("is_partner"))


@query(f"SELECT '{E}customer/' || c_custkey AS uri, '{E}region/1' AS category, n_regionkey = 1 AS in_category FROM customer JOIN nation ON c_nationkey = n_nationkey")
def in_category(spark, d):
    """Whether each customer is in a region."""
    pairs = t(spark, d, "customer").select(tg.uri("customer", "c_custkey").alias("uri"), F.lit(E + "region/1").alias("category"))
    return infer.in_category(tg.graph(spark, d), pairs, "IN_CATEGORY", "SCO")


def _properties(spark):
    return spark.createDataFrame([("PLACED_BY", "RELATED"), ("CONTAINS", "RELATED"), ("IN_CATEGORY", "CLASSIFIED"), ("SCO", "CLASSIFIED")], "child string, parent string")


def _get_rels(name: str, direction: str, sql: str):
    QUERIES[name] = lambda spark, d: infer.rels(tg.graph(spark, d), E + "customer/5", "RELATED", _properties(spark), direction)
    ORACLES[name] = sql


_get_rels("get_rels_in", "<", f"SELECT 'PLACED_BY' AS type, '{E}order/' || o_orderkey AS node FROM orders WHERE o_custkey = 5")


@query(f"SELECT 'SCO' AS type, '{E}region/' || n_regionkey AS node FROM nation WHERE n_nationkey = 3 UNION ALL SELECT 'IN_CATEGORY', '{E}customer/' || c_custkey FROM customer WHERE c_nationkey = 3 UNION ALL SELECT 'IN_CATEGORY', '{E}supplier/' || s_suppkey FROM supplier WHERE s_nationkey = 3")
def get_rels_both(spark, d):
    """Relationships of a nation in either direction that lie under CLASSIFIED: out to its region, in from its members."""
    return infer.rels(tg.graph(spark, d), E + "nation/3", "CLASSIFIED", _properties(spark))


@query(f"SELECT DISTINCT 'CONTAINS' AS type, '{E}part/' || l_partkey AS node FROM lineitem WHERE l_orderkey = 5 UNION ALL SELECT 'PLACED_BY', '{E}customer/' || o_custkey FROM orders WHERE o_orderkey = 5")
def get_rels_out(spark, d):
    """Relationships of an order that lie under RELATED."""
    return infer.rels(tg.graph(spark, d), E + "order/5", "RELATED", _properties(spark), ">")


_TERMS = "VALUES ('name', 'Thing'), ('agentName', 'Agent'), ('acctbal', 'Partner'), ('segment', 'Customer'), ('brand', 'Part')"
_CLS = "VALUES ('Customer', 'Partner'), ('Supplier', 'Partner'), ('Partner', 'Agent'), ('Agent', 'Thing'), ('Part', 'Product'), ('Product', 'Thing')"
_CLS_UP = f"WITH RECURSIVE cls(child, parent) AS ({_CLS}), links(term, fin) AS ({_TERMS}), up AS (SELECT node, node AS ancestor FROM (SELECT child AS node FROM cls UNION SELECT parent FROM cls) UNION SELECT u.node, c.parent FROM up u JOIN cls c ON c.child = u.ancestor)"


def _links(spark):
    return spark.createDataFrame([("name", "Thing"), ("agentName", "Agent"), ("acctbal", "Partner"), ("segment", "Customer"), ("brand", "Part")], "term string, end string")


def _starts(spark):
    return spark.createDataFrame([(c,) for c in ("Customer", "Supplier", "Partner", "Agent", "Thing", "Part", "Product")], "node string")


_OVER = "AND NOT (term = 'name' AND EXISTS (SELECT 1 FROM up v JOIN links m ON m.fin = v.ancestor WHERE v.node = up.node AND m.term = 'agentName'))"


def _sub_terms(spark):
    return spark.createDataFrame([("agentName", "name")], "child string, parent string")


@query(f"{_CLS_UP} SELECT up.node, term FROM up JOIN links ON fin = ancestor")
def class_props_all(spark, d):
    """Properties of classes, their own and inherited."""
    return infer.class_terms(_starts(spark), _classes(spark), _links(spark), _sub_terms(spark), True)


@query(f"{_CLS_UP} SELECT up.node, term FROM up JOIN links ON fin = ancestor WHERE true {_OVER}")
def class_props(spark, d):
    """The same without those that a more special property overrides."""
    return infer.class_terms(_starts(spark), _classes(spark), _links(spark), _sub_terms(spark))


@query("SELECT * FROM (VALUES ('PLACED_BY', 'Customer'), ('CONTAINS', 'Thing'), ('RELATED', 'Thing')) x(node, term)")
def rel_target_classes(spark, d):
    """Target classes of relationships; a class gives way to one below it."""
    links = spark.createDataFrame([("RELATED", "Thing"), ("PLACED_BY", "Customer")], "end string, term string")
    starts = spark.createDataFrame([("PLACED_BY",), ("CONTAINS",), ("RELATED",)], "node string")
    return infer.rel_classes(starts, _properties(spark), links, _classes(spark))


# --- similarity -----------------------------------------------------------------------------------------------

_NAMED = "CAST(child AS VARCHAR) AS child, CAST(parent AS VARCHAR) AS parent"
_PAIRS_SQL = "pairs AS (SELECT a.p_partkey AS a, (a.p_partkey * 7 + 3) % (SELECT count(*) FROM part) AS b FROM part a WHERE a.p_partkey > 0)"
_ALL_UP = f"WITH RECURSIVE {tg.TREE_SQL}, up AS (SELECT p_partkey AS node, p_partkey AS ancestor, 0 AS depth FROM part UNION ALL SELECT u.node, e.parent, u.depth + 1 FROM up u JOIN tree e ON e.child = u.ancestor), {_PAIRS_SQL}, dep AS (SELECT node, max(depth) AS depth FROM up GROUP BY node), met AS (SELECT a, b, x.ancestor AS cs, x.depth + y.depth AS len FROM pairs JOIN up x ON x.node = a JOIN up y ON y.node = b AND y.ancestor = x.ancestor)"


def _pairs(spark, d):
    p = t(spark, d, "part")
    n = p.count()
    return p.where("p_partkey > 0").select(F.col("p_partkey").alias("a"), ((F.col("p_partkey") * 7 + 3) % n).alias("b"))


@query(f"{_ALL_UP} SELECT a, b, round(1.0 / (1 + min(len)), 6) AS similarity FROM met GROUP BY a, b")
def pathsim_pairs(spark, d):
    """Path similarity of pairs of parts in the tree."""
    return similarity.path_similarity(tg.tree(spark, d), _pairs(spark, d)).withColumn("similarity", F.round("similarity", 6))


@query(f"{_ALL_UP} SELECT a, b, round(CASE WHEN min(len) = 0 THEN 0 ELSE -ln(min(len) / (2.0 * any_value(longest))) END, 4) AS similarity FROM (SELECT met.*, dc.below + dep.depth + 1 AS longest, row_number() OVER (PARTITION BY a, b ORDER BY len, dc.below + dep.depth DESC) AS k FROM met JOIN dep ON dep.node = cs JOIN (SELECT ancestor, max(depth) AS below FROM up GROUP BY ancestor) dc ON dc.ancestor = cs) WHERE k = 1 AND a <> b GROUP BY a, b")
def lchsim_pairs(spark, d):
    """Leacock-Chodorow similarity of pairs of parts."""
    p = _pairs(spark, d).where("a <> b")
    return similarity.lch_similarity(tg.tree(spark, d), p).withColumn("similarity", F.round("similarity", 4))


@query(f"{_ALL_UP} SELECT a, b, round(2.0 * (max(c.depth) + 1) / (any_value(da.depth) + any_value(db.depth) + 2), 6) AS similarity FROM met JOIN dep c ON c.node = cs JOIN dep da ON da.node = a JOIN dep db ON db.node = b GROUP BY a, b")
def wupsim_pairs(spark, d):
    """Wu-Palmer similarity of pairs of parts."""
    return similarity.wup_similarity(tg.tree(spark, d), _pairs(spark, d)).withColumn("similarity", F.round("similarity", 6))


@query(f"{_ALL_UP} SELECT 40 AS a, x.node, round(1.0 / (1 + min(x.depth + y.depth)), 6) AS similarity FROM up y JOIN up x USING (ancestor) WHERE y.node = 40 AND x.node <> 40 GROUP BY x.node HAVING min(x.depth + y.depth) <= 4")
def pathsim_search(spark, d):
    """Classes near one class."""
    return similarity.path_search(tg.tree(spark, d), spark.createDataFrame([(40,)], "node long"), 0.2).withColumn("similarity", F.round("similarity", 6)).select(F.col("a").cast("int").alias("a"), "node", "similarity")


@query(f"{_ALL_UP}, longest AS (SELECT dep.node AS cs, below + dep.depth + 1 AS n FROM dep JOIN (SELECT ancestor, max(depth) AS below FROM up GROUP BY ancestor) b ON b.ancestor = dep.node) SELECT 40 AS a, x.node, round(max(-ln((x.depth + y.depth) / (2.0 * n))), 4) AS similarity FROM up y JOIN up x USING (ancestor) JOIN longest ON cs = ancestor WHERE y.node = 40 AND x.node <> 40 GROUP BY x.node HAVING max(-ln((x.depth + y.depth) / (2.0 * n))) >= 1.1")
def lchsim_search(spark, d):
    """Classes whose Leacock-Chodorow similarity to one class reaches a bound."""
    return similarity.lch_search(tg.tree(spark, d), spark.createDataFrame([(40,)], "node long"), 1.1).withColumn("similarity", F.round("similarity", 4)).select(F.col("a").cast("int").alias("a"), "node", "similarity")


@query("SELECT '14' AS a, '16' AS b, '14 is a type of 4' || chr(10) || '4 is a type of 1' || chr(10) || '16 is a type of 5' || chr(10) || '5 is a type of 1' AS text")
def path_explain(spark, d):
    """The path between two classes, in words."""
    e = tg.tree(spark, d).select(F.col("child").cast("string").alias("child"), F.col("parent").cast("string").alias("parent"))
    return similarity.explained(e, spark.createDataFrame([("14", "16")], "a string, b string"))


# --- export ---------------------------------------------------------------------------------------------------


@query(f"WITH {T} SELECT subject, predicate, object FROM triples WHERE subject = '{E}order/7' OR object = '{E}order/7'")
def describe_node(spark, d):
    """A node's statements and those that point at it."""
    out = export.describe(tg.graph(spark, d).with_(edge_props=tg.Graph.empty(spark).edge_props), E + "order/7")
    return out.select("subject", "predicate", "object")


@query(f"WITH {T}, f AS (SELECT subject AS s FROM triples WHERE predicate = '{BASE}size' AND object = '7' AND starts_with(subject, '{E}part/')) SELECT DISTINCT subject, predicate, object FROM triples WHERE subject IN (SELECT s FROM f) OR (NOT isLiteral AND object IN (SELECT s FROM f))")
def find_by_prop(spark, d):
    """Nodes by label and typed property value, with their context."""
    return export.find(tg.graph(spark, d), "Part", "size", "7", "INTEGER").select("subject", "predicate", "object")


@query(f"SELECT '{E}order/' || l_orderkey AS s, '{E}part/' || l_partkey AS o, sum(CAST(l_quantity AS BIGINT))::VARCHAR AS object FROM lineitem GROUP BY ALL")
def export_rdfstar(spark, d):
    """Edge properties as statements about statements."""
    v = export.triples_view(tg.graph(spark, d)).where("subjectSPO is not null")
    return v.select(F.col("subjectSPO")[0].alias("s"), F.col("subjectSPO")[2].alias("o"), "object")


_T2 = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
_OWL = "http://www.w3.org/2002/07/owl#"


def _implicit_sql() -> str:
    rows = []
    for label, _, _, _, cols in tg.ENTITIES:
        rows.append((BASE + label, _T2, _OWL + "Class"))
        for n, _, s in cols:
            rows += [(BASE + n, _T2, _OWL + "DatatypeProperty"), (BASE + n, "http://www.w3.org/2000/01/rdf-schema#domain", BASE + label), (BASE + n, "http://www.w3.org/2000/01/rdf-schema#range", XSD + s)]
    name = {k: lab for lab, k, *_ in tg.ENTITIES}
    for ty, _, (s, _a), (o, _b) in tg.LINKS:
        rows += [(BASE + ty, _T2, _OWL + "ObjectProperty"), (BASE + ty, "http://www.w3.org/2000/01/rdf-schema#domain", BASE + name[s]), (BASE + ty, "http://www.w3.org/2000/01/rdf-schema#range", BASE + name[o])]
    return "SELECT * FROM (VALUES " + ", ".join(str(r) for r in sorted(set(rows))) + ") v(subject, predicate, object)"


@query(_implicit_sql())
def implicit_ontology(spark, d):
    """Classes and properties as the data show them."""
    return export.implicit_ontology(tg.graph(spark, d))


@query(f"SELECT '{BASE}' || n_name AS subject, 'http://www.w3.org/2000/01/rdf-schema#subClassOf' AS predicate, '{BASE}' || r_name AS object FROM nation JOIN region ON n_regionkey = r_regionkey")
def explicit_ontology(spark, d):
    """Hierarchy edges as RDFS statements."""
    return export.explicit_ontology(tg.graph(spark, d))


@query(f"SELECT '{E}customer/' || c_custkey AS subject, '{BASE}mktsegment' AS predicate, c_mktsegment AS object FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT '{E}customer/' || c_custkey, '{BASE}name', c_name FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT '{E}customer/' || c_custkey, '{BASE}acctbal', CAST(c_acctbal AS VARCHAR) FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT '{E}customer/' || c_custkey, '{_T2}', '{BASE}Customer' FROM customer WHERE c_acctbal > 9000")
def export_query(spark, d):
    """The statements of the nodes that a SQL query returns."""
    return export.export_sql(tg.graph(spark, d), "SELECT uri FROM props WHERE key = 'acctbal' AND try_cast(lex AS DOUBLE) > 9000 AND uri LIKE '%/customer/%'").select("subject", "predicate", "object")
