"""The relational test tables as a graph, by a rule that plain SQL can repeat."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import Graph

ROOT = "http://ex.org/"


def uri(kind: str, key) -> Column:
    return F.concat(F.lit(f"{ROOT}{kind}/"), (F.col(key) if isinstance(key, str) else key).cast("string"))


#: Label, kind in the IRI, table, key, and properties as (name, column, stored type).
ENTITIES = (
    ("Region", "region", "region", "r_regionkey", (("name", "r_name", "string"),)),
    ("Nation", "nation", "nation", "n_nationkey", (("name", "n_name", "string"),)),
    ("Customer", "customer", "customer", "c_custkey", (("name", "c_name", "string"), ("acctbal", "c_acctbal", "double"), ("mktsegment", "c_mktsegment", "string"))),
    ("Supplier", "supplier", "supplier", "s_suppkey", (("name", "s_name", "string"), ("acctbal", "s_acctbal", "double"))),
    ("Part", "part", "part", "p_partkey", (("name", "p_name", "string"), ("brand", "p_brand", "string"), ("size", "p_size", "long"), ("retailprice", "p_retailprice", "double"))),
    ("Order", "order", "orders", "o_orderkey", (("status", "o_orderstatus", "string"), ("totalprice", "o_totalprice", "double"), ("priority", "o_orderpriority", "string"))),
)
#: Type, table, source (kind, column), target (kind, column).
LINKS = (
    ("SCO", "nation", ("nation", "n_nationkey"), ("region", "n_regionkey")),
    ("IN_CATEGORY", "customer", ("customer", "c_custkey"), ("nation", "c_nationkey")),
    ("IN_CATEGORY", "supplier", ("supplier", "s_suppkey"), ("nation", "s_nationkey")),
    ("PLACED_BY", "orders", ("order", "o_orderkey"), ("customer", "o_custkey")),
    ("CONTAINS", "lineitem", ("order", "l_orderkey"), ("part", "l_partkey")),
)


def graph(spark: SparkSession, sf_dir: str) -> Graph:
    """All entities and links; a table is scanned only for what a query asks of it."""
    t = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    null = F.lit(None).cast("string")
    nodes, props, edges = [], [], []
    for label, kind, table, key, columns in ENTITIES:
        nodes.append(t(table).select(uri(kind, key).alias("uri"), null.alias("graph"), F.array(F.lit(label)).alias("labels")))
        for name, column, stored in columns:
            props.append(t(table).where(F.col(column).isNotNull()).select(uri(kind, key).alias("uri"), null.alias("graph"), F.lit(name).alias("key"), F.lit(0).cast("long").alias("ord"), F.lit(stored).alias("type"), F.col(column).cast("string").alias("lex"), null.alias("lang"), null.alias("datatype")))
    for kind, table, (sk, sc), (dk, dc) in LINKS:
        e = t(table).select(uri(sk, sc).alias("src"), F.lit(kind).alias("type"), uri(dk, dc).alias("dst"), null.alias("graph"))
        edges.append(e.distinct() if table == "lineitem" else e)
    line = t("lineitem").groupBy("l_orderkey", "l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"))
    ep = line.select(uri("order", "l_orderkey").alias("src"), F.lit("CONTAINS").alias("type_"), uri("part", "l_partkey").alias("dst"), null.alias("graph"), F.lit("qty").alias("key"), F.lit(0).cast("long").alias("ord"), F.lit("long").alias("type"), F.col("qty").cast("string").alias("lex"), null.alias("lang"), null.alias("datatype"))
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    return Graph(union(nodes), union(props), union(edges), ep)


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(child, parent): part k under part (k - 1) div 3, a single tree."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet").where("p_partkey > 0")
    return p.select(F.col("p_partkey").alias("child"), F.floor((F.col("p_partkey") - 1) / 3).alias("parent"))


def dag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(child, parent): part k under parts k div 2 and k div 3, with diamonds."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet").where("p_partkey > 1")
    return p.select(F.col("p_partkey").alias("child"), F.explode(F.array(F.floor(F.col("p_partkey") / 2), F.floor(F.col("p_partkey") / 3))).alias("parent")).distinct()


# --- the same in SQL ------------------------------------------------------------------------------------------


def triples_sql() -> str:
    """``triples`` (subject, predicate, object, isLiteral, literalType) over the same entities and links, for DuckDB."""
    base, xsd, rdf = "graph://schema#", "http://www.w3.org/2001/XMLSchema#", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
    u = lambda kind, c: f"'{ROOT}{kind}/' || {c}"
    parts = []
    for label, kind, table, key, columns in ENTITIES:
        parts.append(f"SELECT {u(kind, key)} AS subject, '{rdf}' AS predicate, '{base}{label}' AS object, false AS isLiteral, NULL AS literalType FROM {table}")
        parts += [f"SELECT {u(kind, key)}, '{base}{name}', CAST({c} AS VARCHAR), true, '{xsd}{stored}' FROM {table} WHERE {c} IS NOT NULL" for name, c, stored in columns]
    parts += [f"SELECT {'DISTINCT ' if t == 'lineitem' else ''}{u(*s)}, '{base}{k}', {u(*d)}, false, NULL FROM {t}" for k, t, s, d in LINKS]
    return "triples AS (" + " UNION ALL ".join(parts) + ")"


TREE_SQL = "tree AS (SELECT p_partkey AS child, (p_partkey - 1) // 3 AS parent FROM part WHERE p_partkey > 0)"
DAG_SQL = "dag AS (SELECT DISTINCT p_partkey AS child, unnest([p_partkey // 2, p_partkey // 3]) AS parent FROM part WHERE p_partkey > 1)"
