"""Statements taken out of a graph, by anti-joins; what is left of orphans goes too."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Catalog, ParserConfig
from ..model import RESOURCE, Graph
from .closure import settled
from .ingest import BNODE, _multi, allocate_prefixes, mapped


@dataclass
class DeleteResult:
    terminationStatus: str
    triplesDeleted: int
    namespaces: dict[str, str]
    extraInfo: str
    graph: Graph


def _same(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A semi- or anti-join with nulls equal."""
    right = b.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    cond = on[0]
    for x in on[1:]:
        cond = cond & x
    return a.join(right, cond, how)


def orphans(graph: Graph) -> DataFrame:
    """(uri, graph) of nodes with no label but the general one, no property and no edge."""
    bare = graph.nodes.where(F.size(F.array_remove("labels", RESOURCE)) == 0).select("uri", "graph")
    bare = _same(bare, graph.props, ["uri", "graph"], "left_anti")
    ends = graph.edges.select(F.col("src").alias("uri"), "graph").unionByName(graph.edges.select(F.col("dst").alias("uri"), "graph"))
    return _same(bare, ends, ["uri", "graph"], "left_anti")


def delete(graph: Graph, triples: DataFrame, catalog: Catalog, parser: ParserConfig | None = None) -> DeleteResult:
    """The graph without the statements. Single-valued properties go whatever their value; statements on blank nodes stay."""
    config = catalog.need()
    allocate_prefixes(triples, catalog)
    rows = settled(mapped(triples, catalog, parser))
    blank = F.col("uri").startswith(BNODE) | F.coalesce(F.col("dst").startswith(BNODE), F.lit(False))
    total, blanks = rows.agg(F.count("*"), F.count_if(blank)).first()
    rows = rows.where(~blank)
    labels = rows.where("kind = 'label'").select("uri", "graph", F.col("name").alias("label"))
    props = rows.where("kind = 'prop'").withColumnRenamed("name", "key").withColumn("multi", _multi(config))
    rels = rows.where("kind = 'rel'").select(F.col("uri").alias("src"), F.col("name").alias("type"), "dst", "graph")
    each = graph.nodes.select("uri", "graph", F.explode("labels").alias("label"))
    hit_labels = _same(labels, each, ["uri", "graph", "label"], "left_semi").count()
    kept = _same(each, labels, ["uri", "graph", "label"], "left_anti")
    nodes = kept.groupBy("uri", "graph").agg(F.array_sort(F.collect_set("label")).alias("labels"))
    one, many = props.where("not multi"), props.where("multi")
    hit_props = _same(one, graph.props, ["uri", "graph", "key"], "left_semi").count() + _same(many, graph.props, ["uri", "graph", "key", "type", "lex"], "left_semi").count()
    left = _same(_same(graph.props, one, ["uri", "graph", "key"], "left_anti"), many, ["uri", "graph", "key", "type", "lex"], "left_anti")
    hit_rels = _same(rels, graph.edges, ["src", "type", "dst", "graph"], "left_semi").count()
    edges = _same(graph.edges, rels, ["src", "type", "dst", "graph"], "left_anti")
    ep = _same(graph.edge_props, rels.withColumnRenamed("type", "type_"), ["src", "type_", "dst", "graph"], "left_anti")
    out = Graph(nodes, left, edges, ep)
    out = out.with_(nodes=_same(out.nodes, orphans(out), ["uri", "graph"], "left_anti"))
    deleted = hit_labels + hit_props + hit_rels
    info = f"{blanks} statements with blank nodes were not deleted." if blanks else ""
    return DeleteResult("OK", deleted, catalog.prefixes.all(), info, out)
