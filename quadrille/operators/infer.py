"""Inference over hierarchies of labels, categories and relationships.

Hierarchies are edges (child, parent) of names or IRIs. A closure is small beside the data: the semi-joins with it
leave the choice of a broadcast to the measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import GraphConfig
from ..model import RESOURCE, TYPE, Graph
from .closure import ancestors, descendants, path_counts, roots

SYSTEM = (RESOURCE,)


def hierarchy(graph: Graph, label: str, rel: str, name_prop: str = "name") -> DataFrame:
    """(child, parent) names of the nodes with a label, along a relationship."""
    named = graph.props.where(F.col("key") == name_prop).select("uri", F.col("lex").alias("name"))
    of = graph.nodes.where(F.array_contains("labels", label)).select("uri").join(named, "uri")
    e = graph.edges.where(F.col("type") == rel)
    return e.join(of.select(F.col("uri").alias("src"), F.col("name").alias("child")), "src").join(of.select(F.col("uri").alias("dst"), F.col("name").alias("parent")), "dst").select("child", "parent")


def _one(frame: DataFrame, column: str, value: str) -> DataFrame:
    return frame.sparkSession.createDataFrame([(value,)], f"{column} string")


def sub_names(edges: DataFrame, name: str) -> DataFrame:
    """(name): the name itself and all below it."""
    return descendants(edges, _one(edges, "root", name)).select(F.col("node").alias("name"))


def nodes_labelled(graph: Graph, label: str, classes: DataFrame) -> DataFrame:
    """(uri): nodes with the label or one below it; ``classes`` is the hierarchy of names."""
    names = sub_names(classes, label).unionByName(_one(classes, "name", label)).distinct()
    return graph.nodes.select("uri", F.explode("labels").alias("name")).join(names, "name", "left_semi").select("uri").distinct()


def nodes_in_category(graph: Graph, category: str, in_rel: str, sub_rel: str, distinct: bool = True) -> DataFrame:
    """(uri): what is in the category or one below it; a row for each way there unless ``distinct``."""
    sub = graph.edges.where(F.col("type") == sub_rel).select(F.col("src").alias("child"), F.col("dst").alias("parent"))
    members = graph.edges.where(F.col("type") == in_rel).select(F.col("src").alias("uri"), F.col("dst").alias("node"))
    if distinct:
        return members.join(descendants(sub, _one(sub, "root", category)).select("node"), "node", "left_semi").select("uri").distinct()
    turned = sub.select(F.col("parent").alias("child"), F.col("child").alias("parent"))
    ways = path_counts(turned, _one(sub, "node", category)).select(F.col("ancestor").alias("node"), "paths")
    return members.join(ways, "node").select("uri", F.explode(F.sequence(F.lit(1), F.col("paths"))).alias("way")).select("uri")


def rels(graph: Graph, uri: str, rel: str, properties: DataFrame, direction: str = "") -> DataFrame:
    """(type, node): edges at a node of the type or one below it; direction ``>`` out, ``<`` in, else both."""
    names = sub_names(properties, rel).unionByName(_one(properties, "name", rel)).distinct().withColumnRenamed("name", "type")
    out = graph.edges.where(F.col("src") == uri).select("type", F.col("dst").alias("node"))
    into = graph.edges.where(F.col("dst") == uri).select("type", F.col("src").alias("node"))
    got = out if direction == ">" else into if direction == "<" else out.unionByName(into)
    return got.join(names, "type", "left_semi")


def inferred_labels(graph: Graph, classes: DataFrame) -> DataFrame:
    """(label): labels in use and the classes above them on a way to a root."""
    used = graph.nodes.select(F.explode("labels").alias("label")).distinct().where(~F.col("label").isin(*SYSTEM))
    up = ancestors(classes, used.withColumnRenamed("label", "node"))
    top = roots(classes).withColumnRenamed("node", "root")
    # On a way to a root: above a used label, and with a root above or at it.
    rooted = ancestors(classes).join(top, F.col("ancestor") == F.col("root")).select(F.col("node").alias("name")).unionByName(top.withColumnRenamed("root", "name")).distinct()
    above = up.select(F.col("ancestor").alias("name")).join(rooted, "name", "left_semi")
    return used.unionByName(above.withColumnRenamed("name", "label")).distinct()


def has_label(nodes: DataFrame, label: str, classes: DataFrame) -> DataFrame:
    """(uri, graph, has_label): whether one of a node's labels is the label or below it; ``nodes`` has uri, graph, labels."""
    names = sub_names(classes, label).unionByName(_one(classes, "name", label)).distinct().withColumn("__in", F.lit(True))
    each = nodes.select("uri", "graph", F.explode_outer("labels").alias("name")).join(names, "name", "left")
    return each.groupBy("uri", "graph").agg(F.coalesce(F.max("__in"), F.lit(False)).alias("has_label"))


def in_category(graph: Graph, pairs: DataFrame, in_rel: str, sub_rel: str) -> DataFrame:
    """``pairs`` (uri, category) with the boolean column in_category."""
    sub = graph.edges.where(F.col("type") == sub_rel).select(F.col("src").alias("child"), F.col("dst").alias("parent"))
    members = graph.edges.where(F.col("type") == in_rel).select(F.col("src").alias("uri"), F.col("dst").alias("node")).join(pairs.select("uri").distinct(), "uri", "left_semi")
    up = ancestors(sub, members.select("node"))
    true = members.join(up, "node").select("uri", F.col("ancestor").alias("category")).distinct().withColumn("__in", F.lit(True))
    return pairs.join(true, ["uri", "category"], "left").withColumn("in_category", F.coalesce("__in", F.lit(False))).drop("__in")


def _specific(edges: DataFrame, start: DataFrame, links: DataFrame, over: DataFrame, include_all: bool) -> DataFrame:
    """Terms linked to the start or above it; unless all are asked for, those with a more specific term linked are dropped."""
    near = ancestors(edges, start).select("node", F.col("ancestor").alias("end"))
    found = near.join(links, "end").select("node", "term").distinct()
    if include_all:
        return found
    below = ancestors(over, None, reflexive=False).select(F.col("node").alias("special"), F.col("ancestor").alias("term"))
    overridden = found.join(below, "term").join(found.select("node", F.col("term").alias("special")), ["node", "special"], "left_semi").select("node", "term")
    return found.join(overridden, ["node", "term"], "left_anti")


def class_terms(starts: DataFrame, classes: DataFrame, links: DataFrame, properties: DataFrame, include_all: bool = False) -> DataFrame:
    """(node, term): properties or relationships (links: term, end) of each class of ``starts`` (column node), by DOMAIN or RANGE.

    A term is overridden by one below it in ``properties`` that is linked as well.
    """
    return _specific(classes, starts, links, properties, include_all)


def rel_classes(starts: DataFrame, properties: DataFrame, links: DataFrame, classes: DataFrame, include_all: bool = False) -> DataFrame:
    """(node, term): classes at an end (links: end = relationship, term = class) of each relationship or one above it.

    A class is dropped for one below it in ``classes`` that is linked as well.
    """
    return _specific(properties, starts, links, classes, include_all)


def default_category_rel(config: GraphConfig | None) -> str:
    """The relationship that puts things in categories where none is named."""
    if config is None:
        return "IN_CATEGORY"
    return {"IGNORE": "type", "MAP": "type", "KEEP": TYPE}.get(config.handleVocabUris, "rdf__type")
