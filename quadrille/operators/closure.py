"""Reachability over hierarchies: the core of inference and similarity.

``edges`` has the columns child and parent. The loop is semi-naive: each round joins the pairs found last with
the edges, keeps what is new, and stops when nothing is. Rounds are cut by checkpoint(), so plans stay small and a
lost executor costs a round at most. The edges are hash-partitioned once by child, and each round shuffles its
frontier only.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CyclicHierarchy(ValueError):
    """Longest paths and numbers of paths have no finite answer on a cycle."""


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder of spark.checkpoint.dir (a temporary one in a local session without it)."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)


def clean(edges: DataFrame) -> DataFrame:
    return edges.select("child", "parent").where("child is not null and parent is not null and child <> parent").distinct()


def ancestors(edges: DataFrame, starts: DataFrame | None = None, reflexive: bool = True, max_depth: int = 10_000) -> DataFrame:
    """(node, ancestor, depth): the shortest way up from each start (column node), or from every child.

    Cycles end by themselves, for a pair is found once.
    """
    edges = settled(clean(edges))
    seeds = edges.select(F.col("child").alias("node")).distinct() if starts is None else starts.select("node").distinct()
    frontier = settled(seeds.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth")))
    reached, depth = [frontier], 0
    known = frontier.select("node", "ancestor")
    while depth < max_depth:
        depth += 1
        step = frontier.join(edges, F.col("ancestor") == F.col("child")).select("node", F.col("parent").alias("ancestor")).distinct()
        frontier = settled(step.join(known, ["node", "ancestor"], "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        reached.append(frontier)
        known = known.unionByName(frontier.select("node", "ancestor"))
        if depth % 8 == 0:  # one file set instead of eight
            known = settled(known)
    out = reached[0] if reflexive else reached[0].limit(0)
    for r in reached[1:]:
        out = out.unionByName(r)
    return out


def descendants(edges: DataFrame, roots: DataFrame, reflexive: bool = True, max_depth: int = 10_000) -> DataFrame:
    """(root, node, depth) of what lies under each root (column root), down to ``max_depth``."""
    turned = edges.select(F.col("parent").alias("child"), F.col("child").alias("parent"))
    return ancestors(turned, roots.select(F.col("root").alias("node")), reflexive, max_depth).select(F.col("node").alias("root"), F.col("ancestor").alias("node"), "depth")


def path_counts(edges: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """(node, ancestor, paths, longest): the number of ways up and the longest one; the hierarchy must have no cycle."""
    edges = settled(clean(edges))
    bound = edges.agg(F.count_distinct("child")).first()[0]
    seeds = edges.select(F.col("child").alias("node")).distinct() if starts is None else starts.select("node").distinct()
    frontier = settled(seeds.select("node", F.col("node").alias("ancestor"), F.lit(1).cast("long").alias("paths")))
    levels, depth = [frontier.withColumn("depth", F.lit(0))], 0
    while True:
        depth += 1
        frontier = settled(frontier.join(edges, F.col("ancestor") == F.col("child")).groupBy("node", F.col("parent").alias("ancestor")).agg(F.sum("paths").alias("paths")))
        if frontier.isEmpty():
            break
        if depth > bound:
            raise CyclicHierarchy("the hierarchy has a cycle")
        levels.append(frontier.withColumn("depth", F.lit(depth)))
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out.groupBy("node", "ancestor").agg(F.sum("paths").alias("paths"), F.max("depth").alias("longest"))


def longest_ways(edges: DataFrame) -> DataFrame:
    """(node, longest): steps of the longest way from a root down to each class; the hierarchy must have no cycle.

    Round k holds the classes that k steps reach, each once, so no pairs are made.
    """
    edges = settled(clean(edges))
    every = edges.select(F.explode(F.array("child", "parent")).alias("node")).distinct()
    bound = edges.agg(F.count_distinct("child")).first()[0]
    front = settled(roots(edges).withColumn("depth", F.lit(0)))
    fronts = [front]
    while not front.isEmpty():
        if len(fronts) > bound + 1:
            raise CyclicHierarchy("the hierarchy has a cycle")
        step = front.join(edges, F.col("node") == F.col("parent")).select(F.col("child").alias("node")).distinct()
        front = settled(step.withColumn("depth", F.lit(len(fronts))))
        fronts.append(front)
    out = fronts[0]
    for x in fronts[1:]:
        out = out.unionByName(x)
    out = settled(every.join(out.groupBy("node").agg(F.max("depth").alias("longest")), "node", "left"))
    if not out.where("longest is null").isEmpty():  # below no root
        raise CyclicHierarchy("the hierarchy has a cycle")
    return out


def forest_ancestors(edges: DataFrame) -> DataFrame:
    """As ``ancestors`` without the starts themselves, for a tree or forest of any depth and size.

    Steps of 1, 2, 4, ... are made first, each by joining the one before with itself, until none is that long. A way
    up is then one choice of such steps, the short ones first, so that few rows meet at the nodes near a root.
    """
    edges = settled(clean(edges))
    bound = edges.agg(F.count_distinct("child")).first()[0]
    jump, jumps = edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor")), []
    while not jump.isEmpty():
        if 1 << len(jumps) > bound:
            raise CyclicHierarchy("the hierarchy has a cycle")
        jumps.append(jump)
        jump = settled(jump.alias("a").join(jump.alias("b"), F.col("a.ancestor") == F.col("b.node")).select("a.node", "b.ancestor"))
    every = edges.select(F.explode(F.array("child", "parent")).alias("at")).distinct()
    out = edges.select(F.col("child").alias("node")).distinct().select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth"))
    for i, jump in enumerate(jumps):
        steps = every.select("at", F.col("at").alias("to"), F.lit(0).alias("more")).unionByName(jump.select(F.col("node").alias("at"), F.col("ancestor").alias("to"), F.lit(1 << i).alias("more")))
        out = out.join(steps, F.col("ancestor") == F.col("at")).select("node", F.col("to").alias("ancestor"), (F.col("depth") + F.col("more")).alias("depth"))
    return out.where("depth > 0")


def roots(edges: DataFrame) -> DataFrame:
    """(node): parents that are no child."""
    e = clean(edges)
    return e.select(F.col("parent").alias("node")).distinct().join(e.select(F.col("child").alias("node")), "node", "left_anti")


def leaves(edges: DataFrame) -> DataFrame:
    """(node): children that are no parent."""
    e = clean(edges)
    return e.select(F.col("child").alias("node")).distinct().join(e.select(F.col("parent").alias("node")), "node", "left_anti")
