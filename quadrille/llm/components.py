"""Connected components of a graph given as pairs, by repeated contraction to roots.

Each round every node points at its least neighbour. Such pointers can only meet in cycles of two, whose smaller
node becomes a root; then pointers are doubled until they stand still, so that every node knows its root, and the
edges are renamed to roots. Each tree has two nodes or more, so a round at least halves the nodes that still have
an edge, whatever the shape, and a chain of any length is one tree, settled in as many doublings as its length has
binary digits. Only (node, node) rows are shuffled; a node's edges meet in a minimum that is taken before the
shuffle, so its degree does not matter. What a round makes is written and read again, so neither plans nor the constraints that the optimizer infers grow with the rounds (those of a checkpoint are kept by it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow, written


def follow(labels: DataFrame, parents: DataFrame) -> DataFrame:
    """``labels`` (node, comp) with each comp replaced by its parent, if it has one."""
    up = parents.select(F.col("node").alias("__at"), F.col("comp").alias("__up"))
    return labels.join(up, F.col("comp") == F.col("__at"), "left").select("node", F.coalesce("__up", "comp").alias("comp"))


def rooted(nearest: DataFrame, keep) -> DataFrame:
    """(node, root) from pointers (node, comp) at nearest neighbours; ``keep`` settles a table."""
    ahead = nearest.select(F.col("node").alias("__at"), F.col("comp").alias("__up"))
    beyond = nearest.join(ahead, F.col("comp") == F.col("__at"))
    # A cycle of two becomes a root and its child; everybody else goes on by one more step.
    parents = keep(beyond.select("node", F.when(F.col("__up") == F.col("node"), F.least("node", "comp")).otherwise(F.col("__up")).alias("comp")))
    while True:
        up = parents.select(F.col("node").alias("__at"), F.col("comp").alias("__up"))
        doubled = keep(parents.join(up, F.col("comp") == F.col("__at")).select("node", F.col("__up").alias("comp"), (F.col("__up") != F.col("comp")).alias("moved")))
        parents = doubled.select("node", "comp")
        if doubled.where("moved").isEmpty():
            return parents


def components(pairs: DataFrame, a: str = "a", b: str = "b", nodes: int = 1 << 60) -> DataFrame:
    """(node, comp) for every node with an edge; comp is one of the component's nodes. Empty for no pairs.

    ``nodes`` is a bound of their number, for the width of the tables in between. Loops and null ends are no edges.
    """
    return contracted(pairs, a, b, nodes)[0]


def contracted(pairs: DataFrame, a: str = "a", b: str = "b", nodes: int = 1 << 60) -> tuple[DataFrame, int]:
    """As ``components``, with the number of rounds that it took."""
    keep = lambda df: written(narrow(df, nodes))
    edges = keep(pairs.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    labels, rounds = None, 0
    while not edges.isEmpty():
        rounds += 1
        both = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("other")), F.struct(F.col("v").alias("node"), F.col("u").alias("other")))
        nearest = keep(edges.select(F.inline(both)).groupBy("node").agg(F.min("other").alias("comp")))
        roots = rooted(nearest, keep)
        labels = roots if labels is None else keep(follow(labels, roots))
        p, q = (roots.select(F.col("node").alias(x), F.col("comp").alias(y)) for x, y in (("u", "pu"), ("v", "pv")))
        moved = edges.join(p, "u").join(q, "v").where("pu <> pv")
        edges = keep(moved.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct())
    return (labels, rounds) if labels is not None else (edges.select(F.col("u").alias("node"), F.col("v").alias("comp")), 0)
