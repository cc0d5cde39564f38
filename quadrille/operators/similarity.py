"""Similarity of classes in a taxonomy: path length, Leacock-Chodorow, Wu-Palmer.

Everything rests on the shortest way up from each class to each of its ancestors. Two classes meet in their common
ancestors; only pairs that are asked for are joined, on the ancestor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .closure import ancestors, clean, descendants, longest_ways, roots, settled


def _up(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    return ancestors(edges, nodes)


def _sides(pairs: DataFrame, up: DataFrame) -> DataFrame:
    """Pairs (a, b) with each common ancestor and the ways to it: a, b, cs, da, db."""
    left = up.select(F.col("node").alias("a"), F.col("ancestor").alias("cs"), F.col("depth").alias("da"))
    right = up.select(F.col("node").alias("b"), F.col("ancestor").alias("cs"), F.col("depth").alias("db"))
    return pairs.join(left, "a").join(right, ["b", "cs"])


def _of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _root_depths(up: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, depth): the shortest way to a root."""
    return up.join(roots(edges).withColumnRenamed("node", "ancestor"), "ancestor").groupBy("node").agg(F.min("depth").alias("depth"))


def _with_depths(pairs: DataFrame, depths: DataFrame) -> DataFrame:
    a, b = (depths.select(F.col("node").alias(x), F.col("depth").alias(f"root_{x}")) for x in "ab")
    return pairs.join(a, "a", "left").join(b, "b", "left")


def path_lengths(edges: DataFrame, pairs: DataFrame, simulate_root: bool = True) -> DataFrame:
    """(a, b, length, joined): the shortest way over a common ancestor; with a simulated root, else over that; null for no way."""
    pairs = pairs.select("a", "b").distinct()
    up = settled(_up(edges, _of(pairs)))
    met = _sides(pairs, up).groupBy("a", "b").agg(F.min(F.col("da") + F.col("db")).alias("met"))
    out = _with_depths(pairs, _root_depths(up, edges)).join(met, ["a", "b"], "left")
    over_root = F.col("root_a") + F.col("root_b") + 2
    return out.select("a", "b", F.coalesce("met", over_root if simulate_root else F.lit(None).cast("int")).alias("length"), F.col("met").isNotNull().alias("joined"))


def path_similarity(edges: DataFrame, pairs: DataFrame, simulate_root: bool = True) -> DataFrame:
    """(a, b, similarity): 1 / (1 + length), 0 where there is no way."""
    out = path_lengths(edges, pairs, simulate_root)
    return out.select("a", "b", F.coalesce(1.0 / (1 + F.col("length")), F.lit(0.0)).alias("similarity"))


def _all_for(edges: DataFrame, start: DataFrame, longest: int | None = None) -> DataFrame:
    """Pairs of each start (node) with every class that shares an ancestor: a, node, length of the way, and the ancestor.

    Up from the starts, then down from what is above them: the rest of the taxonomy is not walked. No step goes beyond
    ``longest``.
    """
    edges = settled(clean(edges))
    bound = {} if longest is None else {"max_depth": longest}
    mine = settled(ancestors(edges, start, **bound).select(F.col("node").alias("a"), F.col("ancestor").alias("cs"), F.col("depth").alias("da")))
    other = descendants(edges, mine.select(F.col("cs").alias("root")), **bound).select(F.col("root").alias("cs"), "node", F.col("depth").alias("db"))
    return mine.join(other, "cs").select("a", "node", "cs", (F.col("da") + F.col("db")).alias("length")).where((F.col("length") > 0) & (F.col("node") != F.col("a")))


def path_search(edges: DataFrame, start: DataFrame, least: float) -> DataFrame:
    """(a, node, similarity): the classes with a path similarity of ``least`` or more to each start."""
    longest = int(1.0 / least - 1) if least > 0 else None
    found = _all_for(edges, start, longest).groupBy("a", "node").agg(F.min("length").alias("length"))
    found = found.select("a", "node", "length", (1.0 / (1 + F.col("length"))).alias("similarity"))
    return (found.where(F.col("length") <= 1.0 / least - 1) if least > 0 else found).drop("length")


def taxonomy_depths(edges: DataFrame) -> DataFrame:
    """(cs, depth): of each class the longest way from a leaf over it to a root, in classes."""
    edges = settled(clean(edges))
    turned = edges.select(F.col("parent").alias("child"), F.col("child").alias("parent"))
    above, below = longest_ways(edges).withColumnRenamed("longest", "above"), longest_ways(turned).withColumnRenamed("longest", "below")
    return above.join(below, "node").select(F.col("node").alias("cs"), (F.col("above") + F.col("below") + 1).alias("depth"))


def _lch(length, depth):
    return F.when(length == 0, F.lit(float("inf"))).otherwise(-F.log(length / (2.0 * depth)))


def lch_similarity(edges: DataFrame, pairs: DataFrame, simulate_root: bool = True) -> DataFrame:
    """(a, b, similarity): -ln(length / (2 * depth)), depth that of the common ancestor on the shortest way.

    Without one, the way and the deepest taxonomy go over a simulated root, or it is 0. Infinite for a class and itself.
    """
    pairs = pairs.select("a", "b").distinct()
    up, depths = settled(_up(edges, _of(pairs))), settled(taxonomy_depths(edges))
    met = _sides(pairs, up).join(depths, "cs").groupBy("a", "b").agg(F.min(F.struct((F.col("da") + F.col("db")).alias("length"), (-F.col("depth")).alias("less"))).alias("m"))
    out = _with_depths(pairs, _root_depths(up, edges)).join(met, ["a", "b"], "left")
    deepest = depths.agg((F.max("depth") + 1).alias("deepest"))
    out = out.crossJoin(F.broadcast(deepest))  # one row
    far = F.col("root_a") + F.col("root_b") + 2
    virtual = _lch(far, F.col("deepest")) if simulate_root else F.lit(0.0)
    return out.select("a", "b", F.when(F.col("m").isNotNull(), _lch(F.col("m.length"), -F.col("m.less"))).otherwise(F.coalesce(virtual, F.lit(0.0))).alias("similarity"))


def lch_search(edges: DataFrame, start: DataFrame, least: float, mode: str = "score") -> DataFrame:
    """(a, node, similarity): the best similarity of each class, if it reaches ``least``.

    ``mode="length"`` bounds the way by 2 * depth / 10**least instead and returns a row for each common ancestor.
    """
    found = _all_for(edges, start).join(taxonomy_depths(edges), "cs")
    if mode == "length":
        return found.where(F.col("length") <= 2 * F.col("depth") / 10.0**least).select("a", "node", _lch(F.col("length"), F.col("depth")).alias("similarity"))
    best = found.groupBy("a", "node").agg(F.max(_lch(F.col("length"), F.col("depth"))).alias("similarity"))
    return best.where(F.col("similarity") >= least)


def wup_similarity(edges: DataFrame, pairs: DataFrame, simulate_root: bool = True) -> DataFrame:
    """(a, b, similarity): 2 * depth(lcs) / (depth(a) + depth(b)), depths in classes from a root, lcs the deepest common ancestor."""
    pairs = pairs.select("a", "b").distinct()
    up = settled(_up(edges, _of(pairs)))
    depth_of = settled(_root_depths(_up(edges, up.select(F.col("ancestor").alias("node"))), edges))
    met = _sides(pairs, up).join(depth_of.select(F.col("node").alias("cs"), F.col("depth").alias("dc")), "cs").groupBy("a", "b").agg(F.max(F.col("dc") + 1).alias("lcs"))
    out = _with_depths(pairs, depth_of).join(met, ["a", "b"], "left")
    both = F.col("root_a") + F.col("root_b") + 2
    # A simulated root lies above both: one deeper all round, and the lcs is that root.
    virtual = 2.0 / (both + 2) if simulate_root else F.lit(0.0)
    return out.select("a", "b", F.coalesce(2.0 * F.col("lcs") / both, virtual, F.lit(0.0)).alias("similarity"))


def paths(edges: DataFrame, pairs: DataFrame, root: str = "ROOT", simulate_root: bool = True) -> DataFrame:
    """(a, b, path): the steps (src, dst) up from a and up from b to where they meet; over a simulated root if nowhere else."""
    pairs = pairs.select("a", "b").distinct()
    e = settled(clean(edges))
    nodes = _of(pairs)
    reached = nodes.select("node", F.col("node").alias("ancestor"), F.expr("cast(array() as array<struct<src:string,dst:string>>)").alias("path"))
    frontier, levels = settled(reached), []
    known = frontier.select("node", "ancestor")
    while not frontier.isEmpty():
        levels.append(frontier)
        step = frontier.join(e, F.col("ancestor") == F.col("child")).groupBy("node", F.col("parent").alias("ancestor")).agg(F.min(F.array_append("path", F.struct(F.col("child").alias("src"), F.col("parent").alias("dst")))).alias("path"))
        frontier = settled(step.join(known, ["node", "ancestor"], "left_anti"))
        known = known.unionByName(frontier.select("node", "ancestor"))
    up = levels[0]
    for x in levels[1:]:
        up = up.unionByName(x)
    top = roots(e).union(nodes.join(e.select(F.explode(F.array("child", "parent")).alias("node")), "node", "left_anti"))
    if simulate_root:
        last = F.struct(F.col("ancestor").alias("src"), F.lit(root).alias("dst"))
        up = up.unionByName(up.join(top.select(F.col("node").alias("ancestor")).distinct(), "ancestor", "left_semi").select("node", F.lit(root).alias("ancestor"), F.array_append("path", last).alias("path")))
    left = up.select(F.col("node").alias("a"), F.col("ancestor").alias("cs"), F.col("path").alias("pa"))
    right = up.select(F.col("node").alias("b"), F.col("ancestor").alias("cs"), F.col("path").alias("pb"))
    met = pairs.join(left, "a").join(right, ["b", "cs"])
    order = F.struct((F.col("cs") == root).alias("last"), (F.size("pa") + F.size("pb")).alias("n"), "cs", F.concat("pa", "pb").alias("path"))
    return met.groupBy("a", "b").agg(F.min(order).alias("m")).select("a", "b", F.col("m.path").alias("path"))


def explained(edges: DataFrame, pairs: DataFrame, **options) -> DataFrame:
    """(a, b, text): the path as lines "X is a type of Y"."""
    return paths(edges, pairs, **options).select("a", "b", F.array_join(F.transform("path", lambda s: F.concat(s["src"], F.lit(" is a type of "), s["dst"])), "\n").alias("text"))
