"""Validation at write time: each micro-batch of changes is checked before it counts (an extension)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Catalog
from ..model import Graph
from ..operators.shacl import Constraint, validate


class ValidationFailed(ValueError):
    """A batch breaks a constraint; the first violation is the message."""


def touched_nodes(graph: Graph, created: DataFrame | None = None, deleted: DataFrame | None = None, changed: DataFrame | None = None, edges: DataFrame | None = None) -> DataFrame:
    """(uri) of what a change touches: new and changed nodes, ends of edges, neighbours of deleted nodes."""
    parts = [x.select("uri") for x in (created, changed) if x is not None]
    if edges is not None:
        parts.append(edges.select(F.explode(F.array("src", "dst")).alias("uri")))
    if deleted is not None:
        gone = deleted.select("uri")
        parts.append(graph.edges.join(gone.withColumnRenamed("uri", "dst"), "dst", "left_semi").select(F.col("src").alias("uri")))
        parts.append(graph.edges.join(gone.withColumnRenamed("uri", "src"), "src", "left_semi").select(F.col("dst").alias("uri")))
    if not parts:
        return graph.nodes.select("uri").limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def validate_change(graph: Graph, constraints: list[Constraint], touched: DataFrame, catalog: Catalog | None = None) -> None:
    """Raises on the first violation among the touched nodes."""
    if found := validate(graph, constraints, catalog, touched).take(1):
        r = found[0]
        raise ValidationFailed(f"{r.focusNode}: {r.propertyShape} on {r.resultPath}: {r.resultMessage}")


def validating_sink(to_graph: Callable[[DataFrame], Graph], constraints: list[Constraint], write: Callable[[DataFrame, int], None], catalog: Catalog | None = None) -> Callable[[DataFrame, int], None]:
    """For ``writeStream.foreachBatch``: checks a batch as a graph, then writes it; a failing batch is not written."""

    def handle(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            graph = to_graph(batch)
            validate_change(graph, constraints, graph.nodes, catalog)
            write(batch, number)
        finally:
            batch.unpersist()

    return handle


def violations_stream(events: DataFrame, key: str, most: int, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """maxCount over a stream: keys with more rows than ``most`` in a window of event time (column ts), after late rows are cut off."""
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", window), F.col(key)).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > most).select(F.col("window.start").alias("since"), key, "n")
