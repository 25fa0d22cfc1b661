"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.durable import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the least node around: the larger neighbours, or the smaller and the node itself."""
    around = _both_ways(edges)
    if not large:
        around = around.where("v < u")
    least = around.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    hung = around.join(least, "u")
    hung = hung.where("v > u") if large else hung.where("v <> m")
    found = hung.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        found = found.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return found.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the least node of its component.

    Each round is written to shared storage, so the plan stays short and a lost executor costs
    no more than a round. Minima are reduced before the shuffle and joined back on stored tables'
    plain shuffles, where adaptive execution splits a node with very many neighbours. The rounds
    grow with the logarithm of the component's size.
    """
    state = lambda df: tuple(
        df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )
    edges = written(edges.where("a <> b").distinct(), "edges")
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = written(_star(written(_star(edges, large=True), "large-star"), large=False), "small-star")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
