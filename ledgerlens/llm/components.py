"""Connected components of a large graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour of a node that is larger than it moves to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of these. Edges run from larger
    to smaller nodes."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, of every node in an edge.

    ``edges``: columns ``a`` and ``b``, nodes of one orderable type. No node gathers its
    neighbours: least ones are aggregated and joined back. Each turn is written, so lineage
    stays short; the number of turns grows with the logarithm of the longest path.
    """
    ends = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = saved(edges.select(*ends).where("a > b").distinct(), "components")
    before, state = None, _state(now)
    while state != before:
        now = saved(_small_star(_large_star(now)), "components")
        before, state = state, _state(now)
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
