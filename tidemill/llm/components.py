"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import kept_table


def connected_components(links: DataFrame) -> DataFrame:
    """`node`, `component` (its least node) for every node of `links` (`a`, `b`, longs), each round kept as a table.

    Each round hangs the neighbours of a node onto the least of them, first those above it, then those not above it,
    until nothing moves; the number of rounds grows with the logarithm of the longest path. A node's least neighbour is
    a grouped minimum, combined before the shuffle; the join back may be split by the adaptive planner, so a node with
    very many neighbours does not hold one task.
    """
    edges = kept_table(_ordered(links.select("a", "b")), "component-links")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        edges = kept_table(_star(both, above=True), "component-large")
        edges = kept_table(_star(edges, above=False), "component-small")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    # Now every node points at the least of its component: a is the greater end.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b"), F.col("b")).distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, above: bool) -> DataFrame:
    """edges a - b; each a collects its least neighbour m (or itself), and its neighbours go to m."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = edges.join(least, "a")
    if above:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Without a neighbour above it, a node is still tied to its least one.
        tied = least.select("a", F.col("m").alias("b"))
        return _ordered(moved.union(tied))
    return _ordered(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select("a", F.col("m").alias("b"))))
