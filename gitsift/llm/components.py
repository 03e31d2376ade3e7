"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitsift.session import materialise


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Large star: what a node knows that is larger than itself goes to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct())


def _from_largest(edges: DataFrame) -> DataFrame:
    """Small star: a node and what it knows that is smaller go to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    others = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return least.select("a", F.col("least").alias("b")).unionByName(others).distinct()


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """node, component of every node with an edge (columns a, b; a <> b, no nulls).

    The component is the smallest node reachable. Each round writes its edges, so
    lost executors cost one round; the number of rounds grows with the logarithm of
    the longest path. A node with very many edges is a hot key of joins and of
    aggregates with map-side combine only.
    """
    current = materialise(edges.select("a", "b").distinct(), "edges")
    before = None
    while True:
        current = materialise(_from_largest(_to_smallest(current)), "edges")
        state = current.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == before or not state[0]:
            break
        before = state
    root = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return root.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
