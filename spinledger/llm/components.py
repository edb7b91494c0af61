"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinledger.llm.common import written


def large_star(edges: DataFrame) -> DataFrame:
    """Every node ties its larger neighbours to the smallest node it knows."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Every node ties itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """Rows (node, root) of every node of ``edges`` (a, b); the root is the smallest node.

    Only minima per node and joins on them are exchanged, so a hub is pre-aggregated by its map
    tasks and split by the adaptive join. Rounds grow with the logarithm of the longest chain;
    each writes its edges, so that a lost executor costs one round.
    """
    edges, before = edges.select("a", "b").filter("a != b").distinct(), None
    while True:
        edges = written(small_star(large_star(edges)).filter("a != b").distinct(), "stars")
        state = edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            F.count_distinct("b"),
            F.count_distinct("a"),
        ).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
