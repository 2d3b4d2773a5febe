"""Connected components of an edge table by alternating large and small stars.

Large star: each node u passes the least node m of its neighbourhood to its larger
neighbours. Small star: each node passes it to its smaller neighbours and itself. Both are
a map-side combined minimum per node and an equi-join, so a node with very many neighbours
is never gathered in one place; rounds grow with the logarithm of the component size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlegap.llm.common import written


def _least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of each u to its neighbours v, with the least neighbour or u itself."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (columns a, b): the least node of its component."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = written(now, "edges")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _least(large)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = written(small, "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
