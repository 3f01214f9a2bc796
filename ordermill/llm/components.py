"""Connected components of a graph given as edges between longs, by alternating large and small stars.

Large star: a node's larger neighbours are linked to its smallest neighbour. Small star: a node and its
smaller neighbours are linked to the smallest of them. Both only need a minimum for each node, which is
combined before the shuffle, and an equi-join, which Spark may split; no node's links meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import stored


def _turned(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("v").alias("u"), F.col("u").alias("v"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(_turned(edges))
    lowest = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("low", "u"))
    larger = both.filter("v > u").join(lowest, "u")
    return larger.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(lowest, "u").filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node``, ``root``: every node of the edges (``u``, ``v``) and the smallest node reachable from it.

    Loops and repeated edges don't matter; no edges give no rows. Ends when a round changes no edge.
    """
    turned = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(turned.filter("u != v").distinct())
    state = [F.count(F.lit(1)), *(F.sum(F.xxhash64("u", "v") % p) for p in (1_000_000_007, 998_244_353))]
    before = edges.agg(*state).first()
    for _ in range(most_rounds):
        edges = stored(_small_star(_large_star(edges)))
        now = edges.agg(*state).first()
        if now == before:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        before = now
    raise RuntimeError(f"components still change after {most_rounds} rounds")
