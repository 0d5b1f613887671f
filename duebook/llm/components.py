"""Connected components by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014).
Every step joins two written tables, so a node with many edges is one skewed
join key, which adaptive execution splits, and never one group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) of all nodes that have an edge.

    Edges may repeat and come in either direction; loops and nulls are left out.
    """
    spark = edges.sparkSession
    pair = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    now = Scratch(spark)
    links = now.cut(pair.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct())
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return links.select(F.col("x").alias("node"), F.col("y").alias("root")).union(
                links.select(F.col("y"), F.col("y")).distinct()
            )
        before = state
        step, then = Scratch(spark), Scratch(spark)
        links = then.cut(_small_star(_large_star(links, step), step))
        step.clear()
        now.clear()
        now = then


def _large_star(links: DataFrame, step: Scratch) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest one."""
    both = links.union(links.select("y", "x"))
    least = step.cut(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")))
    up = links.select(F.col("y").alias("x"), F.col("x").alias("y"))
    return step.cut(up.join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct())


def _small_star(links: DataFrame, step: Scratch) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = step.cut(links.groupBy("x").agg(F.min("y").alias("m")))
    moved = links.join(least, "x").where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
    return moved.union(least.select("x", F.col("m").alias("y"))).distinct()
