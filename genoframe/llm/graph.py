"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.frames import checkpointed


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    d = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = d.groupBy("u").agg(F.min("v").alias("m"))
    inner = d.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 64) -> DataFrame:
    """``(node, component)`` for every node that has an edge; component is its smallest node.

    Self-loops, nulls and repeated edges are ignored. Rounds are O(log^2 n); each one is
    checkpointed in the shared folder. A node with very many neighbours is a key of
    pre-aggregated minima and of joins that AQE may split.
    """
    e = checkpointed(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                     .where(F.col("u") > F.col("v")).distinct())
    mark = (F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    seen = tuple(e.agg(*mark).first())
    for _ in range(max_rounds):
        if not seen[0]:
            break
        e = checkpointed(_small_star(_large_star(e)))
        now = tuple(e.agg(*mark).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not converge")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
