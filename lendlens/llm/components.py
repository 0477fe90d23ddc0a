"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendlens.sources.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _digest(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b`` (null ends and loops are ignored).

    The component is its smallest node. Each step moves only edges; it is written to the shared
    folder, so lineage stays short. A hot node's rows are joined, never collected; the steps end
    when the edges form stars, after about log(size) rounds.
    """
    now = stage(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = _digest(now)
    while True:
        now = stage(_small_star(stage(_large_star(now), "large-star")), "small-star")
        after = _digest(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b")).distinct()
