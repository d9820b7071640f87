"""Connected components by alternating stars, every round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import stage


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node with a link; ``component`` is the smallest node reachable.

    ``edges`` has two long columns ``a, b``; loops are ignored. Each round
    hangs the larger neighbours of a node on its smallest one, then the smaller
    ones, until nothing changes; the number of rounds grows with the logarithm
    of the longest chain. Minima are pre-aggregated; only a count and a sum per
    round reach the driver.
    """
    a, b = edges.columns
    e = stage(edges.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b")).filter("a <> b").distinct(), "edges")
    last = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == last or not now[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        last = now
        e = stage(_small_star(_large_star(e)), "edges")
