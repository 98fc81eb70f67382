"""Connected components of a table of links, by star contraction in Spark.

Each round points every node at the least node near it and drops what the
pointing makes redundant; rounds grow with the logarithm of the longest chain.
Every round is a written table, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged

ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least reachable node) for every node that
    a link ``(a, b)`` of different nodes names; null ends link nothing."""
    now = staged(links.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a"))
                 .where("a is not null and b is not null and a <> b").distinct(), "links")
    last = _mark(now)
    for _ in range(ROUNDS):
        both = now.select("a", "b").union(now.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        wide = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        low = wide.groupBy("a").agg(F.min("b").alias("m"))
        near = wide.join(low, "a")
        before, now = now, staged(near.select("a", F.col("m").alias("b")).union(
            near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(), "links")
        discard(before)
        mark = _mark(now)
        if mark == last:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        last = mark
    raise RuntimeError(f"links did not settle in {ROUNDS} rounds")


def _mark(links: DataFrame) -> tuple:
    """How many links there are, and a sum of their hashes."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
