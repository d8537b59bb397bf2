"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import settled


def _digest(edges: DataFrame) -> tuple:
    # The sum of 32 bits of each hash cannot overflow a long below 2^31 edges per partial sum
    # of 2^32; a decimal keeps it exact beyond.
    mark = F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 32)).cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), mark).first())


def star_round(edges: DataFrame, parts: int) -> DataFrame:
    """Edges after one large-star and one small-star step."""
    # Large star: every larger neighbour of a node hangs from the node's minimum.
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(parts)
    least = both.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("n"), F.least("u", "low").alias("low")
    )
    large = (
        both.join(least, F.col("u") == F.col("n"))
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
        .distinct()
        .coalesce(parts)
    )
    # Small star: a node and its smaller neighbours hang from their minimum.
    lowest = large.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("n"), "low")
    small = large.join(lowest, F.col("u") == F.col("n")).select("u", "v", "low").coalesce(parts)
    hung = small.where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return small.select("u", F.col("low").alias("v")).unionByName(hung).distinct()


def connected_components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(``node``, ``root``): the smallest node reachable from each node of (``u``, ``v``).

    Both steps group by node with a map-side minimum and join the minimum back, so a node with
    very many neighbours is only ever a skewed join, which adaptive execution splits.  Every
    round is checkpointed; their number grows with the logarithm of the diameter.  With
    ``rounds`` it stops earlier: then a root is some smaller node of the same component.
    """
    edges = settled(
        edges.where("u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    seen, turn = None, 0
    while not edges.isEmpty() and turn != rounds:
        parts = max(1, -(-edges.count() // 100_000))
        edges, turn = settled(star_round(edges, parts)), turn + 1
        if rounds is None:
            now = _digest(edges)
            if now == seen:
                break
            seen = now
    best = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    tops = edges.select(F.col("v").alias("node")).distinct()
    alone = tops.join(best, "node", "left_anti").withColumn("root", F.col("node"))
    return best.unionByName(alone)
