"""Connected components by alternating stars, all rounds on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges (a, b), a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = both.join(least, "a")
    if large:
        out = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b: long); comp is the least node reachable.

    Large-star and small-star steps in turn end when the edges stay the same; the number of rounds
    goes with the logarithm of the longest path. Hubs are only ever grouped (combined before the
    shuffle) or joined (split by AQE), never collected.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    mark = None
    for _ in range(most_rounds):
        before, now = now, stored(_star(_star(now, True), False), "components")
        forget(before)
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
