"""Connected components of a link table by alternating large-star and small-star steps.

Links never leave the executors; each round is a few joins and is stored, so a lost executor costs a round at
most. The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm._io import discard, stored


def _towards_least(links: DataFrame, larger: bool) -> DataFrame:
    """links: u, v. Each node's neighbours (the larger ones, or the smaller ones and itself) move to its least neighbour."""
    if larger:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (least node of its component) for every node of links (columns u, v, of one integer type)."""
    now = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    seen = mark(now)
    for _ in range(rounds):
        before, now = now, stored(_towards_least(_towards_least(now, True), False), "links")
        discard(before)
        if (found := mark(now)) == seen:
            break
        seen = found
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
