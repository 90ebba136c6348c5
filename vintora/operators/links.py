"""Sets that change from vintage to vintage, held as intervals: each member with the first and last vintage of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def intervals(captures: DataFrame, by: Sequence[str], member: str) -> DataFrame:
    """by, member, first, last of captures (by, member, vintage): runs of consecutive vintages that held a member.

    Repeated rows are combined before the one exchange; a member's array is no longer than there are vintages.
    """
    held = captures.groupBy(*by, member).agg(F.collect_set("vintage").alias("_in")).withColumn("_in", F.array_sort("_in"))
    edge = lambda step: F.filter("_in", lambda v: ~F.array_contains(F.col("_in"), v + step))
    runs = held.select(*by, member, F.explode(F.arrays_zip(edge(-1).alias("first"), edge(1).alias("last"))).alias("_run"))
    return runs.select(*by, member, F.col("_run.first").alias("first"), F.col("_run.last").alias("last"))


def advanced(held: DataFrame, newest: DataFrame, by: Sequence[str], member: str, vintage: int) -> DataFrame:
    """The intervals after one more capture, newest (by, member), numbered one above the last; none before it is read.

    Open intervals grow, new and returning members begin one, the others stand. The same capture twice changes nothing.
    """
    now = newest.select(*by, member).distinct().withColumn("_now", F.lit(vintage))
    open_runs = held.where(F.col("last") >= vintage - 1).join(now, [*by, member], "full")
    grown = open_runs.select(*by, member, F.coalesce("first", "_now").alias("first"), F.coalesce("_now", "last").alias("last"))
    return held.where(F.col("last") < vintage - 1).select(*grown.columns).unionByName(grown)


def between(held: DataFrame, by: Sequence[str], member: str, before: int, after: int) -> DataFrame:
    """by, member, change (added, removed) between any two vintages."""
    there = lambda v: F.max(F.lit(v).between(F.col("first"), F.col("last")))
    both = held.groupBy(*by, member).agg(there(before).alias("_a"), there(after).alias("_b")).where("_a <> _b")
    return both.select(*by, member, F.when(F.col("_b"), "added").otherwise("removed").alias("change"))
