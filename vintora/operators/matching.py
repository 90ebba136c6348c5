"""Matching by nearness in time, incidents, and closure over dependencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _days(asks: DataFrame, marks: DataFrame, by: Sequence[str], ask_date: str, mark_date: str, mark: Column) -> DataFrame:
    """by columns, _day, _mark: every day of either side once; _mark is null where only asks stand.

    Whatever the sides hold, a `by` value has no more rows than there are days.
    """
    name = lambda c: F.col(c).cast("date").alias("_day")
    held = marks.select(*marks.columns, name(mark_date)).where("_day IS NOT NULL").groupBy(*by, "_day").agg(mark.alias("_mark"))
    asked = asks.select(*by, name(ask_date)).distinct()
    both = held.unionByName(asked, allowMissingColumns=True)
    return both.groupBy(*by, "_day").agg(F.max("_mark").alias("_mark"))


def nearest_within(left: DataFrame, right: DataFrame, by: Sequence[str], left_date: str, right_date: str, tie: str, days: int) -> DataFrame:
    """left with `tie`, of the right row of equal `by` that is nearest in time, and `distance` in days; null beyond `days`.

    Equal distances go by the smallest tie. Both sides are reduced to their days, over which the last one before and the
    first one after are carried along; no pair is ever built. Rows without a date or a `by` value match nothing.
    """
    known = _days(left, right.where(" AND ".join(f"{c} IS NOT NULL" for c in by)), by, left_date, right_date, F.min(tie))
    known = known.withColumn("_at", F.when(F.col("_mark").isNotNull(), F.struct("_day", "_mark")))
    back = Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    found = known.withColumns({"_before": F.last("_at", ignorenulls=True).over(back.orderBy("_day")), "_after": F.last("_at", ignorenulls=True).over(back.orderBy(F.desc("_day")))})
    gap = lambda c: F.datediff(F.col(f"{c}._day"), F.col("_day"))
    choice = lambda c: F.when(F.abs(gap(c)) <= days, F.struct(F.abs(gap(c)).alias("far"), F.col(f"{c}._mark").alias("tie"), gap(c).cast("long").alias("distance")))
    best = found.select(*by, "_day", F.least(choice("_before"), choice("_after")).alias("_best")).where("_best IS NOT NULL")
    asked = left.withColumn("_day", F.col(left_date).cast("date"))
    return asked.join(best, [*by, "_day"], "left").select(*left.columns, F.col("_best.tie").alias(tie), F.col("_best.distance").alias("distance"))


def carried_forward(marks: DataFrame, asks: DataFrame, by: Sequence[str], date: str, mark: str) -> DataFrame:
    """asks with `mark`: that of the newest row of marks with equal `by` whose date isn't later; null before the first.

    As in nearest_within, only days meet. Equal dates go by the larger mark.
    """
    known = _days(asks, marks.where(" AND ".join(f"{c} IS NOT NULL" for c in by)), by, date, date, F.max(mark))
    order = Window.partitionBy(*by).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    found = known.select(*by, "_day", F.last("_mark", ignorenulls=True).over(order).alias(mark))
    return asks.withColumn("_day", F.col(date).cast("date")).join(found, [*by, "_day"], "left").select(*asks.columns, mark)


def incidents(late: DataFrame, by: Sequence[str], date: str, gap_days: int) -> DataFrame:
    """Late rows with an incident number: a pause of more than gap_days begins a new one."""
    order = Window.partitionBy(*by).orderBy(date)
    new = F.coalesce((F.datediff(F.col(date), F.lag(date).over(order)) > gap_days).cast("int"), F.lit(1))
    return late.withColumn("_new", new).withColumn("incident", F.sum("_new").over(order.rangeBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_new")


def closure(edges: DataFrame, depth: int = 20) -> DataFrame:
    """(source, target, tier): everything each source depends on, with the fewest steps. Cycles are walked once.

    Each round joins only what the last one found; the registry of programs is small, so rounds are few.
    """
    known = edges.select("source", "target", F.lit(1).alias("tier")).distinct()
    fresh = known
    for step in range(2, depth + 1):
        reach = fresh.select("source", F.col("target").alias("via")).join(edges.select(F.col("source").alias("via"), "target"), "via").select("source", "target").distinct()
        fresh = reach.join(known, ["source", "target"], "left_anti").withColumn("tier", F.lit(step))
        if fresh.isEmpty():
            return known
        known = known.unionByName(fresh)
    return known
