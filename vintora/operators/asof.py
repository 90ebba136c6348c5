"""Point-in-time reading of a change log.

A row is visible if its release was committed. The state at an instant D is the newest visible row of each key
with knowledge_time <= D; only then are deletions dropped, since dropping them first would bring older values
back. The same instant is ordered by sequence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEY = ("program", "unit_key", "measure_code", "ref_date", "period_code")
#: Provenances a strict reading admits; a non-strict one admits all.
STRICT = ("observed", "seed")


def visible(log: DataFrame, committed: DataFrame) -> DataFrame:
    """Rows of committed releases. The manifest's size grows with the releases, so the join kind is left to Spark."""
    return log.join(committed.select("release_event_id"), "release_event_id", "left_semi")


def newest(rows: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """The newest row of each key by (knowledge_time, sequence): a partial top-1 before the exchange."""
    order = Window.partitionBy(*key).orderBy(F.desc("knowledge_time"), F.desc("sequence"))
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def of_years(rows: DataFrame, years: Sequence[int]) -> DataFrame:
    """Rows of some reference years; a stored log's folders of other years aren't opened."""
    if "ref_year" in rows.columns:
        rows = rows.where(F.col("ref_year").cast("int").isin(*years))
    return rows.where(F.year("ref_date").isin(*years))


def as_of(log: DataFrame, committed: DataFrame, at: Column, *, strict: bool = True, first_instant: Column | None = None, first_instants: DataFrame | None = None, years: Sequence[int] | None = None, key: Sequence[str] = KEY) -> DataFrame:
    """The state at an instant. A strict reading before first_instant is empty; at it, the seed is visible.

    first_instants (program, first_instant) gives each program its own: a strict reading has no rows of a program that
    hasn't begun by then, or that isn't named.
    """
    rows = log.where(F.col("knowledge_time") <= at)
    if strict:
        rows = rows.where(F.col("provenance").isin(*STRICT))
        if first_instant is not None:
            rows = rows.where(at >= first_instant)
        if first_instants is not None:
            rows = rows.join(first_instants.where(F.col("first_instant") <= at).select("program"), "program", "left_semi")
    if years is not None:
        rows = of_years(rows, years)
    return newest(visible(rows, committed), key).where("change_kind <> 'deleted'")


def unpinned_seeds(log: DataFrame, first_instants: DataFrame) -> DataFrame:
    """Seed rows that don't stand at their program's first instant, or whose program has none."""
    seeds = log.where("provenance = 'seed'").join(first_instants.select("program", "first_instant"), "program", "left")
    return seeds.where(~F.col("knowledge_time").eqNullSafe(F.col("first_instant")))


def as_of_spine(log: DataFrame, committed: DataFrame, spine: DataFrame, *, strict: bool = True, until: Column | None = None, key: Sequence[str] = KEY) -> DataFrame:
    """For each row of spine (key columns and `at`): the newest visible log row known then, deletions dropped.

    Log and spine are laid one after the other in time per key, and the last log row before each spine row is
    carried forward: one exchange, no range join. Rows that no spine row can see stay out of it: those of releases that
    were not committed, of provenances a strict reading doesn't admit, and those after `until`, the largest `at`, where
    it is given.
    """
    rows = visible(log, committed)
    if strict:
        rows = rows.where(F.col("provenance").isin(*STRICT))
    if until is not None:
        rows = rows.where(F.col("knowledge_time") <= until)
    held = [c for c in log.columns if c not in key]
    events = rows.select(*key, F.col("knowledge_time").alias("_at"), F.lit(0).alias("_asks"), F.struct(*held).alias("_row"))
    asks = spine.select(*key, F.col("at").alias("_at"), F.lit(1).alias("_asks"), F.lit(None).cast(events.schema["_row"].dataType).alias("_row"))
    order = Window.partitionBy(*key).orderBy("_at", "_asks", F.col("_row.sequence")).rowsBetween(Window.unboundedPreceding, 0)
    known = events.unionByName(asks).withColumn("_known", F.last("_row", ignorenulls=True).over(order))
    found = known.where("_asks = 1 AND _known IS NOT NULL").select(*key, F.col("_at").alias("at"), *(F.col(f"_known.{c}").alias(c) for c in held))
    return found.where("change_kind <> 'deleted'")


def revisions(log: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Every vintage of each key in order: its number, the value before it and the first value."""
    order = Window.partitionBy(*key).orderBy("knowledge_time", "sequence")
    return log.withColumns({
        "vintage": F.row_number().over(order).cast("long"),
        "prev_value": F.lag("value").over(order),
        "first_value": F.first("value").over(order),
    })


def broken_chain(log: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Rows whose stated prev_value isn't the value of the row before."""
    order = Window.partitionBy(*key).orderBy("knowledge_time", "sequence")
    rows = log.withColumns({"_before": F.lag("value").over(order), "_n": F.row_number().over(order)})
    return rows.where("_n > 1 AND NOT (prev_value <=> _before)").drop("_n").withColumnRenamed("_before", "value_before")


def repeated_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def backward_steps(log: DataFrame, by: Sequence[str], order_by: str, instant: str) -> DataFrame:
    """Rows whose instant lies before that of the row preceding them in order."""
    order = Window.partitionBy(*by).orderBy(order_by)
    return log.withColumn("_before", F.lag(instant).over(order)).where(F.col(instant) < F.col("_before")).drop("_before")


def published(knowability: DataFrame, at: Column) -> DataFrame:
    """Whether each period was published by an instant, and how sure that is: data later than its news bounds it from below."""
    return knowability.withColumns({
        "published": F.coalesce(F.col("data_at") <= at, F.lit(False)),
        "announced": F.coalesce(F.col("news_date") <= at, F.lit(False)),
        "confidence": F.when(F.col("data_at").isNull(), "uncertain").when(F.col("data_at") > F.col("news_date"), "lower_bound").otherwise("exact"),
    })
