"""Rebuilding the ledger from its log, and attesting batches of manifests."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintora.operators import asof, capture, control, diff, matching

#: What names a cell's row in a parsed artifact.
WIDE_KEY = ("program", "unit_key", "ref_date", "period_code")


def release_events(vintages: DataFrame, slots: DataFrame | None = None, near: int = 3, tolerance: str = "INTERVAL 30 MINUTES") -> DataFrame:
    """vintages with release_event_id, slot_id, knowledge_time and its source: each belongs to the nearest slot of its program.

    vintages: program, requested_at and more; slots: slot_id, program, scheduled_at, scheduled_at_source, notice_date.
    Without a slot within `near` days the event is out of cycle and known when it was observed.
    """
    observed = F.col("requested_at")
    name = F.sha2(F.concat_ws("|", "program", F.coalesce(F.col("slot_id").cast("string"), F.lit("~")), "file_vintage_id"), 256).alias("release_event_id")
    if slots is None:
        return vintages.withColumn("slot_id", F.lit(None).cast("string")).select("*", name, observed.alias("knowledge_time"), F.lit("observed").alias("knowledge_time_source"))
    due = slots.withColumn("_due", F.col("scheduled_at").cast("date"))
    placed = matching.nearest_within(vintages, due, ["program"], "requested_at", "_due", "slot_id", near).drop("distance")
    placed = placed.join(slots.drop("program"), "slot_id", "left")
    at, source, _ = control.knowledge_time(F.col("scheduled_at"), F.col("scheduled_at_source"), F.col("notice_date"), observed, F.expr(tolerance))
    return placed.select(*vintages.columns, "slot_id", name, at.alias("knowledge_time"), source.alias("knowledge_time_source"))


def rebuild(log: DataFrame, parse: Callable[[DataFrame], DataFrame], measures: Sequence[str], committed: Callable[[DataFrame], DataFrame], *, scope=None, footnote: str | None = None, slots: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every ledger table as a function of the capture log alone: vintages, events, observations, visible rows, state.

    parse: vintages -> wide rows (file_vintage_id, WIDE_KEY, measures, footnote); program: a column of the log; committed:
    events -> those of the manifest. Vintages are numbered by the log's order, within each artifact without gaps; events
    follow from them and the slots, observations from the differ over all vintages of an artifact, in the order of its
    numbers, and state from the observations. A rebuild gives the same rows and ids as the first run.
    """
    vintages = capture.numbered(capture.file_vintages(log))
    order = Window.partitionBy("url").orderBy("sequence")
    vintages = vintages.withColumn("vintage", F.row_number().over(order).cast("long"))
    events = release_events(vintages, slots)
    newest = vintages.groupBy("url").agg(F.max("vintage").alias("newest"))
    wide = parse(vintages).join(vintages.select("file_vintage_id", "url", "vintage"), "file_vintage_id").join(newest, "url")
    changes = diff.change_log(wide, ["url", *WIDE_KEY], "vintage", measures, F.col("newest"), scope, footnote)
    facts = events.select("url", "vintage", "file_vintage_id", "release_event_id", "knowledge_time", "knowledge_time_source", "sequence")
    observations = changes.withColumnRenamed("measure", "measure_code").join(facts, ["url", "vintage"]).withColumn("provenance", F.lit("observed"))
    visible = asof.visible(observations, committed(events))
    return {"file_vintage": vintages, "release_event": events, "observation": observations, "visible": visible, "current_state": asof.newest(visible)}


def batch_root(hashes: DataFrame, order_by: str, digest: str) -> str | None:
    """The root of a hash tree over a batch in order; an odd one out moves up as it is. None for an empty batch.

    Each round halves the rows: pairs meet by place, so no batch is collected.
    """
    level = capture.in_sequence(hashes.select(F.col(order_by).alias("o"), F.col(digest).alias("h")), ("o", "h"), "n").select((F.col("n") - 1).alias("n"), "h")
    left = level.count()
    while left > 1:
        both = level.groupBy(F.floor(F.col("n") / 2).alias("n")).agg(F.max(F.when(F.col("n") % 2 == 0, F.col("h"))).alias("a"), F.max(F.when(F.col("n") % 2 == 1, F.col("h"))).alias("b"))
        level = both.select("n", F.when(F.col("b").isNull(), F.col("a")).otherwise(F.sha2(F.concat("a", "b"), 256)).alias("h"))
        left = -(-left // 2)
    first = level.first()
    return first["h"] if first else None


def reconstructed(revisions: DataFrame, calendar: DataFrame) -> DataFrame:
    """Vintages recovered from a file of revisions: each row known since the release that produced it.

    revisions: program, ref_date, print (1 for the first), unit_key, measure_code, value; calendar: program, ref_date,
    print, released_at, release_event_id. Rows whose release the calendar doesn't hold stay out: no date is made up.
    """
    known = calendar.select("program", "ref_date", "print", F.col("released_at").alias("knowledge_time"), "release_event_id")
    return revisions.join(known, ["program", "ref_date", "print"]).where("knowledge_time IS NOT NULL").withColumn("provenance", F.lit("reconstructed"))
