"""The control plane: signals, clocks, classification of notices and releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZONE = "America/New_York"
#: Where a scheduled time may come from to count as knowledge.
ELIGIBLE = ("ics", "schedule_page")


def three_signal(cadence: Column, calendar: Column, artifact: Column, expects_change: Column) -> Column:
    """What three independent signals say about a slot."""
    return (
        F.when(cadence & calendar & artifact, F.when(expects_change, "normal").otherwise("unexpected_change"))
        .when(cadence & calendar & ~artifact, F.when(expects_change, "late").otherwise("news_only"))
        .when(cadence & ~calendar & artifact, "unannounced")
        .when(cadence & ~calendar, "predicted")
        .when(calendar & artifact, "cadence_gap")
        .when(calendar, "registry_gap")
        .when(artifact, "silent_mutation")
        .otherwise("nothing")
    )


def with_notice(signal: Column, noticed: Column) -> Column:
    """The action once a notice is taken into account; it changes three rows of the table."""
    return F.when(noticed & (signal == "late"), "rescheduled").when(noticed & (signal == "cadence_gap"), "classified_by_notice").when(noticed & (signal == "silent_mutation"), "correction").otherwise(signal)


def slot_state(signal: Column, due: Column, now: Column, grace_days: int = 3, notice: Column | None = None, new_date: Column | None = None, triage: Column | None = None) -> Column:
    """State of a slot.

    notice: class of a notice about it; new_date: the day it names, if any; triage: what a person decided on a late slot
    (`delayed` or `cancelled`). Nothing is ever cancelled but by a person. A rescheduled slot is the same slot with another
    due day: scheduled again while that lies ahead.
    """
    late = F.datediff(now, due) > grace_days
    moved = F.lit(False) if notice is None or new_date is None else F.coalesce((notice == "reschedule") & new_date.isNotNull(), F.lit(False))
    held_up = F.lit(False) if notice is None else F.coalesce(notice == "delay", F.lit(False))
    decided = F.lit(None).cast("string") if triage is None else F.when(triage.isin("delayed", "cancelled"), triage)
    waiting = F.when(due > now, "scheduled").otherwise("watching")
    again = waiting if new_date is None else F.when(new_date > now, "scheduled").when(F.datediff(now, new_date) > grace_days, "late").otherwise("watching")
    return (
        F.when(signal.isin("normal", "unexpected_change"), "committed")
        .when(signal == "news_only", "news_only")
        .when(signal.isin("unannounced", "cadence_gap"), "captured")
        .when(signal == "silent_mutation", "unscheduled")
        .when((signal == "late") & moved, again)
        .when((signal == "late") & late, F.coalesce(decided, F.when(held_up, "delayed"), F.lit("late")))
        .when(signal == "late", waiting)
        .when(signal == "registry_gap", "scheduled")
        .otherwise("predicted")
    )


def fan_out(entries: DataFrame, registry: DataFrame) -> DataFrame:
    """Calendar entries once for each program their title stands for; `unassigned` for titles the registry doesn't know.

    registry: title, programs (array); a row for each title.
    """
    known = entries.join(registry.select("title", "programs"), "title", "left")
    return known.withColumn("program", F.explode(F.coalesce("programs", F.array(F.lit("unassigned"))))).drop("programs")


def rescheduled(slots: DataFrame, entries: DataFrame) -> DataFrame:
    """Slots after their calendar entries changed: slot_id, due, predicted_from, change.

    slots: slot_id, entry_id, due, estimate (the cadence's day); entries: entry_id, entry_date, as they stand now. A moved
    entry moves the slot; a removed one leaves it to the cadence's estimate; a slot without an entry stays.
    """
    now = entries.select("entry_id", "entry_date", F.lit(True).alias("_there"))
    both = slots.join(now, "entry_id", "left")
    gone = F.col("entry_id").isNotNull() & F.col("_there").isNull()
    change = F.when(F.col("entry_id").isNull(), "none").when(gone, "removed").when(F.col("entry_date") != F.col("due"), "moved").otherwise("none")
    due = F.when(gone, F.col("estimate")).when(F.col("entry_id").isNull(), F.col("due")).otherwise(F.col("entry_date"))
    return both.select("slot_id", due.alias("due"), F.when(gone | F.col("entry_id").isNull(), "cadence").otherwise("calendar").alias("predicted_from"), change.alias("change"))


def placed_by_cadence(archive: DataFrame, periods: DataFrame, near: int) -> DataFrame:
    """program, ref_date, release_date, dates, finding, confidence: archive dates laid on the periods a cadence implies.

    archive: program, release_date; periods: program, ref_date, expected (the cadence's day). Each date goes to the period
    expected nearest to it, which keeps their order, if that is at most `near` days off. A period with one date is
    `on_cadence` and exact; with none `missing`, with several `doubled` (the first of them is given), and a date that
    fits no period is `off_cadence`, without a period: all uncertain.
    """
    from vintora.operators.matching import nearest_within

    placed = nearest_within(archive.select("program", "release_date").distinct(), periods, ["program"], "release_date", "expected", "ref_date", near)
    held = placed.where("ref_date IS NOT NULL").groupBy("program", "ref_date").agg(F.min("release_date").alias("release_date"), F.count("*").alias("dates"))
    every = periods.select("program", "ref_date").distinct().join(held, ["program", "ref_date"], "left").withColumn("dates", F.coalesce("dates", F.lit(0)))
    finding = F.when(F.col("ref_date").isNull(), "off_cadence").when(F.col("dates") == 0, "missing").when(F.col("dates") > 1, "doubled").otherwise("on_cadence")
    strays = placed.where("ref_date IS NULL").select("program", "ref_date", "release_date", F.lit(1).cast("long").alias("dates"))
    both = every.select("program", "ref_date", "release_date", F.col("dates").cast("long").alias("dates")).unionByName(strays).withColumn("finding", finding)
    return both.withColumn("confidence", F.when(F.col("finding") == "on_cadence", "exact").otherwise("uncertain"))


def armed_by_feed(seen: DataFrame, feed: DataFrame, slots: DataFrame, near: int = 1) -> DataFrame:
    """program, entry, day, slot_id, arms of the feed's new and changed entries: each arms its program at once.

    seen: program, entry, stamp (entries of the last reading); feed: the same now, with day; slots: slot_id, program, due.
    A slot due within `near` days is armed; without one an out-of-cycle slot is minted. The feed arms, it never tells
    what was published.
    """
    from vintora.operators.matching import nearest_within

    fresh = feed.join(seen.select("program", "entry", "stamp"), ["program", "entry", "stamp"], "left_anti").select("program", "entry", "day")
    found = nearest_within(fresh, slots, ["program"], "day", "due", "slot_id", near)
    return found.select("program", "entry", "day", "slot_id", F.when(F.col("slot_id").isNull(), "mint_out_of_cycle").otherwise("arm").alias("arms"))


def population_break(month: Column, step: Column, usual: Column, announced: Column) -> Column:
    """Whether a January level is a population-control break: January, a step far beyond the usual one, and a notice."""
    return F.coalesce((month == 1) & (F.abs(step) > 3 * usual) & announced, F.lit(False))


def end_of_day(day: Column, zone: str = ZONE) -> Column:
    """The last microsecond of a local day, as a UTC timestamp without zone."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), F.date_add(day, 1).cast("timestamp_ntz") - F.expr("INTERVAL '0.000001' SECOND"))


def to_utc(local: Column, zone: str = ZONE) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def knowledge_time(scheduled: Column, source: Column, notice: Column, observed: Column, tolerance: Column) -> tuple[Column, Column, Column]:
    """(instant, its source, flag). Only calendar times count; a date is never widened to an earlier instant."""
    eligible = F.when(source.isin(*ELIGIBLE), scheduled)
    late = eligible.isNotNull() & (observed > eligible + tolerance)
    used = F.when(~late, eligible)
    noticed = F.when(notice.isNotNull(), F.greatest(end_of_day(notice), observed))
    flag = F.when(late, "late_artifact").when(eligible.isNotNull() & (observed < eligible - tolerance), "early_artifact")
    return F.coalesce(used, noticed, observed), F.when(used.isNotNull(), "scheduled").when(noticed.isNotNull(), "notice").otherwise("observed"), flag


# Words that place a notice in a class, tried in order; no match is `unknown`, never a guess.
NOTICE_CLASSES = [
    ("reschedule", "rescheduled|new release date"),
    ("delay", "postponed|delayed"),
    ("correction", "correction|corrected"),
    ("reweight", "weights|rebased"),
    ("precision_change", "decimal"),
    ("population_control", "population control"),
    ("discontinuation", "discontinued"),
    ("suspension", "suspended"),
    ("resumption", "resumed"),
    ("methodology", "redesign|methodology|transition"),
]


def notice_class(title: Column) -> Column:
    found = F.lit("unknown")
    for name, pattern in reversed(NOTICE_CLASSES):
        found = F.when(F.lower(title).rlike(pattern), name).otherwise(found)
    return found


def errata_action(product: Column, program_known: Column, due: Column, added: Column) -> Column:
    return F.when(~program_known, "triage").when(~F.contains(product, F.lit("Database")), "record").when(due > added, "arm_scheduled").otherwise("arm")
