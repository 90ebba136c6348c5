"""The life of a release slot: what its events and the passing of time make of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Seconds: watching begins so long before a slot is due, and it is late so long after.
LEAD, GRACE = 300, 3 * 86_400
#: Events that give a slot an instant at which it is due.
DATED = ("predicted", "scheduled")
#: Events after which nothing happens any more; a cancellation only where a person may decide it.
ENDED = ("committed", "news_only")
#: Order of events that share an instant and a seq, whatever order they are read in: days first, the latest one last, then
#: what was published, then what a person decided, which counts only where nothing was published.
TURNS = (*DATED, "captured", *ENDED, "delayed", "cancelled")


def turn(kind: Column) -> Column:
    """The place of a kind among events of one instant and seq."""
    return F.array_position(F.array(*map(F.lit, TURNS)), kind)


def life(events: DataFrame, now: Column, lead: int = LEAD, grace: int = GRACE) -> DataFrame:
    """slot_id, state and due of each slot at an instant.

    events: slot_id, at, seq (order at one instant), kind, due. Dated events set or move the instant at which the slot is
    due, until it is captured; a late slot whose day moves ahead is scheduled again. `delayed` and `cancelled` are a
    person's decisions and count only while the slot is late; nothing else ever cancels. `captured`, `committed` and
    `news_only` come from what was published. Time alone makes a dated slot `watching`, then `late`. Dated events without
    an instant, other kinds, and events after `now` or without a slot or an instant of their own count for nothing.
    Events of one instant and seq follow TURNS.
    """
    order = ("at", "seq", "turn", "due")
    own = Window.partitionBy("slot_id").orderBy(*order)
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    kind = F.col("kind")
    dated = kind.isin(*DATED) & F.col("due").isNotNull()
    rows = events.select("slot_id", "at", "seq", "kind", "due").where("slot_id IS NOT NULL").where(F.col("at") <= now)
    rows = rows.where(dated | kind.isin("captured", "delayed", "cancelled", *ENDED))
    rows = rows.withColumn("turn", turn(kind))
    rows = rows.withColumn("taken", F.coalesce(F.max(kind == "captured").over(before), F.lit(False)))
    rows = rows.withColumn("due", F.last(F.when(dated & ~F.col("taken"), F.col("due")), ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    is_late = F.coalesce(F.col("at") >= F.col("due") + F.make_interval(secs=F.lit(grace)), F.lit(False))
    rows = rows.where(kind.isin(*ENDED) | (~F.col("taken") & (~kind.isin("delayed", "cancelled") | is_late)))
    rows = rows.withColumn("over", F.coalesce(F.max(kind.isin("cancelled", *ENDED)).over(before), F.lit(False))).where("NOT over")
    last = rows.groupBy("slot_id").agg(F.max_by(F.struct("kind", "due"), F.struct(*order)).alias("e")).select("slot_id", "e.*")
    waiting = F.when(now >= F.col("due") + F.make_interval(secs=F.lit(grace)), "late").when(now >= F.col("due") - F.make_interval(secs=F.lit(lead)), "watching").otherwise(kind)
    return last.select("slot_id", F.when(kind.isin(*DATED), waiting).otherwise(kind).alias("state"), "due")
