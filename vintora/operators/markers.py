"""Effective-dated markers: what holds for the series of a scope from a day on, until the next marker of that scope.

markers: program, prefix (of the unit key; empty for a whole program), kind, effective (a day), marker_id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintora.operators.matching import carried_forward


def in_force(rows: DataFrame, markers: DataFrame, kinds: Sequence[str], day: str, unit: str = "unit_key") -> DataFrame:
    """rows (program, unit, day) with `marker` (effective, marker_id, kind): the one in force for the row's series that day.

    The longest prefix wins, within a scope the newest, on one day the larger id; null where none is in force. Kinds
    given together end each other, as a resumption ends a suspension. For each length of prefix (few, and found first)
    only distinct days of a scope meet, so nothing is broadcast and rows are dealt by scope and day.
    """
    wanted = markers.where(F.col("kind").isin(*kinds) & F.col("prefix").isNotNull())
    lengths = sorted((r[0] for r in wanted.select(F.length("prefix")).distinct().collect()), reverse=True)
    mark = F.struct("effective", "marker_id", "kind")
    found = rows
    for n in lengths:
        scope = wanted.where(F.length("prefix") == n).select("program", F.col("prefix").alias("_prefix"), F.col("effective").alias(day), mark.alias(f"_of{n}"))
        found = carried_forward(scope, found.withColumn("_prefix", F.substring(unit, 1, n)), ["program", "_prefix"], day, f"_of{n}").drop("_prefix")
    chosen = F.coalesce(*(F.col(f"_of{n}") for n in lengths)) if lengths else F.lit(None).cast("struct<effective:date,marker_id:bigint,kind:string>")
    return found.select(*rows.columns, chosen.alias("marker"))


def expected_loss(marker: Column) -> Column:
    """Whether a marker expects its series to be absent: announced as suspended or discontinued, and not resumed since."""
    return F.coalesce(marker["kind"].isin("suspension", "discontinuation"), F.lit(False))


def change_kind(prev: Column, value: Column, precision: Column, digits: int) -> Column:
    """same, precision_change (equal at the digits a marker announced) or revised."""
    return F.when(prev.eqNullSafe(value), "same").when(precision.isNotNull() & F.round(prev, digits).eqNullSafe(F.round(value, digits)), "precision_change").otherwise("revised")


def unmarked_break(prev: Column, value: Column, day: Column, marker: Column, jump: float, within: int) -> Column:
    """Whether a value jumps though no marker took effect in the `within` days before."""
    marked = F.coalesce(F.datediff(day, marker["effective"]) <= within, F.lit(False))
    return F.coalesce(F.abs(value - prev) >= jump, F.lit(False)) & ~marked
