"""Comparing snapshots: wide tables, catalogs, sets and replays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def wide_diff(prev: DataFrame, cur: DataFrame, key: Sequence[str], measures: Sequence[str], scope: Column | None = None, footnote: str | None = None, precision: tuple[Column, int] | None = None) -> DataFrame:
    """Changed cells of two wide snapshots: key, measure, value, prev_value, change_kind.

    The tables are joined once and wide; only changed cells are melted. Rows missing from cur are deleted only
    inside `scope`, a condition on the key columns: without one, nothing is deleted. A change of the footnote
    column alone is a change of its own. precision is a condition on the key columns, true where a marker of changed
    precision is in force, and the digits of the coarser side: values that agree at these are no revision there.
    """
    side = lambda df, tag: df.select(*key, *(F.col(m).cast("double").alias(f"{tag}_{m}") for m in measures), *([F.col(footnote).alias(f"{tag}_footnote")] if footnote else []), F.lit(True).alias(f"{tag}_in"))
    both = side(prev, "p").join(side(cur, "c"), list(key), "full_outer")
    gone = F.col("c_in").isNull()
    if scope is None:
        both = both.where(~gone)
    else:
        both = both.where(~gone | scope)

    def kind(m: str) -> Column:
        p, c = F.col(f"p_{m}"), F.col(f"c_{m}")
        found = F.when(F.col("p_in").isNull(), "first_print").when(gone, "deleted").when(p.isNotNull() & c.isNull(), "suppressed").when(p.isNull() & c.isNotNull(), "unsuppressed")
        if precision:
            found = found.when((p != c) & precision[0] & same_at(p, c, precision[1]), "precision_only")
        found = found.when(p != c, "revised")
        return found.when(~F.col("p_footnote").eqNullSafe(F.col("c_footnote")), "footnote_only") if footnote else found

    cells = F.array(*(F.struct(F.lit(m).alias("measure"), F.col(f"c_{m}").alias("value"), F.col(f"p_{m}").alias("prev_value"), kind(m).alias("change_kind")) for m in measures))
    return both.select(*key, F.inline(F.filter(cells, lambda c: c["change_kind"].isNotNull())))


def change_log(rows: DataFrame, key: Sequence[str], vintage: str, measures: Sequence[str], newest: Column, scope: Column | None = None, footnote: str | None = None, precision: tuple[Column, int] | None = None) -> DataFrame:
    """The whole change log of an artifact from all its vintages: key, vintage, measure, value, prev_value, change_kind.

    rows: key, vintage (numbered without gaps) and measures, one row for each key of each vintage; newest: the number of
    the last vintage, a literal or a column of rows where artifacts have their own. One exchange by key: a row is compared
    with the key's row before it, and a gap in the key's run of numbers is a deletion at its first vintage and a
    reinstatement at the row behind it. Keys outside `scope`, a condition on the key columns, are never deleted: their next row
    is compared with their last. Without a scope nothing is deleted. precision is a condition on key and vintage, as in
    wide_diff, which this equals when it is applied to each vintage and the state before it.
    """
    held = F.struct(*(F.col(m).cast("double").alias(m) for m in measures), *([F.col(footnote).alias("_footnote")] if footnote else []))
    order = Window.partitionBy(*key).orderBy("vintage")
    run = rows.where(F.col(vintage).isNotNull()).select(*key, F.col(vintage).cast("long").alias("vintage"), held.alias("_c"), newest.cast("long").alias("_newest"))
    run = run.withColumns({"_p": F.lag("_c").over(order), "_back": F.lag("vintage").over(order), "_next": F.lead("vintage").over(order)})
    # a row for each vintage in which something may have happened: its own, and the one after it, where the key is gone
    scoped = F.lit(False) if scope is None else F.coalesce(scope, F.lit(False))
    ends = scoped & (F.coalesce("_next", F.col("_newest") + 1) > F.col("vintage") + 1)
    again = scoped & (F.col("_back") < F.col("vintage") - 1)

    def kind(m: str) -> Column:
        p, c = F.col(f"_p.{m}"), F.col(f"_c.{m}")
        found = F.when(F.col("_back").isNull(), "first_print").when(again, "reinstated").when(p.isNotNull() & c.isNull(), "suppressed").when(p.isNull() & c.isNotNull(), "unsuppressed")
        if precision:
            found = found.when((p != c) & precision[0] & same_at(p, c, precision[1]), "precision_only")
        found = found.when(p != c, "revised")
        return found.when(~F.col("_p._footnote").eqNullSafe(F.col("_c._footnote")), "footnote_only") if footnote else found

    cell = lambda v, m, value, prev, what: F.struct(v.alias("vintage"), F.lit(m).alias("measure"), value.alias("value"), prev.alias("prev_value"), what.alias("change_kind"))
    none = F.lit(None).cast("double")
    own = [cell(F.col("vintage"), m, F.col(f"_c.{m}"), F.when(~again, F.col(f"_p.{m}")), kind(m)) for m in measures]
    gone = [cell(F.col("vintage") + 1, m, none, F.col(f"_c.{m}"), F.when(ends, "deleted")) for m in measures]
    return run.select(*key, F.inline(F.filter(F.array(*own, *gone), lambda c: c["change_kind"].isNotNull())))


def reinstated(changes: DataFrame, last: DataFrame, key: Sequence[str]) -> DataFrame:
    """First prints of keys whose last recorded change was a deletion are reinstatements."""
    gone = last.where("change_kind = 'deleted'").select(*key, F.lit(True).alias("_gone"))
    kind = F.when((F.col("change_kind") == "first_print") & F.col("_gone"), "reinstated").otherwise(F.col("change_kind"))
    return changes.join(gone, list(key), "left").withColumn("change_kind", kind).drop("_gone")


def same_at(a: Column, b: Column, digits: int) -> Column:
    """Whether two values agree once both are rounded to the coarser precision."""
    return F.round(a, digits) == F.round(b, digits)


def catalog_diff(prev: DataFrame, cur: DataFrame, key: str, title: str = "title", code: str = "code") -> DataFrame:
    """Status of every series of two rosters: added, discontinued, retitled, recoded or present."""
    p = prev.select(F.col(key), F.col(title).alias("old_title"), F.col(code).alias("old_code"), F.lit(1).alias("_p"))
    c = cur.select(F.col(key), F.col(title).alias("new_title"), F.col(code).alias("new_code"), F.lit(1).alias("_c"))
    status = F.when(F.col("_p").isNull(), "added").when(F.col("_c").isNull(), "discontinued").when(~F.col("old_code").eqNullSafe(F.col("new_code")), "recoded").when(~F.col("old_title").eqNullSafe(F.col("new_title")), "retitled").otherwise("present")
    return p.join(c, key, "full_outer").select(key, status.alias("status"))


def set_diff(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Rows of only one of two sets, with change `added` or `removed`."""
    p, c = prev.distinct(), cur.distinct()
    return c.exceptAll(p).withColumn("change", F.lit("added")).unionByName(p.exceptAll(c).withColumn("change", F.lit("removed")))


def mass_change(prev: DataFrame, cur: DataFrame, key: Sequence[str], measures: Sequence[str], by: Sequence[str], share: float) -> DataFrame:
    """by columns, live (series of the earlier snapshot), revised (of them) and whether these are more than a share."""
    live = prev.groupBy(*by).agg(F.count("*").alias("live"))
    changed = wide_diff(prev, cur, key, measures).where("change_kind = 'revised'").select(*key).distinct().groupBy(*by).agg(F.count("*").alias("revised"))
    revised = F.coalesce("revised", F.lit(0))
    return live.join(changed, list(by), "left").select(*by, "live", revised.alias("revised"), (revised > share * F.col("live")).alias("tripped"))


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in key))), 1, 8), 16, 10).cast("long"), F.lit(buckets))


def bucket_hashes(rows: DataFrame, key: Sequence[str], values: Sequence[str], buckets: int, partition: Sequence[str] = ()) -> DataFrame:
    """An order-free hash and count of each bucket of rows. Hashes of rows are summed, so no bucket is collected."""
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in (*key, *values)))
    digits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("decimal(38,0)")
    return rows.groupBy(*partition, _bucket(key, buckets).alias("bucket")).agg(F.count("*").alias("n"), F.sum(digits).cast("decimal(38,0)").cast("string").alias("hash"))


def differing_buckets(a: DataFrame, b: DataFrame, partition: Sequence[str] = ()) -> DataFrame:
    """Buckets whose hashes differ, or that only one side has: where a replay must be compared row by row."""
    on = [*partition, "bucket"]
    left = a.select(*on, F.col("hash").alias("left_hash"))
    right = b.select(*on, F.col("hash").alias("right_hash"))
    return left.join(right, on, "full_outer").where("NOT (left_hash <=> right_hash)")


def disagreement(a: DataFrame, b: DataFrame, key: Sequence[str], value: str, tolerance: float | None = None) -> DataFrame:
    """Keys whose values disagree: exactly, missing ones included; or, with a tolerance, beyond it where both exist."""
    left, right = a.select(*key, F.col(value).alias("left_value")), b.select(*key, F.col(value).alias("right_value"))
    if tolerance is None:
        return left.join(right, list(key), "full_outer").where("NOT (left_value <=> right_value)")
    return left.join(right, list(key)).where(F.abs(F.col("left_value") - F.col("right_value")) > tolerance * F.abs(F.col("right_value")))
