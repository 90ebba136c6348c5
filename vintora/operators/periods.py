"""Reference periods and what a release touches, read backward from its newest period t_max."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Delta rules. program, kind, month of t_max the rule needs (0: any), seasonality, first period
# touched and last period touched. Periods are (anchor, years, months): anchor "t" is t_max, "y" is January of
# t_max's year.
RULES = [
    ("ces-n", "routine", 0, "both", ("t", 0, -2), ("t", 0, 0)),
    ("ces-n", "benchmark", 1, "nsa", ("y", -2, 3), ("y", -1, 11)),
    ("ces-n", "benchmark", 1, "sa", ("y", -5, 0), ("y", -1, 11)),
    ("sae", "routine", 0, "both", ("t", 0, -1), ("t", 0, 0)),
    ("sae", "benchmark", 1, "nsa", ("y", -2, 3), ("y", -1, 11)),
    ("sae", "benchmark", 1, "sa", ("y", -5, 0), ("y", -1, 11)),
    ("jolts", "routine", 0, "both", ("t", 0, -1), ("t", 0, 0)),
    ("jolts", "benchmark", 1, "both", ("y", -5, 0), ("y", -1, 11)),
    ("jolts-state", "routine", 0, "both", ("t", 0, 0), ("t", 0, 0)),
    ("jolts-state", "benchmark", 1, "both", ("y", -5, 0), ("y", -1, 11)),
    ("cps-ln", "routine", 0, "both", ("t", 0, 0), ("t", 0, 0)),
    ("cps-ln", "annual_revision", 12, "sa", ("y", -4, 0), ("y", 0, 10)),
    ("cps-ln", "population_control", 1, "both", ("t", 0, 0), ("t", 0, 0)),
    ("bed", "routine", 0, "both", ("t", 0, 0), ("t", 0, 0)),
    ("bed", "annual_revision", 1, "nsa", ("y", -1, 0), ("y", -1, 9)),
    ("bed", "annual_revision", 1, "sa", ("y", -5, 0), ("y", -1, 9)),
    ("qcew", "full_data", 1, "nsa", ("t", 0, -12), ("t", 0, 0)),
    ("qcew", "full_data", 4, "nsa", ("t", 0, -3), ("t", 0, 0)),
    ("qcew", "full_data", 7, "nsa", ("t", 0, -6), ("t", 0, 0)),
    ("qcew", "full_data", 10, "nsa", ("t", 0, -9), ("t", 0, 0)),
    ("qcew", "annual_average", 10, "nsa", ("y", 0, 0), ("y", 0, 0)),
    ("qcew", "annual_average", 1, "nsa", ("y", -1, 0), ("y", -1, 0)),
    ("oews", "new_vintage", 0, "nsa", ("t", 0, 0), ("t", 0, 0)),
    ("eci", "routine", 0, "both", ("t", 0, 0), ("t", 0, 0)),
    ("eci", "sa_revision", 1, "sa", ("y", -5, 0), ("y", -1, 9)),
    ("ecec", "routine", 0, "nsa", ("t", 0, 0), ("t", 0, 0)),
    ("ep", "new_vintage", 0, "nsa", ("t", 0, 0), ("t", 0, 0)),
]
# Kinds that a notice or another artifact announces, since no newest period implies them; whether the data
# artifact changes, and how far back: all periods (`unbounded`), the newest (`newest`) or none.
ANNOUNCED = [
    ("ces-n", "preliminary_benchmark", False, "none"),
    ("qcew", "news_release", False, "none"),
    ("eci", "reweight", True, "unbounded"),
    ("ep", "wage_refresh", True, "newest"),
    ("all", "correction", True, "unbounded"),
]
# Footprints that may reach further than stated.
LOWER_BOUND = {("ces-n", "benchmark"), ("sae", "benchmark"), ("all", "correction"), ("eci", "reweight")}
# Months from one period to the next.
STEP = {"ces-n": 1, "sae": 1, "jolts": 1, "jolts-state": 1, "cps-ln": 1, "bed": 3, "qcew": 3, "oews": 12, "eci": 3, "ecec": 3, "ep": 12}
# Stage of a period by its distance from t_max, in periods.
STAGES = {"ces-n": ("first_prelim", "second_prelim", "third_final"), "sae": ("preliminary", "final"), "jolts": ("preliminary", "final"), "cps-ln": ("final",), "oews": ("vintage",), "ep": ("vintage",)}


def rules(spark: SparkSession) -> DataFrame:
    """The delta rules as a table: one row for each program, kind and seasonality."""
    rows = [(p, k, m, s, STEP[p], a[0], 12 * a[1] + a[2], b[0], 12 * b[1] + b[2]) for p, k, m, season, a, b in RULES for s in (("nsa", "sa") if season == "both" else (season,))]
    return spark.createDataFrame(rows, "program string, kind string, month int, seasonality string, step int, lo_from string, lo int, hi_from string, hi int")


def footprint(releases: DataFrame, table: DataFrame) -> DataFrame:
    """(release columns, kind, seasonality, ref_date): every period each release touches, all kinds united.

    releases: program, t_max (date, first of its period). Annual kinds add to the routine one.
    """
    anchor = lambda c: F.when(F.col(c) == "t", F.col("t_max")).otherwise(F.trunc("t_max", "year"))
    hit = releases.join(table, "program").where((F.col("month") == 0) | (F.col("month") == F.month("t_max")))
    span = F.expr("sequence(lo_date, hi_date, make_interval(0, step))")
    hit = hit.withColumns({"lo_date": F.add_months(anchor("lo_from"), F.col("lo")), "hi_date": F.add_months(anchor("hi_from"), F.col("hi"))})
    return hit.select(*releases.columns, "kind", "seasonality", F.explode(span).alias("ref_date")).distinct()


def is_lower_bound(program: Column, kind: Column) -> Column:
    """Whether a footprint is known from below only; what it touches beyond is no divergence."""
    found = F.lit(False)
    for p, k in sorted(LOWER_BOUND):
        found = found | ((F.lit(True) if p == "all" else program == p) & (kind == k))
    return found


def announced(releases: DataFrame, events: DataFrame) -> DataFrame:
    """Release columns, kind, expects_change, reach, lower_bound: the secondary kinds that announcements give a release.

    events: program, kind, t_max, as matched from notices, errata or changed hashes. A correction applies to any program.
    """
    rules_ = releases.sparkSession.createDataFrame(ANNOUNCED, "of string, kind string, expects_change boolean, reach string")
    hit = releases.join(events.select("program", "t_max", "kind").distinct(), ["program", "t_max"]).join(F.broadcast(rules_), "kind")
    hit = hit.where((F.col("of") == "all") | (F.col("of") == F.col("program")))
    return hit.select(*releases.columns, "kind", "expects_change", "reach", is_lower_bound(F.col("program"), F.col("kind")).alias("lower_bound"))


#: Kinds that a release is by itself; all others ride on one.
PRIMARY = ("routine", "new_vintage", "full_data")
# Secondary kinds in their order.
SECONDARY = ("benchmark", "annual_revision", "population_control", "sa_revision", "annual_average", "correction", "reweight", "wage_refresh")
#: Hundredths of the periods that a kind adds to the routine ones which a release must touch to be of that kind.
CONTAINED = 80


def coverage(releases: DataFrame, observed: DataFrame, table: DataFrame, key: str = "release_id") -> DataFrame:
    """key, n_observed, kinds (kind, expected, hit, beyond, beyond_hit of each), spare: observed periods against all footprints.

    releases: key, program, t_max; observed: key, seasonality, ref_date, what each release touched. expected and hit count a
    kind's periods, beyond and beyond_hit those that no primary kind's footprint holds; spare are observed ones in no
    footprint. Each period of a release is one row, so containment of all kinds is two sums.
    """
    cover = footprint(releases.select(key, "program", "t_max"), table)
    by = [key, "seasonality", "ref_date"]
    cover = cover.groupBy(*by).agg(F.collect_set("kind").alias("kinds"))  # a few kinds at most
    seen = observed.select(*by).distinct().withColumn("seen", F.lit(True))
    both = cover.join(seen, by, "full_outer").withColumn("seen", F.coalesce("seen", F.lit(False)))
    both = both.withColumn("base", F.arrays_overlap("kinds", F.array(*map(F.lit, PRIMARY))))
    one = lambda c: F.count(F.when(c, 1))
    kind = both.select(key, "seen", "base", F.explode_outer("kinds").alias("kind")).groupBy(key, "kind").agg(
        F.count("*").alias("expected"), one(F.col("seen")).alias("hit"), one(~F.col("base")).alias("beyond"), one(~F.col("base") & F.col("seen")).alias("beyond_hit")
    )
    each = F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("kind", "expected", "hit", "beyond", "beyond_hit")))
    kinds = kind.groupBy(key).agg(each.alias("kinds"), F.coalesce(F.sum(F.when(F.col("kind").isNull(), F.col("hit"))), F.lit(0)).alias("spare"))
    count = seen.groupBy(key).agg(F.count("*").alias("n_observed"))
    return releases.select(key).join(kinds, key, "left").join(count, key, "left").select(key, F.coalesce("n_observed", F.lit(0)).alias("n_observed"), "kinds", F.coalesce("spare", F.lit(0)).alias("spare"))


def classified(releases: DataFrame, observed: DataFrame, table: DataFrame, notices: DataFrame, key: str = "release_id") -> DataFrame:
    """key, program, t_max, primary_kind, secondary_kinds (ordered), finding: from structure alone, never from a headline.

    releases: key, program, t_max, released_at, content_hash, on_calendar; observed: as in coverage; notices: program, t_max,
    kind, as matched to a release's newest period. Primary: a program's first release is its seed; one that touches
    nothing and repeats the bytes before it is an unchanged republication; one whose newest period is new, whose
    primary footprint it holds and which the calendar knows is routine or a new vintage; anything else is out of cycle.
    Secondary: a kind whose periods beyond the primary footprint are observed, and announced kinds where the bytes
    changed. finding is `unexplained_mutation` where periods were touched that no kind and no notice accounts for.
    """
    order = Window.partitionBy("program").orderBy("released_at", key)
    rows = releases.withColumns({"_hash": F.lag("content_hash").over(order), "_newest": F.max("t_max").over(order.rowsBetween(Window.unboundedPreceding, -1)), "_n": F.row_number().over(order)})
    known = notices.where(F.col("kind").isin(*SECONDARY)).groupBy("program", "t_max").agg(F.collect_set("kind").alias("_noticed"))
    rows = rows.join(coverage(releases, observed, table, key), key).join(known, ["program", "t_max"], "left")
    changed = ~F.col("content_hash").eqNullSafe(F.col("_hash"))
    enough = lambda part, whole: 100 * part >= CONTAINED * whole
    held = lambda names: F.exists(F.coalesce("kinds", F.array()), lambda k: k["kind"].isin(*names) & (k["hit"] > 0) & enough(k["hit"], k["expected"]))
    fresh = F.coalesce(F.col("t_max") > F.col("_newest"), F.lit(True)) & F.col("on_calendar")
    primary = (
        F.when(F.col("_n") == 1, "seed")
        .when((F.col("n_observed") == 0) & ~changed, "unchanged_republication")
        .when(fresh & held(["routine", "full_data"]), "routine")
        .when(fresh & held(["new_vintage"]), "new_vintage")
        .otherwise("out_of_cycle")
    )
    shown = F.transform(F.filter(F.coalesce("kinds", F.array()), lambda k: ~k["kind"].isin(*PRIMARY) & (k["beyond"] > 0) & enough(k["beyond_hit"], k["beyond"])), lambda k: k["kind"])
    told = F.when(changed, F.coalesce("_noticed", F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumns({"primary_kind": primary, "_shown": shown, "_told": told})
    secondary = F.filter(F.array(*map(F.lit, SECONDARY)), lambda k: F.array_contains("_shown", k) | F.array_contains("_told", k))
    # periods beyond the primary footprint that belong to kinds not found, and those of no footprint at all
    loose = F.aggregate(F.coalesce("kinds", F.array()), F.lit(0).cast("long"), lambda n, k: n + F.when(~k["kind"].isin(*PRIMARY) & ~F.array_contains("_shown", k["kind"]), k["beyond_hit"]).otherwise(0))
    open_ended = F.arrays_overlap("_told", F.array(*(F.lit(k) for _, k, _, reach in ANNOUNCED if reach == "unbounded")))
    finding = F.when((F.col("spare") + loose > 0) & ~open_ended & (F.col("primary_kind") != "seed"), "unexplained_mutation")
    return rows.select(key, "program", "t_max", "primary_kind", secondary.alias("secondary_kinds"), finding.alias("finding"))


def divergence(expected: DataFrame, observed: DataFrame, by: list[str]) -> DataFrame:
    """by columns, ref_date, divergence: periods a footprint holds and a release didn't touch (`missing`), or the reverse.

    expected: by columns, ref_date, lower_bound; observed: by columns, ref_date. A footprint known from below only makes no
    period beyond it unexpected.
    """
    key = [*by, "ref_date"]
    e = expected.groupBy(*key).agg(F.max("lower_bound").alias("_bound"))
    bounds = e.groupBy(*by).agg(F.max("_bound").alias("_bound"))
    both = e.select(*key, F.lit(True).alias("_e")).join(observed.select(*key).distinct().withColumn("_o", F.lit(True)), key, "full_outer")
    both = both.where("_e IS NULL OR _o IS NULL").join(bounds, by, "left").where("_o IS NULL OR NOT coalesce(_bound, false)")
    return both.select(*key, F.when(F.col("_e").isNull(), "unexpected").otherwise("missing").alias("divergence"))


def prints_of(footprints: DataFrame) -> DataFrame:
    """The inverse: how often each period is printed, and first and last by which release. Derived, never stored.

    Annual averages, which share their year's first date, are periods of another kind and left out.
    """
    return footprints.where("kind <> 'annual_average'").select("program", "seasonality", "ref_date", "t_max").distinct().groupBy("program", "seasonality", "ref_date").agg(F.count("*").alias("prints"), F.min("t_max").alias("first_release"), F.max("t_max").alias("last_release"))


def canonical_date(year: Column, code: Column, kind: Column) -> Column:
    """First day of a period: monthly M01-M13, quarterly Q01-Q05, annual A01, occupation vintage, projection vintage."""
    n = F.try_to_number(F.substring(code, 2, 2), F.lit("99")).cast("int")
    month = F.when(code.rlike("^M(0[1-9]|1[0-2])$"), n).when(code.rlike("^Q0[1-4]$"), 3 * n - 2).when(code.isin("M13", "Q05", "A01"), 1).when(kind == "occupation", 5).when(kind == "projection", 1)
    return F.make_date(year, month, F.lit(1))


def period_kind(code: Column, kind: Column) -> Column:
    return F.when(kind.isin("occupation", "projection"), "vintage").when(code.isin("M13", "Q05", "A01"), "annual_average").otherwise("period")
