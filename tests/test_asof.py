"""As-of reading against an independent model, and the cases that are easy to get wrong."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vintora.operators import asof, diff

SCHEMA = "program string, unit_key string, measure_code string, ref_date date, period_code string, knowledge_time timestamp_ntz, sequence long, release_event_id string, value double, change_kind string, provenance string"
DAY = dt.datetime(2024, 1, 1)


def log(spark, rows):
    return spark.createDataFrame([("p", k, "v", DAY.date(), "M01", DAY + dt.timedelta(days=d), n, rel, float(n), kind, prov) for n, (k, d, rel, kind, prov) in enumerate(rows)], SCHEMA)


def committed(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "release_event_id string")


at = lambda d: F.lit((DAY + dt.timedelta(days=d)).isoformat(sep=" ")).cast("timestamp_ntz")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 5), st.sampled_from(["r1", "r2", "r3"]), st.sampled_from(["revised", "deleted"]), st.sampled_from(["observed", "seed", "external"])), min_size=1, max_size=12), cut=st.integers(0, 6), strict=st.booleans())
def test_equals_the_newest_row(spark, rows, cut, strict):
    got = {r.unit_key: r.sequence for r in asof.as_of(log(spark, rows), committed(spark, "r1", "r2"), at(cut), strict=strict).collect()}
    want = {}
    for n, (k, d, rel, kind, prov) in enumerate(rows):
        if d <= cut and rel != "r3" and (not strict or prov != "external"):
            if k not in want or (d, n) > want[k][:2]:
                want[k] = (d, n, kind)
    assert got == {k: n for k, (d, n, kind) in want.items() if kind != "deleted"}


def test_seed_is_visible_exactly_at_the_first_instant(spark):
    rows, c = log(spark, [("a", 2, "r1", "revised", "seed"), ("b", 2, "r1", "revised", "seed")]), committed(spark, "r1")
    assert asof.as_of(rows, c, at(2), first_instant=at(2)).count() == 2
    assert asof.as_of(rows, c, at(1), first_instant=at(2)).count() == 0


def test_deleted_rows_hide_older_ones(spark):
    rows = log(spark, [("a", 1, "r1", "revised", "observed"), ("a", 2, "r1", "deleted", "observed")])
    assert asof.as_of(rows, committed(spark, "r1"), at(3)).count() == 0


def test_a_defective_vintage_stays_readable_between_two_releases(spark):
    rows = log(spark, [("a", 1, "r1", "revised", "observed"), ("a", 5, "r2", "revised", "observed")])
    c = committed(spark, "r1", "r2")
    assert [asof.as_of(rows, c, at(d)).first().value for d in (3, 6)] == [0.0, 1.0]


def test_a_spine_sees_committed_rows_only(spark):
    rows = log(spark, [("a", 1, "r1", "revised", "observed"), ("a", 2, "r3", "revised", "observed"), ("a", 3, "r1", "revised", "external"), ("b", 1, "r1", "revised", "observed"), ("b", 4, "r2", "deleted", "observed")])
    spine = rows.select(*asof.KEY).distinct().withColumn("at", F.explode(F.array(at(2), at(5))))
    read = lambda **more: {(r.unit_key, r.at.day): r.sequence for r in asof.as_of_spine(rows, committed(spark, "r1", "r2"), spine, **more).collect()}
    assert read() == {("a", 3): 0, ("a", 6): 0, ("b", 3): 3}
    assert read(strict=False, until=at(5)) == {("a", 3): 0, ("a", 6): 2, ("b", 3): 3}


def test_reference_years_prune_folders(spark, tmp_path):
    rows = log(spark, [("a", 1, "r1", "revised", "observed")])
    rows = rows.unionByName(rows.withColumn("ref_date", F.lit("2020-01-01").cast("date")))
    rows.withColumn("ref_year", F.year("ref_date")).write.partitionBy("ref_year").parquet(f"{tmp_path}/log")
    found = asof.as_of(spark.read.parquet(f"{tmp_path}/log"), committed(spark, "r1"), at(3), years=[2024])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ref_year" in plan or "PartitionFilters: [(cast(ref_year" in plan
    assert found.count() == 1


def test_precision_changes_where_a_marker_says_so(spark):
    prev, cur = (spark.createDataFrame([(1, a), (2, b)], "k int, m double") for a, b in ((1.234, 5.678), (1.2, 9.0)))
    kinds = lambda where: {r.k: r.change_kind for r in diff.wide_diff(prev, cur, ["k"], ["m"], precision=(where, 1)).collect()}
    assert kinds(F.lit(True)) == {1: "precision_only", 2: "revised"} and kinds(F.col("k") > 1) == {1: "revised", 2: "revised"}


def test_plan_has_a_partial_top_one(spark, sf):
    from vintora.queries import QUERIES

    plan = QUERIES["asof_strict"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_every_kind_of_change(spark):
    prev = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "a"), (3, None, "a"), (4, 4.0, "a"), (5, 5.0, "a")], "k int, m double, f string")
    cur = spark.createDataFrame([(1, 1.5, "a"), (2, None, "a"), (3, 3.0, "a"), (5, 5.0, "b"), (6, 6.0, "a")], "k int, m double, f string")
    kinds = lambda scope: {r.k: r.change_kind for r in diff.wide_diff(prev, cur, ["k"], ["m"], scope=scope, footnote="f").collect()}
    assert kinds(F.lit(True)) == {1: "revised", 2: "suppressed", 3: "unsuppressed", 4: "deleted", 5: "footnote_only", 6: "first_print"}
    assert 4 not in kinds(None) and 4 not in kinds(F.col("k") > 4)


def test_wide_diff_joins_once(spark, sf):
    from vintora.queries import QUERIES

    plan = QUERIES["wide_diff"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") + plan.count("Join LeftOuter") + plan.count("Join RightOuter") == 1
