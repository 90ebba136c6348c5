"""First instants by program, link intervals, markers by scope, cadence of archive dates, rules and verdicts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from vintora.operators import asof, control, links, markers, validate
from tests.test_asof import at, committed, log

D = dt.date


def test_strict_reading_is_empty_before_a_programs_own_start(spark):
    rows = log(spark, [("a", 1, "r", "revised", "seed"), ("b", 3, "r", "revised", "observed")])
    rows = rows.unionByName(rows.withColumn("program", F.lit("q"))).unionByName(rows.withColumn("program", F.lit("unnamed")))
    starts = spark.createDataFrame([("p", 1), ("q", 3)], "program string, d int").select("program", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + d * INTERVAL 1 DAY").alias("first_instant"))
    read = lambda d: sorted((r.program, r.unit_key) for r in asof.as_of(rows, committed(spark, "r"), at(d), first_instants=starts).collect())
    assert read(0) == []
    assert read(2) == [("p", "a")]
    assert read(3) == [("p", "a"), ("p", "b"), ("q", "a"), ("q", "b")]
    assert sorted(r.program for r in asof.unpinned_seeds(rows, starts).collect()) == ["q", "unnamed"]


def test_intervals_equal_the_captures_however_they_came(spark):
    draw = random.Random(3)
    captures = {v: {(s, draw.randrange(12)) for s in "xy" for _ in range(9)} for v in range(1, 8)}
    rows = lambda vs: spark.createDataFrame([(s, n, v) for v in vs for s, n in captures[v] for _ in (0, 1)], "s string, n int, vintage int")
    whole = links.intervals(rows(captures), ["s"], "n")
    step = links.intervals(rows([1]), ["s"], "n")
    for v in range(2, 8):
        step = spark.createDataFrame(links.advanced(step, rows([v]), ["s"], "n", v).collect(), step.schema)
    found = {tuple(r) for r in whole.collect()}
    assert found == {tuple(r) for r in step.collect()}
    assert {tuple(r) for r in links.advanced(step, rows([7]), ["s"], "n", 7).collect()} == found  # the same capture again
    for v, held in captures.items():
        assert {(s, n) for s, n, first, last in found if first <= v <= last} == held
    for a, b in [(1, 7), (6, 2), (3, 3)]:
        want = {(*m, "added") for m in captures[b] - captures[a]} | {(*m, "removed") for m in captures[a] - captures[b]}
        assert {tuple(r) for r in links.between(whole, ["s"], "n", a, b).collect()} == want


def test_intervals_take_one_exchange(spark):
    rows = spark.range(100).selectExpr("id % 3 AS s", "id % 7 AS n", "CAST(id % 5 AS INT) AS vintage")
    plan = links.intervals(rows, ["s"], "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


MARKER = "marker_id bigint, program string, prefix string, kind string, effective date"


def test_longest_scope_then_newest_marker(spark):
    marks = spark.createDataFrame([(1, "p", "", "reweight", D(2020, 1, 1)), (2, "p", "", "reweight", D(2021, 1, 1)), (3, "p", "", "reweight", D(2021, 1, 1)), (4, "p", "12", "reweight", D(2020, 6, 1)), (5, "q", "", "reweight", D(2019, 1, 1)), (6, "p", "", "other", D(2021, 6, 1)), (7, "p", None, "reweight", D(2020, 1, 1))], MARKER)
    rows = spark.createDataFrame([(0, "p", "99", D(2019, 12, 31)), (1, "p", "99", D(2020, 1, 1)), (2, "p", "99", D(2022, 1, 1)), (3, "p", "123", D(2022, 1, 1)), (4, "p", "123", D(2020, 5, 1)), (5, "p", "1", D(2022, 1, 1)), (6, "p", None, D(2022, 1, 1)), (7, None, "123", D(2022, 1, 1)), (8, "p", "123", None)], "row_id int, program string, unit_key string, ref_date date")
    found = markers.in_force(rows, marks, ["reweight"], "ref_date")
    assert found.columns == [*rows.columns, "marker"]
    assert {r.row_id: r.marker and r.marker.marker_id for r in found.collect()} == {0: None, 1: 1, 2: 3, 3: 4, 4: 1, 5: 3, 6: None, 7: None, 8: None}
    assert [r.marker for r in markers.in_force(rows, marks, ["none such"], "ref_date").collect()] == [None] * 9


def test_resumption_ends_an_expected_loss(spark):
    marks = spark.createDataFrame([(1, "p", "", "suspension", D(2020, 1, 1)), (2, "p", "", "resumption", D(2020, 3, 1))], MARKER)
    rows = spark.createDataFrame([("p", "a", D(2020, m, 1)) for m in (1, 2, 3)], "program string, unit_key string, ref_date date")
    found = markers.in_force(rows, marks, ["suspension", "discontinuation", "resumption"], "ref_date")
    assert [r.e for r in found.select("ref_date", markers.expected_loss(F.col("marker")).alias("e")).orderBy("ref_date").collect()] == [True, True, False]


def test_archive_dates_on_the_cadence(spark):
    periods = spark.createDataFrame([("p", D(2020, m, 1), D(2020, m + 1, 10)) for m in range(1, 7)], "program string, ref_date date, expected date")
    archive = spark.createDataFrame([("p", d) for d in (D(2020, 2, 10), D(2020, 3, 13), D(2020, 3, 13), D(2020, 4, 9), D(2020, 4, 12), D(2020, 5, 25), D(2020, 7, 10))] + [("unknown", D(2020, 2, 10)), ("p", None)], "program string, release_date date")
    found = {(r.program, r.ref_date and r.ref_date.month, r.release_date): (r.finding, r.confidence, r.dates) for r in control.placed_by_cadence(archive, periods, 6).collect()}
    assert found == {
        ("p", 1, D(2020, 2, 10)): ("on_cadence", "exact", 1),
        ("p", 2, D(2020, 3, 13)): ("on_cadence", "exact", 1),
        ("p", 3, D(2020, 4, 9)): ("doubled", "uncertain", 2),
        ("p", 4, None): ("missing", "uncertain", 0),
        ("p", 5, None): ("missing", "uncertain", 0),
        ("p", 6, D(2020, 7, 10)): ("on_cadence", "exact", 1),
        ("p", None, D(2020, 5, 25)): ("off_cadence", "uncertain", 1),
        ("p", None, None): ("off_cadence", "uncertain", 1),
        ("unknown", None, D(2020, 2, 10)): ("off_cadence", "uncertain", 1),
    }


def test_row_rules_share_a_scan_and_assertions_stop_a_commit(spark, tmp_path):
    spark.createDataFrame([("p", "r1", 1.0, 1), ("p", "r1", None, 2), ("p", "r2", -1.0, 3), ("p", "r3", -1.0, 4), ("p", "r4", 1.0, 5), ("q", "r5", None, 6), ("p", "r6", -1.0, 7)], "program string, release_event_id string, value double, k int").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    rules = [("positive", "assert", F.col("value") <= 0), ("given", "flag", F.col("value").isNull()), ("small", "assert", F.col("k") > 100)]
    found = validate.row_findings(rows, rules, ["program", "release_event_id"])
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    overrides = spark.createDataFrame([("r3", "positive", "seen by hand"), ("r6", "positive", "  "), ("r2", "small", "another rule")], "release_event_id string, rule string, reason string")
    verdict = validate.verdicts(found, overrides, spark.createDataFrame([("q", "given"), ("p", "positive")], "program string, rule string"))
    assert {r.release_event_id: r.verdict for r in verdict.collect()} == {"r1": "flag", "r2": "abort", "r3": "override", "r6": "abort"}
    assert sorted(r.k for r in validate.committable(rows, verdict).collect()) == [1, 2, 4, 5, 6]


def test_group_rules_share_an_exchange(spark):
    rows = spark.range(40).selectExpr("CONCAT('r', id % 4) AS release_event_id", "IF(id % 4 = 1, 'deleted', 'revised') AS change_kind", "id")
    found = validate.key_findings(rows, ["release_event_id"], [("all_gone", "assert", F.expr("count_if(change_kind = 'deleted') = count(*)")), ("late", "flag", F.max("id") > 38)])
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {tuple(r) for r in found.collect()} == {("r1", "all_gone", "assert"), ("r3", "late", "flag")}
