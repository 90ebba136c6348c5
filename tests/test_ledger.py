"""Rebuild, attestation, validation policy, matching and periods."""

import datetime as dt
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintora.operators import capture, diff, ledger, matching, periods, validate
from vintora.plans.registry import Tables
from vintora.queries import QUERIES


def test_rebuild_gives_the_same_rows(spark, sf):
    log = Tables(spark, sf)("fetch_log").withColumn("program", F.lit("p"))

    def parse(v):
        return v.select("file_vintage_id", "program", "url", F.lit("2024-01-01").cast("date").alias("ref_date"), F.lit("M01").alias("period_code"), F.col("artifact").cast("double").alias("value"), (F.col("request_id") % 7).cast("double").alias("more")).withColumnRenamed("url", "unit_key").where("more > 0")

    keep = lambda events: events.where(F.col("vintage") % 3 != 1)
    first, again = (ledger.rebuild(df, parse, ["value", "more"], keep, scope=F.lit(True)) for df in (log, log.repartition(7)))
    for name in first:
        assert sorted(map(str, first[name].collect())) == sorted(map(str, again[name].select(first[name].columns).collect())), name
    assert 0 < first["visible"].count() < first["observation"].count()
    kinds = {r[0] for r in first["observation"].select("change_kind").distinct().collect()}
    assert {"first_print", "revised", "deleted"} <= kinds


def test_change_log_equals_repeated_diffs(spark):
    """Over random vintages: each is compared with the state before it, deletions in scope and reinstatements included."""
    import random

    rnd, vintages = random.Random(7), 6
    rows = [(k, k % 3, v, rnd.choice([None, 1.0, 1.2, 2.0]), rnd.choice(["a", "b"])) for k in range(60) for v in range(1, vintages + 1) if rnd.random() < 0.6]
    df = spark.createDataFrame(rows, "k int, y int, v int, m double, f string")
    scope, precision = F.col("y") != 1, (F.col("k") < 30, 0)
    got = diff.change_log(df, ["k", "y"], "v", ["m"], F.lit(vintages), scope=scope, footnote="f", precision=precision)
    state, gone, want = {}, set(), []
    held = {}
    for r in rows:
        held.setdefault(r[2], {})[r[0]] = r
    for v in range(1, vintages + 1):
        prev = spark.createDataFrame([s for s in state.values()], df.schema) if state else df.limit(0)
        now = spark.createDataFrame(list(held[v].values()), df.schema)
        for r in diff.wide_diff(prev, now, ["k", "y"], ["m"], scope=scope, footnote="f", precision=precision).collect():
            kind = "reinstated" if r.change_kind == "first_print" and r.k in gone else r.change_kind
            want.append((r.k, v, r.value, r.prev_value, kind))
            if kind == "deleted":
                gone.add(r.k)
                del state[r.k]
        state |= held[v]
    found = [(r.k, r.vintage, r.value, r.prev_value, r.change_kind) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert len({r[4] for r in found}) == 8
    assert diff.change_log(df, ["k", "y"], "v", ["m"], F.lit(vintages)).where("change_kind IN ('deleted', 'reinstated')").count() == 0


def test_the_vintage_log_is_one_exchange(spark, sf):
    plan = QUERIES["vintage_log"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    kinds = {r[0] for r in QUERIES["vintage_kinds"](spark, sf).select("change_kind").distinct().collect()}
    assert kinds == {"first_print", "revised", "deleted", "reinstated", "suppressed", "unsuppressed", "footnote_only", "precision_only"}


def test_batch_root(spark):
    def root(hs):
        while len(hs) > 1:
            hs = [hashlib.sha256((hs[k] + hs[k + 1]).encode()).hexdigest() if k + 1 < len(hs) else hs[k] for k in range(0, len(hs), 2)]
        return hs[0] if hs else None

    for n in (0, 1, 5):
        hs = [hashlib.sha256(str(k).encode()).hexdigest() for k in range(n)]
        df = spark.createDataFrame(list(enumerate(hs)), "o int, h string")
        assert ledger.batch_root(df, "o", "h") == root(hs)


def test_policy_covers_flags_only(spark):
    found = spark.createDataFrame([("p", "a", "flag"), ("p", "b", "assert"), ("q", "a", "flag")], "program string, rule string, severity string")
    policy = spark.createDataFrame([("p", "a"), ("p", "b")], "program string, rule string")
    assert sorted((r.program, r.rule) for r in validate.suppressed(found, policy).collect()) == [("p", "b"), ("q", "a")]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(st.integers(0, 60), min_size=1, max_size=8), right=st.lists(st.integers(0, 60), min_size=1, max_size=8), days=st.integers(0, 15))
def test_nearest_within(spark, left, right, days):
    day = lambda k: dt.date(1969, 12, 1) + dt.timedelta(days=k)
    a = spark.createDataFrame([(1, n, day(k)) for n, k in enumerate(left)], "p int, i int, a date")
    b = spark.createDataFrame([(1, n, day(k)) for n, k in enumerate(right)], "p int, j int, b date")
    got = {r.i: (r.j, r.distance) for r in matching.nearest_within(a, b, ["p"], "a", "b", "j", days).collect()}
    near = {i: min(((abs(y - x), j, y - x) for j, y in enumerate(right) if abs(x - y) <= days), default=None) for i, x in enumerate(left)}
    assert got == {i: (n[1], n[2]) if n else (None, None) for i, n in near.items()}


def test_nearest_match_builds_no_pairs(spark):
    """Rows of every join stay within the left rows and the days, however many rows share a day; nulls match nothing."""
    n = 20_000
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 40).cast("int"))
    left = spark.range(n).select((F.col("id") % 2).alias("p"), F.col("id").alias("i"), day.alias("a"))
    left = left.unionByName(spark.createDataFrame([(None, -1, dt.date(2020, 1, 1)), (1, -2, None)], "p long, i long, a date"))
    right = left.select("p", F.col("i").alias("j"), F.date_add("a", 3).alias("b"))
    found = matching.nearest_within(left, right, ["p"], "a", "b", "j", 10)
    rows = {r.i: (r.j, r.distance) for r in found.collect()}
    assert len(rows) == n + 2
    assert rows[-1] == rows[-2] == (None, None) and sum(j is not None for j, _ in rows.values()) == n
    days = matching._days(left, right, ["p"], "a", "b", F.min("j"))
    assert days.count() <= 2 * (40 + 43) + 2
    joins = found._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert joins == 1  # days are joined back to rows, nothing else


def test_closure_of_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "source string, target string")
    assert {(r.source, r.target): r.tier for r in matching.closure(edges).collect()}[("a", "a")] == 3


def test_footprints(spark):
    one = lambda p, d: spark.createDataFrame([(p, dt.date.fromisoformat(d))], "program string, t_max date")
    spans = lambda p, d, kind, season: sorted(str(r.ref_date) for r in periods.footprint(one(p, d), periods.rules(spark)).where((F.col("kind") == kind) & (F.col("seasonality") == season)).collect())
    nsa, sa = spans("ces-n", "2026-01-01", "benchmark", "nsa"), spans("ces-n", "2026-01-01", "benchmark", "sa")
    assert (len(nsa), nsa[0], nsa[-1]) == (21, "2024-04-01", "2025-12-01") and (len(sa), sa[0]) == (60, "2021-01-01")
    assert spans("ces-n", "2026-01-01", "routine", "nsa") == ["2025-11-01", "2025-12-01", "2026-01-01"]
    assert spans("ces-n", "2026-02-01", "benchmark", "sa") == []
    assert [len(spans("qcew", f"2025-{m:02d}-01", "full_data", "nsa")) for m in (1, 4, 7, 10)] == [5, 2, 3, 4]
    assert len(spans("cps-ln", "2025-12-01", "annual_revision", "sa")) == 59 and spans("cps-ln", "2025-12-01", "annual_revision", "nsa") == []


def test_numbering_loses_no_row(spark):
    """More columns than the order's, many partitions, adaptive plans: every row once, in order."""
    n = 1_500_000
    at = F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("request_id") * 7919) % 400_000).cast("timestamp_ntz")
    log = spark.range(n, numPartitions=12).select(F.col("id").alias("request_id"), F.sha2(F.col("id").cast("string"), 256).alias("url"), (F.col("id") % 97).alias("artifact")).withColumn("requested_at", at)
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        rows = capture.numbered(log)
        assert rows.agg(F.count("*"), F.count_distinct("sequence"), F.min("sequence"), F.max("sequence")).first()[:] == (n, n, 1, n)
        places = log.select("request_id", F.unix_micros(F.col("requested_at").cast("timestamp")).alias("us"))
        steps = rows.select("sequence", "request_id", F.lead("request_id").over(Window.partitionBy(F.floor(F.col("sequence") / 100_000)).orderBy("sequence")).alias("next"))
        known = steps.join(places, "request_id").join(places.select(F.col("request_id").alias("next"), F.col("us").alias("next_us")), "next")
        assert known.where("us > next_us OR us = next_us AND request_id > next").count() == 0
        assert rows.where(F.sha2(F.col("request_id").cast("string"), 256) != F.col("url")).count() == 0
        assert rows.where("artifact = 5 AND url > '8'").count() == log.where("artifact = 5 AND url > '8'").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_batch_root_over_many_partitions(spark):
    hs = [hashlib.sha256(str(k).encode()).hexdigest() for k in range(3001)]
    df = spark.createDataFrame(list(enumerate(hs)), "o int, h string").repartition(9)
    while len(hs) > 1:
        hs = [hashlib.sha256((hs[k] + hs[k + 1]).encode()).hexdigest() if k + 1 < len(hs) else hs[k] for k in range(0, len(hs), 2)]
    assert ledger.batch_root(df, "o", "h") == hs[0]


def test_encodings(spark):
    import gzip
    import zlib

    body = b"some bytes " * 50
    sent = [(0, body, None), (1, body, "identity"), (2, gzip.compress(body), "gzip"), (3, zlib.compress(body), " Deflate "), (4, None, "gzip")]
    got = {r.k: r for r in capture.with_hashes(spark.createDataFrame([(k, bytearray(b) if b else None, e) for k, b, e in sent], "k int, body binary, content_encoding string")).collect()}
    for k, b, _ in sent[:4]:
        assert (got[k].wire_sha256, got[k].content_sha256, got[k].byte_size) == (hashlib.sha256(b).hexdigest(), hashlib.sha256(body).hexdigest(), len(body))
    assert got[4].content_sha256 is None
    for bad in ((body, "br"), (gzip.compress(body)[:-9], "gzip")):
        with pytest.raises(Exception, match="unsupported Content-Encoding|ends early"):
            capture.with_hashes(spark.createDataFrame([(bytearray(bad[0]), bad[1])], "body binary, content_encoding string")).collect()


def test_records_are_appended_by_run(spark, tmp_path):
    rows = lambda day: spark.createDataFrame([(k, dt.datetime(2024, 1, day, k)) for k in range(3)], "request_id long, requested_at timestamp_ntz")
    started = lambda day: spark.range(1).select(capture.run_id(F.lit(dt.datetime(2024, 1, day)).cast("timestamp_ntz"), F.lit("x"))).first()[0]
    for day in (9, 10, 10):
        capture.append_records(rows(day), f"{tmp_path}/log", started(day))
    got = capture.read_records(spark, f"{tmp_path}/log", "request_id long, requested_at timestamp_ntz")
    assert got.count() == 9 and [r.run[:9] for r in got.select("run").distinct().orderBy("run").collect()] == ["20240109T", "20240110T"]


def test_reconstructed_rows_take_their_release_date(spark):
    rows = spark.createDataFrame([("qcew", "q1", 1, 5.0), ("qcew", "q1", 2, 6.0), ("qcew", "q2", 1, 7.0)], "program string, ref_date string, print int, value double")
    dates = spark.createDataFrame([("qcew", "q1", 1, dt.datetime(2017, 6, 1), "a"), ("qcew", "q1", 2, dt.datetime(2017, 9, 1), "b"), ("qcew", "q2", 1, None, "c")], "program string, ref_date string, print int, released_at timestamp_ntz, release_event_id string")
    got = sorted((r.value, r.knowledge_time, r.provenance) for r in ledger.reconstructed(rows, dates).collect())
    assert got == [(5.0, dt.datetime(2017, 6, 1), "reconstructed"), (6.0, dt.datetime(2017, 9, 1), "reconstructed")]


def test_numbering_is_by_time_over_all_ranges(spark):
    rows = spark.createDataFrame([(k, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=(k * 7919) % 500)) for k in range(300)], "request_id long, requested_at timestamp_ntz")
    got = [r.request_id for r in capture.numbered(rows, 5).orderBy("sequence").collect()]
    assert got == [r.request_id for r in rows.orderBy("requested_at", "request_id").collect()]
    assert sorted(r.sequence for r in capture.numbered(rows, 5).collect()) == list(range(1, 301))


def test_releases_are_classified_by_what_they_touched(spark):
    """A benchmark shows by its periods, a correction by a notice and new bytes; history without either is a finding."""
    d = dt.date
    releases = spark.createDataFrame([
        ("seed", "ces-n", d(2023, 12, 1), d(2024, 1, 5), "a", True),
        ("bench", "ces-n", d(2024, 1, 1), d(2024, 2, 5), "b", True),
        ("same", "ces-n", d(2024, 1, 1), d(2024, 2, 6), "b", False),
        ("plain", "ces-n", d(2024, 2, 1), d(2024, 3, 5), "c", True),
        ("fix", "ces-n", d(2024, 2, 1), d(2024, 3, 9), "d", False),
        ("odd", "ces-n", d(2024, 2, 1), d(2024, 3, 20), "e", True),
        ("late", "ces-n", d(2024, 3, 1), d(2024, 4, 5), "f", False),
        ("none", None, None, None, None, None),
    ], "release_id string, program string, t_max date, released_at date, content_hash string, on_calendar boolean")
    table = periods.rules(spark)
    foot = periods.footprint(releases.select("release_id", "program", "t_max"), table)
    seen = foot.where("release_id = 'bench' OR (release_id IN ('seed', 'plain', 'late') AND kind = 'routine')").select("release_id", "seasonality", "ref_date")
    old = spark.createDataFrame([("fix", "nsa", d(2011, 1, 1)), ("odd", "nsa", d(2011, 1, 1))], "release_id string, seasonality string, ref_date date")
    notices = spark.createDataFrame([("ces-n", d(2024, 2, 1), "correction"), ("ces-n", d(2024, 1, 1), "rumour")], "program string, t_max date, kind string")
    said = notices.where("kind = 'rumour'").unionByName(notices.where("kind = 'correction'"))
    got = {r.release_id: (r.primary_kind, r.secondary_kinds, r.finding) for r in periods.classified(releases, seen.unionByName(old).union(old), table, said).collect()}
    assert got["seed"] == ("seed", [], None)
    assert got["bench"] == ("routine", ["benchmark"], None)
    assert got["same"] == ("unchanged_republication", [], None)
    assert got["plain"] == ("routine", ["correction"], None)  # the notice speaks of its newest period, and its bytes are new
    assert got["fix"] == got["odd"] == ("out_of_cycle", ["correction"], None)
    assert got["late"][0] == "out_of_cycle" and len(got) == 8
    bare = {r.release_id: r for r in periods.classified(releases, seen.unionByName(old), table, notices.limit(0)).collect()}
    assert (bare["odd"].secondary_kinds, bare["odd"].finding) == ([], "unexplained_mutation")


def test_every_primary_kind_occurs(spark, sf):
    rows = QUERIES["classified_releases"](spark, sf).collect()
    assert {r.primary_kind for r in rows} == {"seed", "routine", "new_vintage", "unchanged_republication", "out_of_cycle"}
    assert {k for r in rows for k in r.secondary_kinds.split(",") if k} >= {"benchmark", "annual_revision", "sa_revision", "correction", "reweight", "population_control"}
    assert {r.finding for r in rows} == {None, "unexplained_mutation"}
