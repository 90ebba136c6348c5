"""Commit, retry, torn commits, compaction and the lease."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vintora.plans.store import Files, Lease, Store


def rows(spark, day, values):
    return spark.createDataFrame([("p", 2024, f"{k:02d}", float(v)) for k, v in enumerate(values)], "program string, ref_year int, area string, value double").withColumn("knowledge_time", F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz"))


def opened(spark, tmp_path):
    lease = Lease(Files(spark, str(tmp_path)), f"{tmp_path}/lease", "w")
    assert lease.acquire()
    return Store(spark, str(tmp_path / "s"), lease=lease)


def test_nothing_is_readable_before_its_commit(spark, tmp_path):
    store = opened(spark, tmp_path)
    assert store.read() is None
    store.write(rows(spark, 1, [1, 2]), "r1")
    assert store.read() is None
    assert store.commit("r1") and not store.commit("r1")
    store.write(rows(spark, 2, [3]), "r2")  # torn: never committed
    got = store.read()
    assert got.count() == 2 and {r.area for r in got.collect()} == {"00", "01"}


def test_a_retry_replaces_its_own_rows(spark, tmp_path):
    store = opened(spark, tmp_path)
    for _ in range(2):
        store.write(rows(spark, 1, [1, 2]), "r1")
    store.commit("r1")
    assert store.read().count() == 2


def test_later_releases_stay_unopened(spark, tmp_path):
    store = opened(spark, tmp_path)
    for day in (1, 5):
        store.write(rows(spark, day, [day]), f"r{day}")
        store.commit(f"r{day}")
    early = store.read("2024-01-03")
    assert [r.value for r in early.collect()] == [1.0]
    assert all("r5" not in f for f in early.inputFiles())


def test_compaction_keeps_the_rows(spark, tmp_path):
    store = opened(spark, tmp_path)
    for day in (1, 5):
        store.write(rows(spark, day, [day, day]), f"r{day}")
        store.commit(f"r{day}")
    before = sorted(map(str, store.read().select("release_event_id", "area", "value").collect()))
    store.compact()
    assert store._generation() == "gen=1" and "gen=0" not in store.files.names(store.root)
    assert sorted(map(str, store.read().select("release_event_id", "area", "value").collect())) == before
    # a crash before the swap: a half-written next generation changes nothing
    rows(spark, 9, [9]).write.parquet(f"{store.root}/gen=2")
    assert store.read().count() == 4
    store.compact()
    assert store.read().count() == 4


def test_no_write_without_the_lease(spark, tmp_path):
    store = opened(spark, tmp_path)
    store.write(rows(spark, 1, [1]), "r1")
    for lease in (None, Lease(store.files, f"{tmp_path}/lease", "other"), Lease(store.files, f"{tmp_path}/none", "w")):
        other = Store(spark, store.root, lease=lease)
        for step in (lambda: other.write(rows(spark, 2, [2]), "r2"), lambda: other.commit("r1"), other.compact):
            with pytest.raises(PermissionError):
                step()
    assert store.commit("r1") and other.read().count() == 1
    expired = Lease(store.files, f"{tmp_path}/old", "w", seconds=0)
    assert expired.acquire() and not expired.held()


def test_instants_are_typed(spark, tmp_path):
    store = opened(spark, tmp_path)
    for day in (1, 5):
        store.write(rows(spark, day, [day]).withColumn("knowledge_time", F.expr(f"TIMESTAMP_NTZ'2024-01-{day:02d} 00:00:00.250'")), f"r{day}")
        store.commit(f"r{day}")
    assert store.read("2024-01-01 00:00:00.2") is None and store.read("2024-01-01 00:00:00.25").count() == 1
    assert store.read(dt.datetime(2024, 1, 5, 0, 0, 1)).count() == 2
    plan = store.read("2024-01-06")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(knowledge_time" in plan


def test_puts_replace_in_one_step_or_not_at_all(spark, tmp_path):
    files = Files(spark, str(tmp_path))
    assert files.put(f"{tmp_path}/a", "1", replace=False) and not files.put(f"{tmp_path}/a", "2", replace=False)
    assert files.read(f"{tmp_path}/a") == "1" and files.put(f"{tmp_path}/a", "3") and files.read(f"{tmp_path}/a") == "3"
    assert [n for n in files.names(str(tmp_path)) if n.endswith(".tmp")] == []
    for k in range(5):
        files.put(f"{tmp_path}/d/{k}", "x")
    page, after = files.list(f"{tmp_path}/d", most=3)
    rest, end = files.list(f"{tmp_path}/d", after, 3)
    assert [*page, *rest] == list("01234") and end is None


def test_lease(spark, tmp_path):
    files = Files(spark, str(tmp_path))
    a, b = (Lease(files, f"{tmp_path}/lease", who, 100) for who in "ab")
    assert a.acquire(now=0) and not b.acquire(now=50)
    assert b.acquire(now=200) and b.reclaimed
    a.release()
    assert files.exists(f"{tmp_path}/lease")
    b.release()
    assert not files.exists(f"{tmp_path}/lease")


def test_reading_prunes_partitions_and_columns(spark, tmp_path):
    store = opened(spark, tmp_path)
    store.write(rows(spark, 1, [1, 2]).unionByName(rows(spark, 1, [3]).withColumn("ref_year", F.lit(2023))), "r1")
    store.commit("r1")
    df = store.read().where("ref_year = 2024").select("value")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ref_year" in plan and "ReadSchema: struct<value:double>" in plan
    assert df.count() == 2
