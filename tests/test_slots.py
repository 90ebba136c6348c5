"""Slots over time: the stream with timers against the batch operator."""

import datetime as dt
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from vintora.operators import slots
from vintora.plans.registry import Tables
from vintora.queries import ORACLES, QUERIES
from vintora.queries.control import slot_events
from vintora.streaming import slots as live

STORE = "spark.sql.streaming.stateStore.providerClass"
SCHEMA = "slot_id long, at timestamp, seq int, kind string, due timestamp"


@pytest.fixture()
def rocks(spark):
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.set(STORE, before)


def run(spark, folder, name, late="0 seconds"):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    live.slot_life(stream, late).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{folder}-cp").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


def write(spark, rows, folder, bounds):
    """One file for each span of time, written in order."""
    for a, b in zip([None, *bounds], [*bounds, None]):
        part = rows.where(F.lit(True) if a is None else F.col("at") > a).where(F.lit(True) if b is None else F.col("at") <= b)
        part.coalesce(1).write.mode("append").parquet(folder)


def test_stream_ends_in_the_states_of_the_batch(rocks, sf, tmp_path):
    events = slot_events(Tables(rocks, sf)).where("slot_id <= 300").withColumns({c: F.col(c).cast("timestamp") for c in ("at", "due")})
    now = dt.datetime(1998, 6, 15)
    tick = rocks.createDataFrame([(0, now, 0, "tick", None)], SCHEMA)  # of no slot that has events: time passes
    write(rocks, events.where(F.col("at") < F.lit(now)).unionByName(tick), f"{tmp_path}/in", [dt.datetime(1994, 7, 1), dt.datetime(1997, 1, 1)])
    out = run(rocks, f"{tmp_path}/in", "slot_changes")
    got = {r.slot_id: (r.state, r.due) for r in out.groupBy("slot_id").agg(F.max_by(F.struct("state", "due"), "step").alias("e")).select("slot_id", "e.*").collect()}
    want = {r.slot_id: (r.state, r.due) for r in slots.life(events, F.lit(now).cast("timestamp")).collect()}
    assert got == want and {s for s, _ in want.values()} >= {"late", "captured", "committed", "delayed", "cancelled"}


def test_time_alone_makes_a_slot_late(rocks, tmp_path):
    day = lambda n, h=0: dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=h)
    rows = [(1, day(0), 0, "scheduled", day(5, 10)), (2, day(0), 0, "cancelled", None), (9, day(6), 0, "tick", None), (9, day(20), 0, "tick", None), (1, day(21), 0, "scheduled", day(30)), (9, day(22), 0, "tick", None)]
    write(rocks, rocks.createDataFrame(rows, SCHEMA), f"{tmp_path}/in", [day(1), day(10), day(20)])
    changes = [(r.slot_id, r.state, r.at, r.poll_seconds) for r in run(rocks, f"{tmp_path}/in", "slot_lateness").orderBy("slot_id", "step").collect()]
    minutes = dt.timedelta(minutes=1)
    assert changes == [
        (1, "scheduled", day(0), None),
        (1, "watching", day(5, 10) - 5 * minutes, 60),
        (1, "watching", day(5, 10) + 30 * minutes, 300),
        (1, "watching", day(5, 14), 1800),
        (1, "watching", day(6), 21600),
        (1, "late", day(8, 10), 0),  # no event of its own, and nothing cancels it
        (1, "scheduled", day(21), None),  # its day moved ahead
    ]


def test_rungs_close_to_midnight():
    due = 23 * 3_600_000
    assert [(a - due, p) for a, _, p in live.steps(due)] == [(-300_000, 60), (1_800_000, 300), (14_400_000, 21_600), (259_200_000, 0)]


def test_odd_events(spark):
    at = lambda n: dt.datetime(2024, 1, n)
    rows = [(1, at(1), 0, "scheduled", None), (2, at(1), 0, "captured", None), (2, at(2), 0, "scheduled", at(9)), (3, at(1), 0, "scheduled", at(2)), (3, at(3), 0, "cancelled", None), (None, at(1), 0, "captured", None), (4, at(1), 0, "scheduled", at(2)), (4, at(6), 0, "cancelled", None), (4, at(7), 0, "captured", None), (5, at(20), 0, "captured", None), (6, None, 0, "captured", None), (7, at(9), 0, "scheduled", at(20)), (7, at(9), 0, "scheduled", at(20))]
    got = {r.slot_id: r.state for r in slots.life(spark.createDataFrame(rows, SCHEMA), F.lit(at(10)).cast("timestamp")).collect()}
    assert got == {2: "captured", 3: "late", 4: "cancelled", 7: "scheduled"}
    assert slots.life(spark.createDataFrame([], SCHEMA), F.current_timestamp()).count() == 0


#: Events of one instant and seq: (kind, due), and the state and due they leave.
TIES = [
    (("cancelled", None), ("captured", None), "captured", 2),
    (("delayed", None), ("captured", None), "captured", 2),
    (("delayed", None), ("cancelled", None), "cancelled", 2),
    (("news_only", None), ("committed", None), "committed", 2),
    (("scheduled", 20), ("scheduled", 25), "scheduled", 25),
    (("scheduled", 20), ("captured", None), "captured", 20),
]


def test_events_of_one_instant_and_seq_in_any_order(rocks, tmp_path):
    at = lambda n: n and dt.datetime(2024, 1, n)
    want = {k: (state, at(due)) for k, (_, _, state, due) in enumerate(TIES)}
    for n, pick in enumerate(permutations((0, 1))):
        rows = [(k, at(1), 0, "scheduled", at(2)) for k in want]
        rows += [(k, at(6), 7, tie[i][0], at(tie[i][1])) for k, tie in enumerate(TIES) for i in pick]
        events = rocks.createDataFrame(rows, SCHEMA).coalesce(1)
        assert {r.slot_id: (r.state, r.due) for r in slots.life(events, F.lit(at(10)).cast("timestamp")).collect()} == want
        write(rocks, events, f"{tmp_path}/{n}", [])
        out = run(rocks, f"{tmp_path}/{n}", f"slot_ties_{n}").groupBy("slot_id").agg(F.max_by(F.struct("state", "due"), "step").alias("e"))
        assert {r.slot_id: (r.e.state, r.e.due) for r in out.collect()} == want


def test_slot_life_is_its_sql_where_ties_are_ordered(spark):
    """The registered SQL leaves events of one slot, instant and seq open; here their order is added to a copy of it."""
    sf = "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    turn = f"list_position({list(slots.TURNS)}, kind)"
    sql = ORACLES["slot_life"].replace("ORDER BY moment, seq", f"ORDER BY moment, seq, {turn}, due").replace("ORDER BY moment DESC, seq DESC", f"ORDER BY moment DESC, seq DESC, {turn} DESC, due DESC")
    assert sql.count(turn) == 4
    want = set(con.execute(sql).fetchall())
    assert len(want) == 140698 and {tuple(r) for r in QUERIES["slot_life"](spark, sf).select("slot_id", "state", "due").collect()} == want
