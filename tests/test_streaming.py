"""Streaming twins against the batch operators."""

from pyspark.sql import functions as F

from vintora.operators import capture
from vintora.plans.registry import Tables
from vintora.streaming import capture as live


def source(spark, sf, folder, parts=3):
    log = Tables(spark, sf)("fetch_log").withColumn("requested_at", F.col("requested_at").cast("timestamp"))
    for k in range(parts):
        log.where(F.col("request_id") % parts == k).coalesce(1).write.mode("append").parquet(folder)
    return log


def test_watch_state(spark, sf, tmp_path):
    log = source(spark, sf, f"{tmp_path}/in")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    live.fold_watch_state(stream, f"{tmp_path}/state", f"{tmp_path}/cp").awaitTermination()
    last = live.watch_rows(spark, f"{tmp_path}/state")
    assert sorted(map(str, capture.watch_state(last).collect())) == sorted(map(str, capture.watch_state(log).collect()))


def test_watch_state_rewrites_touched_parts_only(spark, tmp_path):
    log = spark.createDataFrame([(1, "a", "new_bytes", "h1"), (2, "b", "unchanged", None), (3, "a", "unchanged", None)], "request_id long, url string, outcome string, content_hash string").withColumns({"requested_at": F.timestamp_seconds("request_id"), "etag": F.lit(None).cast("string"), "last_modified": F.lit(None).cast("string")})
    for k in (1, 2, 3):
        log.where(F.col("request_id") == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/in")
        live.fold_watch_state(stream, f"{tmp_path}/state", f"{tmp_path}/cp").awaitTermination()
    held = spark.read.parquet(f"{tmp_path}/state").groupBy("part").agg(F.sort_array(F.collect_set("batch")).alias("b")).collect()
    assert sorted(r.b for r in held) == [["0", "2"], ["1"]]
    got = {r.url: (r.content_hash, r.validators_at) for r in capture.watch_state(live.watch_rows(spark, f"{tmp_path}/state")).collect()}
    want = {r.url: (r.content_hash, r.validators_at) for r in capture.watch_state(log).collect()}
    assert got == want and live.watch_rows(spark, f"{tmp_path}/none") is None


def test_materializing_twice_adds_nothing(spark, sf, tmp_path):
    log = source(spark, sf, f"{tmp_path}/in")
    read = lambda: spark.readStream.schema(log.schema).parquet(f"{tmp_path}/in")
    for run in ("one", "two"):
        live.materialize_vintages(read().withColumn("run", F.lit(run)), f"{tmp_path}/{run}", f"{tmp_path}/cp-{run}").awaitTermination()
    held = lambda: spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/one")
    n = held().count()
    assert n == capture.file_vintages(log).select("file_vintage_id").distinct().count()
    # the same records again, into the same table
    stream = read()
    live.materialize_vintages(stream, f"{tmp_path}/one", f"{tmp_path}/cp-again").awaitTermination()
    assert held().count() == n


def run(stream, name, mode):
    stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.table(name)


def test_counts_and_incidents(spark, sf, tmp_path):
    log = source(spark, sf, f"{tmp_path}/in")
    stream = lambda: live.records(spark, f"{tmp_path}/in", log.schema)
    counts = run(live.outcome_counts(stream()), "counts", "complete")
    assert counts.agg(F.sum("n")).first()[0] == log.count()
    once = run(live.without_retries(stream().unionByName(stream()), ["request_id"], within="60 days"), "once", "append")
    assert once.count() == log.count()
    sessions = run(live.incidents(stream(), "url"), "sessions", "complete")
    assert sessions.agg(F.sum("n")).first()[0] == log.where("outcome IN ('error', 'blocked')").count()
