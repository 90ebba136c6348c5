"""Streaming twins of the capture operators. The change log itself has no watermark: late data is never dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vintora.operators import capture


def records(spark: SparkSession, path: str, schema, at: str = "requested_at") -> DataFrame:
    """A stream of records from Parquet files; the event time gets a zone, which watermarks need."""
    return spark.readStream.schema(schema).parquet(path).withColumn(at, F.col(at).cast("timestamp"))


#: Parts of the watch state, by a hash of the url.
PARTS = 64


def _has_data(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _drop(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def watch_rows(spark: SparkSession, table: str) -> DataFrame | None:
    """The records that decide the watch state: of each part, the newest batch that wrote it. None before the first."""
    if not _has_data(spark, table):
        return None
    rows = spark.read.parquet(table).withColumns({c: F.col(c).cast("long") for c in ("part", "batch")})
    newest = rows.groupBy("part").agg(F.max("batch").alias("batch"))  # PARTS rows
    return rows.join(F.broadcast(newest), ["part", "batch"])


def fold_watch_state(stream: DataFrame, table: str, checkpoint: str, parts: int = PARTS) -> StreamingQuery:
    """Keep the newest observations of each url in a folder of parts, batch by batch.

    The state is a fold: a batch's records and the rows of the parts they touch go through the same aggregate, so a
    repeated batch changes nothing. Batch n writes the parts it touches anew and reads only batches before n; parts that
    a batch before the last one replaced are dropped.
    """
    columns = ["url", "requested_at", "request_id", "outcome", "etag", "last_modified", "content_hash"]

    def fold(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        part = F.pmod(F.xxhash64("url"), F.lit(parts)).cast("int")
        rows = batch.select(*columns, part.alias("part"))
        touched = [r[0] for r in rows.select("part").distinct().collect()]  # parts at most
        if not touched:
            return
        if _has_data(spark, table):
            held = spark.read.parquet(table).where((F.col("batch").cast("long") < n) & F.col("part").cast("int").isin(touched)).withColumn("part", F.col("part").cast("int"))
            newest = held.groupBy("part").agg(F.max(F.col("batch").cast("long")).alias("_b"))
            rows = rows.unionByName(held.join(F.broadcast(newest), "part").where(F.col("batch").cast("long") == F.col("_b")).select(*columns, "part"))
        # the records that decide the state: the newest state-bearing one and the newest with bytes
        newest = lambda c: F.max(F.when(c, F.struct("requested_at", "request_id", *[k for k in columns if k not in ("url", "requested_at", "request_id")])))
        bearing = F.col("outcome").isin(*capture.STATE_BEARING)
        held_bytes = (F.col("outcome") == "new_bytes") & F.col("content_hash").isNotNull()
        both = rows.where(bearing).groupBy("url", "part").agg(newest(bearing).alias("v"), newest(held_bytes).alias("c"))
        kept = both.select("url", "part", F.inline(F.array_distinct(F.array_compact(F.array("v", "c")))))
        kept.select(*columns, "part", F.lit(n).cast("long").alias("batch")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part", "batch").parquet(table)
        # a retried batch reads the state before it, so the last replaced state of a part stays
        for k in touched:
            names = sorted(int(s.getPath().getName().split("=")[1]) for s in spark._jvm.org.apache.hadoop.fs.Path(f"{table}/part={k}").getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{table}/part={k}")))
            for old in names[:-2]:
                _drop(spark, f"{table}/part={k}/batch={old}")

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def materialize_vintages(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append vintages of new bytes that have no row yet; running over the same records again adds none."""

    def add(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        new = capture.file_vintages(batch).select("file_vintage_id", "url", "content_hash", "requested_at").dropDuplicates(["file_vintage_id"])
        if _has_data(spark, table):
            known = spark.read.schema("file_vintage_id string, _batch long").option("recursiveFileLookup", True).parquet(table).where(F.col("_batch") != n)
            new = new.join(known.select("file_vintage_id"), "file_vintage_id", "left_anti")
        new.withColumn("_batch", F.lit(n).cast("long")).write.mode("overwrite").parquet(f"{table}/batch={n}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def without_retries(stream: DataFrame, key: list[str], at: str = "requested_at", within: str = "1 day") -> DataFrame:
    """A stream without repeated records of one key within a time."""
    return stream.withWatermark(at, within).dropDuplicatesWithinWatermark(key)


def outcome_counts(stream: DataFrame, at: str = "requested_at", window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Requests by day and outcome."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), "outcome").agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "outcome", "n")


def incidents(stream: DataFrame, by: str, at: str = "requested_at", gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Failures that follow one another within a gap, as one incident."""
    failed = stream.where(F.col("outcome").isin("error", "blocked"))
    return failed.withWatermark(at, late).groupBy(by, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n")).select(by, F.col("w.start").alias("begins"), F.col("w.end").alias("ends"), "n")
