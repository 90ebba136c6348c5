"""The data half of capture: what a log of requests says about artifacts."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintora.plans.scratch import stored

#: Outcomes that observe something about an artifact.
STATE_BEARING = ("unchanged", "restamp_only", "new_bytes")


def watch_state(log: DataFrame) -> DataFrame:
    """Per url: validators of the newest state-bearing record (nulls included), content hash of the newest new bytes.

    Ties in time go to the larger request id, in one pass of partial aggregates.
    """
    newest = lambda fields, when: F.max(F.when(when, F.struct("requested_at", "request_id", *fields)))
    bearing = F.col("outcome").isin(*STATE_BEARING)
    held = (F.col("outcome") == "new_bytes") & F.col("content_hash").isNotNull()
    state = log.where(bearing).groupBy("url").agg(newest(("etag", "last_modified"), bearing).alias("v"), newest(("content_hash",), held).alias("c"))
    return state.select("url", F.col("v.etag").alias("etag"), F.col("v.last_modified").alias("last_modified"), F.col("v.requested_at").alias("validators_at"), F.col("c.content_hash").alias("content_hash"), F.col("c.requested_at").alias("content_at"))


def decide_fetch(known: Column, status: Column, etag: Column, prior_etag: Column, modified: Column, prior_modified: Column) -> Column:
    """Whether a probe asks for a fetch: unchanged must be proven by a validator that both sides have."""
    differs = ((etag != prior_etag) | F.lit(False)), ((modified != prior_modified) | F.lit(False))
    differs = [F.coalesce(d, F.lit(False)) for d in differs]
    comparable = (etag.isNotNull() & prior_etag.isNotNull()) | (modified.isNotNull() & prior_modified.isNotNull())
    return F.when(~known, True).when(~status.eqNullSafe(F.lit(200)), False).when(differs[0] | differs[1], True).otherwise(~comparable)


def classify_bytes(prior_hash: Column, new_hash: Column) -> Column:
    return F.when(prior_hash.isNull() | (prior_hash != new_hash), "new_bytes").otherwise("restamp_only")


def outcome_of(status: Column, error: Column) -> Column:
    return F.when(status == 403, "blocked").when(status.isNull() | (status >= 400) | error.isNotNull(), "error").otherwise("unchanged")


def in_sequence(rows: DataFrame, order: Sequence[str], to: str = "sequence", parts: int | None = None) -> DataFrame:
    """rows with their number, from 1 in the order of some columns over everything.

    Ranges are numbered on their own and stored once; what follows, the sizes of ranges and the shifts, is read from
    there, so that both sides of the join speak of the same ranges whatever columns are asked for. No task sees all rows.
    """
    ranged = (rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)).withColumn("_part", F.spark_partition_id())
    ranged = stored(ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order))), "ranges")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size"))  # a row for each range
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    return ranged.join(F.broadcast(before), "_part").withColumn(to, (F.col("_n") + F.col("_before")).cast("long")).drop("_part", "_n", "_before")


def numbered(log: DataFrame, parts: int | None = None) -> DataFrame:
    """log with `sequence`, from 1 in (requested_at, request_id) order over everything."""
    return in_sequence(log, ("requested_at", "request_id"), parts=parts)


def file_vintages(log: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row for each content change: new bytes without a vintage yet; first_observed_at is the log's own time."""
    new = log.where("outcome = 'new_bytes'")
    identity = F.sha2(F.concat_ws("|", "url", F.coalesce("content_hash", F.lit("~")), F.col("requested_at").cast("string")), 256)
    rows = new.withColumn("file_vintage_id", identity)
    return rows if known is None else rows.join(known.select("file_vintage_id"), "file_vintage_id", "left_anti")


def summary(log: DataFrame, by: str) -> DataFrame:
    count = lambda c, name: F.count(F.when(c, 1)).alias(name)
    kinds = ("unchanged", "restamp_only", "new_bytes", "error", "blocked")
    failed = (F.col("profile") == "html") & F.col("outcome").isin("error", "blocked")
    return log.groupBy(by).agg(F.count("*").alias("checked"), *(count(F.col("outcome") == k, k) for k in kinds), count(failed, "html_failures")).withColumn("degraded", F.col("html_failures") > 0)


def poll_interval(elapsed_seconds: Column, left_in_day: Column, grace_days: int = 3) -> Column:
    """Seconds between polls by time since the scheduled instant; null before the ladder starts, 0 once late."""
    return F.when(elapsed_seconds < -300, None).when(elapsed_seconds <= 1800, 60).when(elapsed_seconds <= 14400, 300).when(left_in_day >= 0, 1800).when(elapsed_seconds <= grace_days * 86400, 21600).otherwise(0)


def two_level_key(digest: Column) -> Column:
    """Storage key of a blob, fanned out on the first digits of its hash."""
    return F.concat(F.lit("raw/blob/sha256="), F.substring(digest, 1, 2), F.lit("/"), F.substring(digest, 3, 2), F.lit("/"), digest)


def decoded(body: Column, encoding: Column) -> Column:
    """Bytes of a response without their content encoding; null for those that need `inflate`. Unknown ones raise."""
    name = F.lower(F.trim(F.coalesce(encoding, F.lit(""))))
    refused = F.raise_error(F.concat(F.lit("unsupported Content-Encoding: "), encoding)).cast("binary")
    return F.when(name.isin("", "identity"), body).when(name.isin("gzip", "deflate"), F.lit(None).cast("binary")).otherwise(refused)


def with_hashes(responses: DataFrame, body: str = "body", encoding: str = "content_encoding") -> DataFrame:
    """responses with wire_sha256, of the bytes as sent, content_sha256 and byte_size, of the decoded bytes.

    Compressed bodies are inflated in Arrow batches, which no built-in function does; all others stay in the JVM. A body
    that its encoding can't decode fails the job, and so does an unknown encoding: its hash would be one of compressed
    bytes.
    """
    @F.arrow_udf("binary")
    def inflate(bodies: pa.Array, names: pa.Array) -> pa.Array:
        def one(data, name):
            if data is None:
                return None
            coder = zlib.decompressobj(16 + zlib.MAX_WBITS if name.strip().lower() == "gzip" else zlib.MAX_WBITS)
            out = coder.decompress(data) + coder.flush()
            if not coder.eof:
                raise ValueError("compressed body ends early")
            return out

        return pa.array([one(d, n) for d, n in zip(bodies.to_pylist(), names.to_pylist())], pa.binary())

    packed = F.lower(F.trim(F.coalesce(F.col(encoding), F.lit("")))).isin("gzip", "deflate")
    rows = responses.withColumn("_sent", F.when(packed, F.col(body))).withColumn("_name", F.when(packed, F.col(encoding)))
    rows = rows.withColumn("_content", F.coalesce(inflate("_sent", "_name"), decoded(F.col(body), F.col(encoding))))
    return rows.withColumns({"wire_sha256": F.sha2(body, 256), "content_sha256": F.sha2("_content", 256), "byte_size": F.octet_length("_content").cast("long")}).drop("_sent", "_name", "_content")


def run_id(started: Column, unique: Column) -> Column:
    """Name of a run: its time first, so that names sort by time, then what tells runs of one second apart."""
    return F.concat(F.date_format(started, "yyyyMMdd'T'HHmmss'Z'"), F.lit("-"), F.substring(F.sha2(unique.cast("string"), 256), 1, 8))


def append_records(records: DataFrame, folder: str, run: str, at: str = "requested_at") -> None:
    """Append log records as JSON lines under dt=<day>; keys begin with the run's name and never repeat.

    Nothing is appended in place: every task writes files of its own, so runs and lost executors don't meet.
    """
    day = F.date_format(at, "yyyy-MM-dd").alias("dt")
    records.select("*", day, F.lit(run).alias("run")).write.mode("append").partitionBy("dt", "run").json(folder)


def read_records(spark, folder: str, schema: str) -> DataFrame:
    """The appended records with dt and run; sorting by them is sorting by time of the run."""
    return spark.read.schema(f"{schema}, dt string, run string").json(folder)
