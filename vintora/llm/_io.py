"""Table access and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir).

    A temporary one only where it is unset and all tasks run on this machine; elsewhere a missing one raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        set_by_code = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_by_code.isDefined():
            found = set_by_code.get()
        elif spark.sparkContext.master.startswith("local"):
            spark.sparkContext.setCheckpointDir(f"/tmp/checkpoints/{uuid.uuid4().hex}")
            found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return found


#: Spark's own deletion of a query's shuffle files once the query is over.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors.

    The write's shuffle files go with its end; the session's setting is put back.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    trim_driver(spark)
    out = spark.read.parquet(path)
    out._stored_at = path
    return out


def trim_driver(spark: SparkSession) -> bool:
    """Have the driver's JVM give native memory back that its C library keeps free (some 200 MB after the pipeline's first stages).

    By the JVM's own diagnostic command (Linux, JDK 17.0.9 and later). False where there is none: nothing changes then.
    """
    jvm = spark._jvm
    call = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)  # no arguments, no signature
    try:
        call[0], call[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        # by the public interface: the class behind it is closed to Py4J
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), call)
    except Py4JError:  # a JVM without the command
        return False
    return True


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_stored_at", None):
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def numbered(rows: DataFrame, order: list[Column], to: str, running: str | None = None) -> DataFrame:
    """rows with their number, from 1 in an order over everything, and the running sum <running>_to of a column.

    Ranges are numbered on their own, stored once, and shifted by what stands before them; no task sees all rows.
    """
    ranged = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    own = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranged = stored(ranged.withColumns({"_n": F.count("*").over(own), "_sum": F.sum(running).over(own) if running else F.lit(0).cast("long")}), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sizes = ranged.groupBy("_part").agg(F.max("_n").alias("_size"), F.max("_sum").alias("_all"))
    shifts = sizes.select("_part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_size", "_all")))
    out = ranged.join(F.broadcast(shifts), "_part").withColumn(to, F.col("_n") + F.col("_size"))
    if running:
        out = out.withColumn(f"{running}_to", F.col("_sum") + F.col("_all"))
    return out.drop("_part", "_n", "_sum", "_size", "_all")


def text_of(column: str = "text"):
    """A text column with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def small_batches(spark: SparkSession, records: int = 1000, most_bytes: int = 4 << 20) -> None:
    """Bound what a Python worker gets at a time: texts may be long.

    Plans run after the call that makes them, so the bounds stay set; a session's own smaller ones are kept.
    """
    for key, most in (("maxRecordsPerBatch", records), ("maxBytesPerBatch", most_bytes)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{key}", None)
        number = int(now) if now and now.lstrip("-").isdigit() else 0
        if not 0 < number <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


#: What workers keep from task to task by name: vocabularies and the pieces remembered with them.
KEPT: list[dict] = []


def trim(kept: bool = False) -> None:
    """Give a Python worker's unused memory back: workers stay, for other tasks, after theirs end.

    What an operator keeps from task to task goes as well, unless `kept`: the tasks after it may be another operator's.
    """
    import ctypes
    import gc

    import pyarrow as pa

    if not kept:
        for held in KEPT:
            held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
