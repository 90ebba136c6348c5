"""Tables written between two steps of a job, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where it is unset and all tasks run on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    set_by_code = context._jsc.sc().getCheckpointDir()
    if set_by_code.isDefined():
        return set_by_code.get()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(f"/tmp/checkpoints/{uuid.uuid4().hex}")
    return context._jsc.sc().getCheckpointDir().get()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df and read it back: what follows sees one fixed result, also when executors are lost."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
