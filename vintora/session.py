"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # codes such as "01" in directory names must stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configured(builder: SparkSession.Builder) -> SparkSession:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
