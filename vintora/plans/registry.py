"""Registry of the engine's queries: each a function of its tables, with the SQL that says the same."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vintora.sources.views import VIEWS, for_duckdb, for_spark

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations")


class Tables:
    """Tables of one folder, and the views over them, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        if name in VIEWS:
            sql = VIEWS[name]
            needed = {n: self(n) for n in (*TABLES, *VIEWS) if n != name and re.search(rf"\b(FROM|JOIN) {n}\b", sql)}
            # DataFrames stand in for the names after FROM and JOIN
            return self.spark.sql(re.sub(r"\b(FROM|JOIN) (\w+)", lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in needed else m[0], for_spark(sql)), **needed)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def with_views(sql: str) -> str:
    """A DuckDB query with the views it names as common table expressions."""
    found: list[str] = []

    def add(text: str) -> None:
        for n in VIEWS:
            if n not in found and re.search(rf"\b{n}\b", text):
                add(VIEWS[n])
                if n not in found:
                    found.append(n)

    add(sql)
    if not found:
        return for_duckdb(sql)
    views = ", ".join(f"{n} AS ({for_duckdb(VIEWS[n])})" for n in found)
    sql = sql.strip()
    recursive = sql.upper().startswith("WITH RECURSIVE")
    if sql.upper().startswith("WITH"):
        return f"WITH {'RECURSIVE ' if recursive else ''}{views}, {for_duckdb(re.sub(r'^WITH (RECURSIVE )?', '', sql, flags=re.I))}"
    return f"WITH {views} {for_duckdb(sql)}"


def query(sql: str | None = None, name: str | None = None):
    """Register a function of Tables, and its DuckDB twin."""

    def add(f: Callable[[Tables], DataFrame]):
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[key] = with_views(sql)
        return f

    return add
