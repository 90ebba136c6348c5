"""Readers of release files: flat files, archives, calendars, feeds, errata pages, inventories.

All read with declared schemas; codes stay strings. What isn't splittable (archives, calendars) is read as whole
files in parallel, one file at a time in a task.
"""

from __future__ import annotations

import io
import tomllib
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a log record, and below those of the errata table.
FETCH_LOG = """request_id string, url string, method string, profile string, requested_at timestamp, status_code int, http_last_modified string,
    etag string, content_length long, content_encoding string, request_headers map<string,string>, response_headers map<string,string>,
    wire_sha256 string, content_sha256 string, blob_key string, byte_size long, outcome string, error_class string, duration_ms long, slot_id string"""


def flat_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab-delimited file whose headers and cells are padded. Values that aren't numbers become null by try_cast."""
    given = spark.read.option("sep", "\t").option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path, inferSchema=False)
    given = given.toDF(*(c.strip() for c in given.columns))
    fields = spark.createDataFrame([], schema).schema.fields
    return given.select(*(F.trim(F.col(f.name)).try_cast(f.dataType).alias(f.name) for f in fields))


def fetch_log(spark: SparkSession, path: str) -> DataFrame:
    """Every record of every object of the log; blank lines are skipped."""
    return spark.read.schema(FETCH_LOG).option("recursiveFileLookup", True).json(path)


def zipped_lines(spark: SparkSession, path: str, chunk: int = 1 << 20) -> DataFrame:
    """(file, member, line_no, line) of text members of archives, streamed chunk by chunk.

    An archive can't be split: one task reads one, never more than a chunk of lines at a time beyond its packed
    bytes. Large archives are better unpacked to a staging folder first.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for member in z.namelist():
                        with z.open(member) as f:
                            n = 0
                            while got := f.readlines(chunk):
                                text = [x.decode("utf-8", "replace").rstrip("\r\n") for x in got]
                                yield pa.RecordBatch.from_pydict({"file": [name] * len(text), "member": [member] * len(text), "line_no": list(range(n, n + len(text))), "line": text})
                                n += len(text)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(lines, "file string, member string, line_no long, line string")


def zipped_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of CSV members of archives by a declared schema.

    The header must hold all its columns, and every archive a row: a wrong file under a right name must not pass for an
    empty one.
    """
    lines = zipped_lines(spark, path)
    names = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    heads = lines.where("line_no = 0").select("file", "member", F.transform(F.split("line", ","), lambda c: F.trim(c, F.lit(' "'))).alias("head"))
    lacking = heads.where(~F.forall(F.array(*map(F.lit, names)), lambda c: F.array_contains("head", c)))
    if not lacking.isEmpty():
        raise ValueError(f"columns are missing: {lacking.first()}")
    filled = lines.where("line_no > 0 AND line <> ''")
    empty = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file")).join(filled.select("file").distinct(), "file", "left_anti")
    if not empty.isEmpty():
        raise ValueError(f"no rows in {empty.first()[0]}")
    body = filled.join(F.broadcast(heads), ["file", "member"])  # a header for each member
    cells = F.transform(F.split("line", ',(?=(?:[^"]*"[^"]*")*[^"]*$)'), lambda c: F.trim(c, F.lit(' "')))
    row = F.map_from_arrays("head", "cells")
    kinds = {f.name: f.dataType for f in spark.createDataFrame([], schema).schema.fields}
    return body.withColumn("cells", cells).withColumn("row", row).select(*(F.element_at("row", n).try_cast(kinds[n]).alias(n) for n in names))


def calendar(spark: SparkSession, path: str) -> DataFrame:
    """(uid, title, starts, zone, all_day) of the events of iCalendar files; folded lines are joined.

    starts is local to zone: the one the event names, UTC for times that end in Z, null for floating ones. A date alone is
    an all-day event, at its first instant.
    """
    files = spark.read.text(path, wholetext=True)
    body = F.regexp_replace(F.regexp_replace("value", "\r\n", "\n"), "\n[ \t]", "")
    events = files.select(F.explode(F.regexp_extract_all(body, F.lit("(?s)BEGIN:VEVENT\n(.*?)END:VEVENT"), F.lit(1))).alias("e"))
    one = lambda p: F.regexp_extract("e", p, 1)
    stamp, utc = one(r"(?m)^DTSTART[^:\n]*:(\d{8}(?:T\d{6})?)"), one(r"(?m)^DTSTART[^:\n]*:\d{8}T\d{6}(Z)") == "Z"
    all_day = F.length(stamp) == 8
    starts = F.try_to_timestamp(F.when(all_day, F.concat(stamp, F.lit("T000000"))).otherwise(stamp), F.lit("yyyyMMdd'T'HHmmss")).cast("timestamp_ntz")
    zone = F.when(utc, "UTC").otherwise(F.nullif(one(r"(?m)^DTSTART;TZID=([^:\n]*):"), F.lit("")))
    return events.select(one(r"(?m)^UID:(.*)$").alias("uid"), one(r"(?m)^SUMMARY:(.*)$").alias("title"), starts.alias("starts"), zone.alias("zone"), all_day.alias("all_day"))


def feed(spark: SparkSession, path: str) -> DataFrame:
    """(title, link, published) of Atom or RSS files, told apart by their content, not their name."""
    files = spark.read.text(path, wholetext=True).select(F.col("value").alias("x"))
    items = files.select(F.explode(F.regexp_extract_all("x", F.lit("(?s)<(entry|item)[ >](.*?)</(?:entry|item)>"), F.lit(2))).alias("e"))
    one = lambda p: F.regexp_extract("e", p, 1)
    link = F.coalesce(F.nullif(one('<link[^>]*href="([^"]*)"'), F.lit("")), F.nullif(one("<link>([^<]*)</link>"), F.lit("")))
    return items.select(F.trim(one("(?s)<title[^>]*>(.*?)</title>")).alias("title"), link.alias("link"), F.trim(one("<(?:published|updated|pubDate)>([^<]*)<")).alias("published"))


def errata_page(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the six-column errata table of HTML pages, with a key of identity and a hash of all fields."""
    names = ["date_added", "program", "product_type", "title", "description", "correction_status"]
    files = spark.read.text(path, wholetext=True)
    rows = files.select(F.explode(F.regexp_extract_all("value", F.lit("(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("r"))
    cells = F.transform(F.regexp_extract_all("r", F.lit("(?is)<td[^>]*>(.*?)</td>"), F.lit(1)), lambda c: F.trim(F.regexp_replace(c, "<[^>]+>", "")))
    table = rows.withColumn("c", cells).where(F.size("c") == len(names)).select(*(F.col("c")[k].alias(n) for k, n in enumerate(names)))
    key = lambda *cs: F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c), F.lit("~")) for c in cs)), 256)
    return table.withColumns({"row_key": key("date_added", "program", "title"), "row_hash": key(*names)})


def sheet(spark: SparkSession, path: str, member: str = "xl/worksheets/sheet1.xml") -> DataFrame:
    """(file, row, cells) of one sheet of spreadsheet files; cells are strings in column order, gaps null."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xml.etree import ElementTree

        schema = pa.schema([("file", pa.string()), ("row", pa.int32()), ("cells", pa.list_(pa.string()))])
        ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    shared = []
                    if "xl/sharedStrings.xml" in z.namelist():
                        shared = ["".join(t.text or "" for t in si.iter(f"{ns}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{ns}si")]
                    with z.open(member) as f:
                        for _, row in ElementTree.iterparse(f):
                            if row.tag != f"{ns}row":
                                continue
                            cells: dict[int, str | None] = {}
                            for c in row.iter(f"{ns}c"):
                                at = 0
                                for ch in filter(str.isalpha, c.get("r", "")):
                                    at = at * 26 + ord(ch) - 64
                                v, t = c.find(f"{ns}v"), c.get("t")
                                text = "".join(x.text or "" for x in c.iter(f"{ns}t")) if t == "inlineStr" else v.text if v is not None else None
                                cells[at - 1] = shared[int(text)] if t == "s" and text is not None else text
                            width = max(cells, default=-1) + 1
                            yield pa.RecordBatch.from_pydict({"file": [name], "row": [int(row.get("r", 0))], "cells": [[cells.get(k) for k in range(width)]]}, schema)
                            row.clear()

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(rows, "file string, row int, cells array<string>")


def inventory(spark: SparkSession, text: str) -> DataFrame:
    """The artifact inventory from TOML text; keys and urls must be unique. It is configuration, so it is small."""
    found = tomllib.loads(text).get("artifact", [])
    rows = [(a["key"], list(a["programs"]), a["url"], a.get("profile", "flatfile"), a.get("kind", "data")) for a in found]
    for k, what in ((0, "key"), (2, "url")):
        seen = [r[k] for r in rows]
        if len(set(seen)) < len(seen):
            raise ValueError(f"{what} is not unique: {sorted(x for x in set(seen) if seen.count(x) > 1)}")
    return spark.createDataFrame(rows, "key string, programs array<string>, url string, profile string, kind string")


def api_payload(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """payloads with n_series, n_points and success of API answers: the payload decides, not the status."""
    shape = "struct<Results:struct<series:array<struct<data:array<struct<value:string>>>>>>"
    series = F.coalesce(F.from_json(column, shape)["Results"]["series"], F.array().cast("array<struct<data:array<struct<value:string>>>>"))
    points = F.aggregate(series, F.lit(0), lambda n, s: n + F.coalesce(F.size(s["data"]), F.lit(0)))
    return payloads.withColumns({"n_series": F.size(series), "n_points": points}).withColumn("success", (F.col("n_series") > 0) & (F.col("n_points") > 0))
