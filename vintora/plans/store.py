"""The store's layout: addressed writes, a manifest as commit point, generations, pruning, one writer.

A release's rows go to directories named by the release, so writing it again replaces the same directories and
leaves the same rows. Nothing is readable before its manifest entry exists, and nothing is written without the lease.
The rows are plain Spark writes and reads; only small control files pass through the driver, by the cluster's own file
system.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Instants in manifest entries.
INSTANT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


class Files:
    """Small control files in any file system Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.jvm, self.gateway = jvm, spark.sparkContext._gateway
        self.context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(root).toUri(), spark._jsc.hadoopConfiguration()) if self.path(root).toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def read(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self.fs.open(self.path(path))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def put(self, path: str, text: str, replace: bool = True) -> bool:
        """Write under another name, then rename over the target in one step: readers see the old file or the new one.

        False if the target exists and may not be replaced. Any other failure raises.
        """
        target, draft = self.path(path), self.path(f"{path}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(draft, True)
        out.write(text.encode())
        out.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE if replace else rename.NONE
        try:
            self.context.rename(draft, target, how)
        except Py4JJavaError as e:
            self.fs.delete(draft, False)
            if not replace and "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def list(self, path: str, after: str = "", most: int = 1000) -> tuple[list[str], str | None]:
        """A page of the names under a folder, in order, and the name to go on after; None after the last page."""
        found = [n for n in self.names(path) if n > after]
        return found[:most], found[most - 1] if len(found) > most else None

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(path))) if self.exists(path) else []

    def remove(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


class Store:
    """One table of releases under a folder. Reading needs no lease; writing, committing and compacting do."""

    def __init__(self, spark: SparkSession, root: str, partition: Sequence[str] = ("program", "ref_year"), lease: Lease | None = None):
        self.spark, self.root, self.partition, self.files, self.lease = spark, root.rstrip("/"), list(partition), Files(spark, root), lease

    def _generation(self) -> str | None:
        return self.files.read(f"{self.root}/_current")

    def _writing(self) -> None:
        if self.lease is None or not self.lease.held():
            raise PermissionError("the writer's lease isn't held")

    def write(self, rows: DataFrame, release: str) -> None:
        """Rows of a release, not yet readable. A retry replaces them. Large partitions are split over several tasks."""
        self._writing()
        to = f"{self.root}/{self._generation() or 'gen=0'}/release_event_id={release}"
        rows.hint("rebalance", *map(F.col, self.partition)).sortWithinPartitions(*self.partition).write.mode("overwrite").partitionBy(*self.partition).parquet(to)

    def commit(self, release: str, **facts) -> bool:
        """Make a release readable: one small file, with statistics of its rows. False if it was committed already."""
        self._writing()
        generation = self._generation() or "gen=0"
        shown = lambda c: F.date_format(c, INSTANT)
        stats = self._rows([f"{self.root}/{generation}/release_event_id={release}"]).agg(F.count("*").alias("n"), shown(F.min("knowledge_time")).alias("lo"), shown(F.max("knowledge_time")).alias("hi")).first()
        if not self._generation():
            self.files.put(f"{self.root}/_current", generation)
        self._writing()  # the rows may have taken longer than the lease
        return self.files.put(f"{self.root}/_manifest/{release}.json", json.dumps({"release_event_id": release, "n": stats["n"], "lo": stats["lo"], "hi": stats["hi"], **facts}), replace=False)

    def manifest(self) -> DataFrame:
        """release_event_id, n, lo, hi (instants) of each committed release."""
        at = f"{self.root}/_manifest"
        if not any(n.endswith(".json") for n in self.files.names(at)):
            return self.spark.createDataFrame([], "release_event_id string, n long, lo timestamp_ntz, hi timestamp_ntz")
        rows = self.spark.read.schema("release_event_id string, n long, lo string, hi string").option("pathGlobFilter", "*.json").json(at)
        return rows.select("release_event_id", "n", *(F.to_timestamp_ntz(c, F.lit(INSTANT)).alias(c) for c in ("lo", "hi")))

    def _rows(self, paths: list[str]) -> DataFrame:
        return self.spark.read.option("basePath", self.root).parquet(*paths)

    def read(self, known_by: str | dt.datetime | None = None) -> DataFrame | None:
        """Committed rows of the current generation; releases known only later are left unopened. None without any.

        known_by is an instant without zone, as text or datetime; it reaches the scan as a filter on typed instants.
        """
        generation = self._generation()
        at = None if known_by is None else F.lit(known_by).cast("timestamp_ntz")
        kept = self.manifest().where("n > 0")
        names = [r[0] for r in (kept if at is None else kept.where(F.col("lo") <= at)).select("release_event_id").orderBy("release_event_id").collect()]  # few beside their rows
        if generation is None or not names:
            return None
        rows = self._rows([f"{self.root}/{generation}/release_event_id={n}" for n in names])
        return rows if at is None else rows.where(F.col("knowledge_time") <= at)

    def compact(self) -> None:
        """Write the committed rows as the next generation, swap the pointer, then drop the old one.

        A crash before the swap leaves the old generation in force, one after it leaves garbage only.
        """
        self._writing()
        old = self._generation()
        if old is None:
            return
        new = f"gen={int(old.split('=')[1]) + 1}"
        self.files.remove(f"{self.root}/{new}")
        rows = self.read()
        if rows is not None:
            rows.drop("gen").hint("rebalance", F.col("release_event_id"), *map(F.col, self.partition)).write.partitionBy("release_event_id", *self.partition).parquet(f"{self.root}/{new}")
        self._writing()
        self.files.put(f"{self.root}/_current", new)
        self.files.remove(f"{self.root}/{old}")


class Lease:
    """One writer at a time. An expired lease can be taken over, which is a finding."""

    def __init__(self, files: Files, path: str, holder: str, seconds: float = 600.0):
        self.files, self.path, self.holder, self.seconds, self.reclaimed = files, path, holder, seconds, False

    def acquire(self, now: float | None = None) -> bool:
        now = time.time() if now is None else now
        entry = json.dumps({"holder": self.holder, "until": now + self.seconds})
        if self.files.put(self.path, entry, replace=False):
            return True
        held = json.loads(self.files.read(self.path) or "{}")
        if held.get("holder") != self.holder and held.get("until", 0) > now:
            return False
        self.reclaimed = held.get("holder") != self.holder  # a finding
        return self.files.put(self.path, entry)

    def held(self, now: float | None = None) -> bool:
        """Whether this holder's lease stands and hasn't expired."""
        entry = json.loads(self.files.read(self.path) or "{}")
        return entry.get("holder") == self.holder and entry.get("until", 0) > (time.time() if now is None else now)

    def release(self) -> None:
        if json.loads(self.files.read(self.path) or "{}").get("holder") == self.holder:
            self.files.remove(self.path)
