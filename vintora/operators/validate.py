"""Validation: a rule is a query that returns the rows breaking it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def report(rules: Iterable[tuple[str, str, DataFrame]]) -> DataFrame:
    """rule, severity, n, verdict: an `assert` rule with findings aborts, a `flag` rule is recorded."""
    one = lambda name, severity, found: found.agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), F.lit(severity).alias("severity"), "n")
    every = reduce(DataFrame.unionByName, (one(*r) for r in rules))
    return every.withColumn("verdict", F.when(F.col("n") == 0, "pass").when(F.col("severity") == "assert", "abort").otherwise("flag"))


def row_findings(rows: DataFrame, rules: Sequence[tuple[str, str, Column]], subject: Sequence[str]) -> DataFrame:
    """subject, rule, severity: one row for each rule that a row breaks, all of them seen in a single scan.

    rules: name, severity and the condition that is true where the rule is broken; null is no finding.
    """
    one = lambda name, severity, broken: F.when(broken, F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity")))
    return rows.select(*subject, F.inline(F.array_compact(F.array(*(one(*r) for r in rules)))))


def key_findings(rows: DataFrame, key: Sequence[str], rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """key, rule, severity of rules over groups: their conditions are aggregates, and share one exchange."""
    grouped = rows.groupBy(*key).agg(*(broken.alias(f"_rule{i}") for i, (_, _, broken) in enumerate(rules)))
    return row_findings(grouped, [(name, severity, F.col(f"_rule{i}")) for i, (name, severity, _) in enumerate(rules)], key)


def verdicts(findings: DataFrame, overrides: DataFrame, policy: DataFrame) -> DataFrame:
    """release_event_id, asserts, overridden, flags, verdict of findings (program, release_event_id, rule, severity).

    An assertion aborts unless overrides names that release and rule with a reason; flags a policy (program, rule)
    expects aren't counted. A release without findings has no row: nothing stops it.
    """
    counted = suppressed(findings.groupBy("program", "release_event_id", "rule", "severity").agg(F.count("*").alias("_n")), policy)
    named = overrides.where("trim(reason) <> ''").select("release_event_id", "rule", F.lit(True).alias("_named")).distinct()
    both = counted.join(named, ["release_event_id", "rule"], "left")
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0))
    is_assert, is_named = F.col("severity") == "assert", F.col("_named").isNotNull()
    found = both.groupBy("release_event_id").agg(total(is_assert & ~is_named).alias("asserts"), total(is_assert & is_named).alias("overridden"), total(~is_assert).alias("flags"))
    return found.withColumn("verdict", F.when(F.col("asserts") > 0, "abort").when(F.col("overridden") > 0, "override").when(F.col("flags") > 0, "flag").otherwise("pass"))


def committable(rows: DataFrame, verdict: DataFrame) -> DataFrame:
    """Rows of releases that no assertion stops: what a commit may write."""
    return rows.join(verdict.where("verdict = 'abort'").select("release_event_id"), "release_event_id", "left_anti")


def suppressed(findings: DataFrame, policy: DataFrame) -> DataFrame:
    """Findings without the flags a policy covers (program, rule); assertions can't be covered."""
    covered = policy.select("program", "rule").withColumn("_covered", F.lit(True))
    kept = findings.join(covered, ["program", "rule"], "left").where("severity = 'assert' OR _covered IS NULL")
    return kept.drop("_covered")


def checksum_findings(blobs: DataFrame, stored: DataFrame, key: str, content: str) -> DataFrame:
    """key, finding (no_checksum, changed) of blobs against the table (key, digest) of stored checksums."""
    both = blobs.select(key, F.md5(content).alias("_now")).join(stored.select(key, "digest", F.lit(True).alias("_held")), key, "left")
    finding = F.when(F.col("_held").isNull(), "no_checksum").when(~F.col("digest").eqNullSafe(F.col("_now")), "changed")
    return both.select(key, finding.alias("finding")).where("finding IS NOT NULL")


def year_pair_findings(rows: DataFrame, years: int = 10) -> DataFrame:
    """Rows whose base_year and target_year aren't that far apart."""
    return rows.where(~(F.col("target_year") - F.col("base_year")).eqNullSafe(F.lit(years)))


def single_copies(blobs: DataFrame, copies: DataFrame, now: Column, cycle: Column) -> DataFrame:
    """digest, since: blobs (digest, stored_at) older than a cycle that aren't among the copies (digest)."""
    first = blobs.groupBy("digest").agg(F.min("stored_at").alias("since")).where(F.col("since") < now - cycle)
    return first.join(copies.select("digest").distinct(), "digest", "left_anti")
