"""Validation rules: each query returns the rows that break its rule."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintora.operators import control, validate
from vintora.plans.registry import Tables, query
from vintora.queries.asof import micros
from vintora.queries.control import RESOLVED
from vintora.queries.periods import text
from vintora.sources.views import T0, for_spark

KEYED = "PARTITION BY program, unit_key, measure_code, ref_date, period_code"


@query("SELECT sequence, program, CAST(ref_date AS VARCHAR) AS ref_date FROM obs WHERE ref_date + CAST(6 AS INT) > CAST(knowledge_time AS DATE) AND program <> 'signup'")
def inv01_temporal(t: Tables):
    """Values seen before their reference period ended."""
    bad = t("obs").where("program <> 'signup'").where(F.date_add("ref_date", 6) > F.col("knowledge_time").cast("date"))
    return bad.select("sequence", "program", *text("ref_date"))


@query("SELECT release_event_id, unit_key, CAST(ref_date AS VARCHAR) AS ref_date, COUNT(*) AS n FROM obs GROUP BY release_event_id, unit_key, ref_date HAVING COUNT(DISTINCT value) > 1")
def inv02_overwrite(t: Tables):
    """Keys to which one release gave several values: a vintage is written once."""
    found = t("obs").groupBy("release_event_id", "unit_key", "ref_date").agg(F.count("*").alias("n"), F.count_distinct("value").alias("v")).where("v > 1")
    return found.select("release_event_id", "unit_key", *text("ref_date"), "n")


STORED = "SELECT doc_id, md5(CASE WHEN doc_id % 53 = 0 THEN text || ' ' ELSE text END) AS digest, CAST(strlen(text) AS BIGINT) AS byte_size FROM documents WHERE doc_id % 59 <> 0"


@query(f"SELECT d.doc_id, CASE WHEN s.doc_id IS NULL THEN 'no_checksum' ELSE 'changed' END AS finding FROM documents d LEFT JOIN ({STORED}) s ON d.doc_id = s.doc_id WHERE s.digest IS DISTINCT FROM md5(d.text)")
def inv07_checksum(t: Tables):
    """Blobs without a stored checksum, or whose content no longer has it; the checksums come from a table of their own."""
    from vintora.operators.validate import checksum_findings

    text = F.when(F.col("doc_id") % 53 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text"))
    stored = t("documents").where("doc_id % 59 <> 0").select("doc_id", F.md5(text).alias("digest"))
    return checksum_findings(t("documents"), stored, "doc_id", "text")


@query("SELECT release_id, abs(date_diff('minute', scheduled_at, first_observed_at)) AS minutes FROM releases WHERE abs(date_diff('minute', scheduled_at, first_observed_at)) > 20")
def inv08_divergence(t: Tables):
    """Releases seen far from their scheduled time."""
    minutes = F.abs(F.expr("timestampdiff(MINUTE, scheduled_at, first_observed_at)"))
    return t("releases").select("release_id", minutes.alias("minutes")).where("minutes > 20")


@query("SELECT release_id, ref_month FROM releases WHERE k = 5 AND ref_month <> 1")
def inv12_benchmark_month(t: Tables):
    """Benchmarks on a month other than January."""
    return t("releases").where("k = 5 AND ref_month <> 1").select("release_id", "ref_month")


@query(f"SELECT program, unit_key, CAST(ref_date AS VARCHAR) AS ref_date, sequence FROM (SELECT *, lag(value) OVER ({KEYED} ORDER BY knowledge_time, sequence) AS v FROM obs WHERE program = 'view' AND month(ref_date) = 1) WHERE value <> v")
def inv14_january(t: Tables):
    """January values that were revised in a program that leaves them alone."""
    order = Window.partitionBy("program", "unit_key", "measure_code", "ref_date", "period_code").orderBy("knowledge_time", "sequence")
    rows = t("obs").where("program = 'view' AND month(ref_date) = 1").withColumn("v", F.lag("value").over(order)).where("value <> v")
    return rows.select("program", "unit_key", *text("ref_date"), "sequence")


@query(f"SELECT sequence, unit_key FROM (SELECT *, row_number() OVER ({KEYED} ORDER BY knowledge_time, sequence) AS n FROM obs WHERE program = 'click') WHERE n > 1")
def inv18_immutable(t: Tables):
    """Second vintages in a program whose vintages are final."""
    order = Window.partitionBy("program", "unit_key", "measure_code", "ref_date", "period_code").orderBy("knowledge_time", "sequence")
    return t("obs").where("program = 'click'").withColumn("n", F.row_number().over(order)).where("n > 1").select("sequence", "unit_key")


@query("SELECT o.sequence, o.provenance FROM obs o WHERE o.provenance IN ('seed', 'reconstructed') AND o.knowledge_time <> @ts(2024-01-05 00:00:00)")
def n1_seed_honesty(t: Tables):
    """Seed and reconstructed rows that claim an instant other than the first of observation."""
    at = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    return t("obs").where(F.col("provenance").isin("seed", "reconstructed") & (F.col("knowledge_time") != at)).select("sequence", "provenance")


@query(f"""SELECT release_id, CAST(epoch_us(known_at) AS BIGINT) AS known_us FROM (SELECT *, known + CASE WHEN release_id % 97 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS known_at FROM (SELECT release_id, observed, CASE WHEN eligible IS NOT NULL AND observed <= eligible + INTERVAL 15 MINUTE THEN eligible WHEN noticed IS NOT NULL THEN noticed ELSE observed END AS known, eligible IS NOT NULL AND observed < eligible - INTERVAL 15 MINUTE AS early, noticed IS NOT NULL AND NOT COALESCE(observed <= eligible + INTERVAL 15 MINUTE, FALSE) AS by_notice FROM ({RESOLVED})))
    WHERE known_at > observed + INTERVAL 15 MINUTE AND NOT early AND NOT by_notice""")
def n2_clairvoyance(t: Tables):
    """Resolved knowledge later than the first sight allows, outside the flagged early branch and notices' days.

    Every 97th is moved by a day on purpose.
    """
    c = F.col
    at, source, flag = control.knowledge_time(c("scheduled_at"), c("scheduled_at_source"), c("notice_date"), c("first_observed_at"), F.expr("INTERVAL 15 MINUTES"))
    rows = t("releases").select("release_id", "first_observed_at", at.alias("at"), source.alias("source"), flag.alias("flag"))
    rows = rows.withColumn("at", F.when(c("release_id") % 97 == 0, c("at") + F.expr("INTERVAL 1 DAY")).otherwise(c("at")))
    bad = rows.where(c("at") > c("first_observed_at") + F.expr("INTERVAL 15 MINUTES")).where("NOT (flag <=> 'early_artifact') AND source <> 'notice'")
    return bad.select("release_id", micros("at").alias("known_us"))


@query("SELECT scheduled_at_source, COUNT(*) AS n FROM releases WHERE scheduled_at IS NOT NULL AND scheduled_at_source NOT IN ('ics', 'schedule_page') GROUP BY 1")
def n3_source(t: Tables):
    """Scheduled times from sources that can't be knowledge."""
    bad = t("releases").where(F.col("scheduled_at").isNotNull() & ~F.col("scheduled_at_source").isin("ics", "schedule_page"))
    return bad.groupBy("scheduled_at_source").agg(F.count("*").alias("n"))


@query("SELECT rule, severity, n, CASE WHEN severity = 'assert' AND n > 0 THEN 'abort' WHEN n > 0 THEN 'flag' ELSE 'pass' END AS verdict FROM (SELECT 'inv12' AS rule, 'assert' AS severity, COUNT(*) AS n FROM releases WHERE k = 5 AND ref_month <> 1 UNION ALL SELECT 'inv08', 'flag', COUNT(*) FROM releases WHERE abs(date_diff('minute', scheduled_at, first_observed_at)) > 20 UNION ALL SELECT 'n3', 'assert', COUNT(*) FROM releases WHERE scheduled_at IS NOT NULL AND scheduled_at_source NOT IN ('ics', 'schedule_page'))")
def rule_report(t: Tables):
    """Findings of several rules in one report: an assertion aborts a commit, a flag is written down."""
    from vintora.operators.validate import report

    bad = t("releases").where(F.col("scheduled_at").isNotNull() & ~F.col("scheduled_at_source").isin("ics", "schedule_page"))
    return report([("inv12", "assert", inv12_benchmark_month(t)), ("inv08", "flag", inv08_divergence(t)), ("n3", "assert", bad)])


@query("SELECT release_id, 'declared' AS clock FROM releases WHERE scheduled_at IS NULL UNION ALL SELECT release_id, 'shared' AS clock FROM releases WHERE scheduled_at = first_observed_at")
def inv03_clocks(t: Tables):
    """Declared and observed times are columns of their own: releases without a declared one, or where the two are one."""
    rows = t("releases")
    missing = rows.where("scheduled_at IS NULL").select("release_id", F.lit("declared").alias("clock"))
    return missing.unionByName(rows.where("scheduled_at = first_observed_at").select("release_id", F.lit("shared").alias("clock")))


@query("SELECT o.sequence, o.program, split_part(o.release_event_id, '-', 1) AS release_program FROM (SELECT * REPLACE (CASE WHEN sequence % 89 = 0 THEN 'view' ELSE program END AS program) FROM obs) o WHERE split_part(o.release_event_id, '-', 1) <> o.program")
def inv10_cascade(t: Tables):
    """Rows that one program's release would write into another program; every 89th is moved on purpose."""
    moved = t("obs").withColumn("program", F.when(F.col("sequence") % 89 == 0, "view").otherwise(F.col("program")))
    owner = F.split_part("release_event_id", F.lit("-"), F.lit(1))
    return moved.where(owner != F.col("program")).select("sequence", "program", owner.alias("release_program"))


@query("SELECT release_id, base_year, target_year FROM (SELECT release_id, ref_year AS base_year, ref_year + CASE WHEN k = 7 THEN 9 ELSE 10 END AS target_year FROM releases) WHERE target_year - base_year <> 10")
def inv21_year_pair(t: Tables):
    """Projections whose base and target year aren't ten years apart."""
    from vintora.operators.validate import year_pair_findings

    rows = t("releases").select("release_id", F.col("ref_year").alias("base_year"), (F.col("ref_year") + F.when(F.col("k") == 7, 9).otherwise(10)).alias("target_year"))
    return year_pair_findings(rows)


@query("SELECT request_id, url FROM fetch_log WHERE outcome = 'new_bytes' AND url IN (SELECT url FROM inventory WHERE profile = 'html')")
def inv23_artifact_key(t: Tables):
    """Vintages that are keyed to a page instead of a data artifact."""
    pages = t("inventory").where("profile = 'html'").select("url")
    return t("fetch_log").where("outcome = 'new_bytes'").join(pages, "url", "left_semi").select("request_id", "url")


@query("SELECT program, source, COUNT(*) AS n, MIN(at_minute) AS minute FROM (SELECT program, CASE WHEN program % 5 = 2 THEN 'constant' ELSE scheduled_at_source END AS source, hour(scheduled_at) * 60 + minute(scheduled_at) AS at_minute FROM releases WHERE scheduled_at IS NOT NULL) WHERE source NOT IN ('ics', 'schedule_page', 'cadence_estimate') GROUP BY program, source")
def inv27_scheduled(t: Tables):
    """Programs whose scheduled times come from a constant instead of a calendar or an estimate marked as such."""
    source = F.when(F.col("program") % 5 == 2, "constant").otherwise(F.col("scheduled_at_source"))
    minute = F.hour("scheduled_at") * 60 + F.minute("scheduled_at")
    rows = t("releases").where("scheduled_at IS NOT NULL").select("program", source.alias("source"), minute.cast("long").alias("minute"))
    return rows.where(~F.col("source").isin("ics", "schedule_page", "cadence_estimate")).groupBy("program", "source").agg(F.count("*").alias("n"), F.min("minute").alias("minute"))


@query("SELECT digest, MIN(day) AS since FROM (SELECT content_hash AS digest, CAST(CAST(requested_at AS DATE) AS VARCHAR) AS day, requested_at FROM fetch_log WHERE content_hash IS NOT NULL) WHERE digest NOT IN (SELECT content_hash FROM fetch_log WHERE content_hash < '8') GROUP BY digest HAVING MIN(requested_at) < @ts(2024-01-20 00:00:00) - INTERVAL 7 DAY")
def n12_second_copy(t: Tables):
    """Blobs that have stood without a second copy for longer than a release cycle of a week."""
    from vintora.operators.validate import single_copies

    blobs = t("fetch_log").where("content_hash IS NOT NULL")
    found = single_copies(blobs.select(F.col("content_hash").alias("digest"), F.col("requested_at").alias("stored_at")), blobs.where("content_hash < '8'").select(F.col("content_hash").alias("digest")), F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), F.expr("INTERVAL 7 DAYS"))
    return found.select("digest", F.col("since").cast("date").cast("string").alias("since"))


# rules over the log, as conditions that hold where they are broken, for Spark and DuckDB alike
LOG_RULES = [
    ("inv01", "assert", "ref_date > CAST(knowledge_time AS DATE)"),
    ("inv04", "assert", "program IS NULL OR unit_key IS NULL OR ref_date IS NULL OR knowledge_time IS NULL"),
    ("inv09", "flag", "value IS NULL"),
    ("inv10", "assert", "split_part(release_event_id, '-', 1) <> program"),
    ("inv11a", "assert", "period_kind NOT IN ('period', 'annual_average')"),
    ("inv26b", "flag", "provenance = 'external'"),
    ("n1", "assert", f"provenance = 'seed' AND knowledge_time <> @ts({T0})"),
    ("n4", "assert", "change_kind = 'deleted' AND provenance = 'external'"),
]
# the same over the rows of one release
RELEASE_RULES = [("n5", "assert", "COUNT(CASE WHEN change_kind = 'deleted' THEN 1 END) * 8 > COUNT(*)"), ("inv06", "assert", "MIN(program) <> MAX(program)")]
# and over releases
CLOCK_RULES = [
    ("inv01c", "assert", "make_date(CAST(ref_year AS INT), CAST(ref_month AS INT), 1) > CAST(first_observed_at AS DATE)"),
    ("inv03", "flag", "scheduled_at = first_observed_at"),
    ("inv08", "flag", "scheduled_at > first_observed_at + INTERVAL 20 MINUTE OR scheduled_at < first_observed_at - INTERVAL 20 MINUTE"),
    ("inv27", "assert", "scheduled_at_source NOT IN ('ics', 'schedule_page', 'cadence_estimate')"),
    ("n2", "flag", "scheduled_at > first_observed_at + INTERVAL 15 MINUTE"),
    ("n3", "assert", "scheduled_at IS NOT NULL AND scheduled_at_source NOT IN ('ics', 'schedule_page')"),
]


def _sql(rules, rows: str, subject: str, group: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {subject}, '{name}' AS rule, '{severity}' AS severity FROM {rows} {f'GROUP BY {group} HAVING {broken}' if group else f'WHERE {broken}'}" for name, severity, broken in rules)


def _rules(rules):
    return [(name, severity, F.expr(for_spark(broken))) for name, severity, broken in rules]


BY_RELEASE = f"{_sql(LOG_RULES, 'obs', 'program, release_event_id')} UNION ALL {_sql(RELEASE_RULES, 'obs', 'MIN(program) AS program, release_event_id', 'release_event_id')}"


def _log_findings(t: Tables):
    rows = validate.row_findings(t("obs"), _rules(LOG_RULES), ["program", "release_event_id"])
    # a release's program travels with it in the shared aggregate
    grouped = validate.key_findings(t("obs"), ["release_event_id"], _rules(RELEASE_RULES)).withColumn("program", F.split_part("release_event_id", F.lit("-"), F.lit(1)))
    return rows.unionByName(grouped)


@query(f"SELECT program, rule, severity, COUNT(*) AS n FROM (SELECT program, rule, severity FROM ({BY_RELEASE}) UNION ALL SELECT CAST(program AS VARCHAR), rule, severity FROM ({_sql(CLOCK_RULES, 'releases', 'program')})) GROUP BY program, rule, severity")
def rule_findings(t: Tables):
    """Findings of sixteen rules by program: log and releases are scanned once for their row rules, the log once for its group rules."""
    clocks = validate.row_findings(t("releases"), _rules(CLOCK_RULES), ["program"]).withColumn("program", F.col("program").cast("string"))
    return _log_findings(t).drop("release_event_id").unionByName(clocks).groupBy("program", "rule", "severity").agg(F.count("*").alias("n"))


VERDICTS = f"""SELECT release_event_id, asserts, overridden, flags, CASE WHEN asserts > 0 THEN 'abort' WHEN overridden > 0 THEN 'override' WHEN flags > 0 THEN 'flag' ELSE 'pass' END AS verdict FROM (
    SELECT f.release_event_id, COUNT(CASE WHEN severity = 'assert' AND o.rule IS NULL THEN 1 END) AS asserts, COUNT(CASE WHEN severity = 'assert' AND o.rule IS NOT NULL THEN 1 END) AS overridden, COUNT(CASE WHEN severity = 'flag' THEN 1 END) AS flags
    FROM ({BY_RELEASE}) f LEFT JOIN (SELECT release_event_id, rule FROM overrides WHERE trim(reason) <> '') o ON o.release_event_id = f.release_event_id AND o.rule = f.rule
    WHERE NOT (severity = 'flag' AND f.rule = 'inv26b' AND f.program = 'view') GROUP BY f.release_event_id)"""


def _verdicts(t: Tables):
    expected = t.spark.createDataFrame([("view", "inv26b")], "program string, rule string")
    return validate.verdicts(_log_findings(t), t("overrides"), expected)


@query(VERDICTS)
def commit_verdicts(t: Tables):
    """What the rules say of each release with findings: an assertion aborts unless overridden with a reason, an expected flag is no finding."""
    return _verdicts(t)


@query(f"SELECT program, release_event_id, COUNT(*) AS n FROM obs WHERE release_event_id NOT IN (SELECT release_event_id FROM ({VERDICTS}) WHERE verdict = 'abort') GROUP BY program, release_event_id")
def commit_gate(t: Tables):
    """Rows that a commit may write: those of releases no assertion stops."""
    return validate.committable(t("obs"), _verdicts(t)).groupBy("program", "release_event_id").agg(F.count("*").alias("n"))
