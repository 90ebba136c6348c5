"""Queries on the state of the change log at an instant."""

from __future__ import annotations

from pyspark.sql import functions as F

from vintora.operators import asof
from vintora.plans.registry import Tables, query
from vintora.sources.views import CUT, T0

COLUMNS = "program, unit_key, CAST(ref_date AS VARCHAR) AS ref_date, CAST(epoch_us(knowledge_time) AS BIGINT) AS known_us, sequence, value, provenance"
KEYS = "program, unit_key, measure_code, ref_date, period_code"


def instant(text: str):
    return F.lit(text).cast("timestamp_ntz")


def micros(c: str):
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})")


def shown(df):
    return df.select("program", "unit_key", F.col("ref_date").cast("string").alias("ref_date"), micros("knowledge_time").alias("known_us"), "sequence", "value", "provenance")


VISIBLE_CATALOG = "SELECT series_id, title, release_event_id FROM catalog_log WHERE release_event_id IN (SELECT release_event_id FROM catalog_committed)"


@query(VISIBLE_CATALOG)
def catalog_visible(t: Tables):
    """Catalog rows are vintage data: readable once their release was committed, and not before."""
    return asof.visible(t("catalog_log"), t("catalog_committed")).select("series_id", "title", "release_event_id")


def state(where: str, at: str = CUT) -> str:
    return f"SELECT {COLUMNS} FROM (SELECT * FROM obs WHERE knowledge_time <= @ts({at}) AND {where} AND release_event_id IN (SELECT release_event_id FROM committed) QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY knowledge_time DESC, sequence DESC) = 1) WHERE change_kind <> 'deleted'"


@query(state("provenance IN ('observed', 'seed')"))
def asof_strict(t: Tables):
    return shown(asof.as_of(t("obs"), t("committed"), instant(CUT), first_instant=instant(T0)))


@query(state("TRUE"))
def asof_nonstrict(t: Tables):
    return shown(asof.as_of(t("obs"), t("committed"), instant(CUT), strict=False))


EARLY = "2024-01-04 23:59:59"


@query(f"SELECT 'strict' AS reading, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'non-strict', COUNT(*) FROM ({state('TRUE', EARLY)})")
def asof_before_t0(t: Tables):
    """Rows before the first instant of observation: none for a strict reading, the reconstructed ones for another."""
    one = lambda strict: asof.as_of(t("obs"), t("committed"), instant(EARLY), strict=strict, first_instant=instant(T0))
    found = one(True).withColumn("reading", F.lit("strict")).unionByName(one(False).withColumn("reading", F.lit("non-strict"))).groupBy("reading").agg(F.count("*").alias("n"))
    names = t.spark.createDataFrame([("strict",), ("non-strict",)], "reading string")
    return names.join(found, "reading", "left").select("reading", F.coalesce("n", F.lit(0)).alias("n"))


@query(state("provenance IN ('observed', 'seed')", T0))
def asof_at_t0(t: Tables):
    return shown(asof.as_of(t("obs"), t("committed"), instant(T0), first_instant=instant(T0)))


@query(state("provenance IN ('observed', 'seed') AND year(ref_date) = 2024"))
def asof_ref_years(t: Tables):
    return shown(asof.as_of(t("obs"), t("committed"), instant(CUT), first_instant=instant(T0), years=[2024]))


@query(f"SELECT {COLUMNS} FROM obs WHERE release_event_id IN (SELECT release_event_id FROM committed)")
def visible_rows(t: Tables):
    return shown(asof.visible(t("obs"), t("committed")))


@query("SELECT program, release_event_id, COUNT(*) AS hidden_rows FROM obs WHERE release_event_id NOT IN (SELECT release_event_id FROM committed) GROUP BY program, release_event_id")
def torn_commit(t: Tables):
    """Rows written for releases that were never committed: none of them may be read."""
    hidden = t("obs").join(t("committed").select("release_event_id"), "release_event_id", "left_anti")
    return hidden.groupBy("program", "release_event_id").agg(F.count("*").alias("hidden_rows"))


@query(f"""
    SELECT s.program, s.unit_key, CAST(s.ref_date AS VARCHAR) AS ref_date, CAST(epoch_us(s.at) AS BIGINT) AS at_us, o.sequence, o.value
    FROM (SELECT DISTINCT {KEYS}, d AS at FROM obs, (VALUES (@ts(2024-01-10 00:00:00)), (@ts(2024-01-20 00:00:00)), (@ts(2024-02-01 00:00:00))) v(d)) s
    JOIN LATERAL (SELECT * FROM obs o WHERE o.provenance IN ('observed', 'seed') AND o.release_event_id IN (SELECT release_event_id FROM committed) AND o.program = s.program AND o.unit_key = s.unit_key AND o.measure_code = s.measure_code AND o.ref_date = s.ref_date AND o.period_code = s.period_code AND o.knowledge_time <= s.at ORDER BY o.knowledge_time DESC, o.sequence DESC LIMIT 1) o ON TRUE
    WHERE o.change_kind <> 'deleted'""")
def asof_spine(t: Tables):
    log = t("obs")
    days = F.array(*(F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in ("2024-01-10", "2024-01-20", "2024-02-01")))
    spine = log.select(*asof.KEY).distinct().withColumn("at", F.explode(days))
    return asof.as_of_spine(log, t("committed"), spine, until=instant("2024-02-01 00:00:00")).select("program", "unit_key", F.col("ref_date").cast("string").alias("ref_date"), micros("at").alias("at_us"), "sequence", "value")


VISIBLE = "release_event_id IN (SELECT release_event_id FROM committed)"
REVISIONS = f"SELECT *, row_number() OVER w AS vintage, lag(value) OVER w AS prev_value, first_value(value) OVER w AS first_value FROM obs WHERE {VISIBLE} WINDOW w AS (PARTITION BY {KEYS} ORDER BY knowledge_time, sequence)"


@query(f"SELECT program, unit_key, CAST(ref_date AS VARCHAR) AS ref_date, sequence, CAST(vintage AS BIGINT) AS vintage, value, prev_value, first_value FROM ({REVISIONS})")
def revisions(t: Tables):
    return asof.revisions(asof.visible(t("obs"), t("committed"))).select("program", "unit_key", F.col("ref_date").cast("string").alias("ref_date"), "sequence", "vintage", "value", "prev_value", "first_value")


@query(f"SELECT {COLUMNS}, change_kind FROM obs WHERE {VISIBLE} QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY knowledge_time DESC, sequence DESC) = 1")
def current_state(t: Tables):
    """The fold of the whole visible log. Deletions stay, so that a reinstatement can be told from a first print."""
    rows = asof.newest(asof.visible(t("obs"), t("committed")))
    return rows.select("program", "unit_key", F.col("ref_date").cast("string").alias("ref_date"), micros("knowledge_time").alias("known_us"), "sequence", "value", "provenance", "change_kind")


@query(f"""
    SELECT program, unit_key, CAST(ref_date AS VARCHAR) AS ref_date, sequence, prev_value, value_before
    FROM (SELECT *, CASE WHEN sequence % 37 = 0 THEN v + 1 ELSE v END AS prev_value, v AS value_before FROM (SELECT *, lag(value) OVER (PARTITION BY {KEYS} ORDER BY knowledge_time, sequence) AS v, row_number() OVER (PARTITION BY {KEYS} ORDER BY knowledge_time, sequence) AS n FROM obs)) WHERE n > 1 AND prev_value IS DISTINCT FROM value_before""")
def n6_prev_value(t: Tables):
    """Stated previous values that aren't the row before; every 37th is falsified on purpose."""
    stated = asof.revisions(t("obs")).withColumn("prev_value", F.when(F.col("sequence") % 37 == 0, F.col("prev_value") + 1).otherwise(F.col("prev_value")))
    return asof.broken_chain(stated).select("program", "unit_key", F.col("ref_date").cast("string").alias("ref_date"), "sequence", "prev_value", "value_before")


@query(f"SELECT {COLUMNS}, period_kind FROM obs WHERE period_kind = 'period' AND {VISIBLE}")
def series_view(t: Tables):
    rows = asof.visible(t("obs"), t("committed")).where("period_kind = 'period'")
    return rows.select("program", "unit_key", F.col("ref_date").cast("string").alias("ref_date"), micros("knowledge_time").alias("known_us"), "sequence", "value", "provenance", "period_kind")


@query(f"SELECT {KEYS.replace('ref_date', 'CAST(ref_date AS VARCHAR) AS ref_date')}, COUNT(*) AS n FROM obs GROUP BY {KEYS}, knowledge_time HAVING COUNT(*) > 1")
def pk_check(t: Tables):
    """Keys with two rows of one instant: seeds share the first instant, so only the sequence orders them."""
    return asof.repeated_keys(t("obs"), [*asof.KEY, "knowledge_time"]).drop("knowledge_time").withColumn("ref_date", F.col("ref_date").cast("string"))


@query(f"SELECT program, unit_key, sequence, CAST(epoch_us(knowledge_time) AS BIGINT) AS known_us FROM (SELECT *, lag(knowledge_time) OVER (PARTITION BY program, unit_key ORDER BY sequence) AS before FROM (SELECT * REPLACE (CASE WHEN sequence % 101 = 0 THEN knowledge_time - INTERVAL 9 DAY ELSE knowledge_time END AS knowledge_time) FROM obs)) WHERE knowledge_time < before")
def monotonic_window(t: Tables):
    """Rows known before the row that precedes them in sequence; every 101st is moved back on purpose."""
    moved = t("obs").withColumn("knowledge_time", F.when(F.col("sequence") % 101 == 0, F.col("knowledge_time") - F.expr("INTERVAL 9 DAYS")).otherwise(F.col("knowledge_time")))
    return asof.backward_steps(moved, ["program", "unit_key"], "sequence", "knowledge_time").select("program", "unit_key", "sequence", micros("knowledge_time").alias("known_us"))


@query("SELECT program, CAST(ref_date AS VARCHAR) AS ref_date, COALESCE(data_at <= @ts(1998-06-15 00:00:00), FALSE) AS published, COALESCE(news_date <= @ts(1998-06-15 00:00:00), FALSE) AS announced, CASE WHEN data_at IS NULL THEN 'uncertain' WHEN data_at > news_date THEN 'lower_bound' ELSE 'exact' END AS confidence FROM knowability")
def published_asof(t: Tables):
    found = asof.published(t("knowability"), instant("1998-06-15 00:00:00"))
    return found.select("program", F.col("ref_date").cast("string").alias("ref_date"), "published", "announced", "confidence")


@query("SELECT program, unit_key, CAST(ref_date AS VARCHAR) AS ref_date, sequence, value, release_date FROM (SELECT o.*, CAST(c.release_date AS VARCHAR) AS release_date, row_number() OVER (PARTITION BY o.program ORDER BY o.sequence DESC) AS n FROM obs o JOIN committed c ON o.release_event_id = c.release_event_id) WHERE n <= 5")
def slot_context(t: Tables):
    """The last five committed rows of each program, as context for its next slot."""
    from pyspark.sql.window import Window

    rows = t("obs").join(t("committed").select("release_event_id", "release_date"), "release_event_id")
    last = rows.withColumn("n", F.row_number().over(Window.partitionBy("program").orderBy(F.desc("sequence")))).where("n <= 5")
    return last.select("program", "unit_key", F.col("ref_date").cast("string").alias("ref_date"), "sequence", "value", F.col("release_date").cast("string").alias("release_date"))


EARLIER = "2024-01-06 12:00:00"
BEGUN = f"program IN (SELECT program FROM first_instants WHERE first_instant <= @ts({EARLIER}))"


@query(state(f"provenance IN ('observed', 'seed') AND {BEGUN}", EARLIER).replace("FROM obs", "FROM program_obs"))
def asof_program_t0(t: Tables):
    """The strict state at an instant that some programs' observation had begun by, and others' not."""
    return shown(asof.as_of(t("program_obs"), t("committed"), instant(EARLIER), first_instants=t("first_instants")))


@query(f"""
    SELECT f.program, CAST(epoch_us(f.first_instant) AS BIGINT) AS first_us, COALESCE(s.n, 0) AS strict_rows, COALESCE(a.n, 0) AS all_rows FROM first_instants f
    LEFT JOIN (SELECT program, COUNT(*) AS n FROM ({state(f"provenance IN ('observed', 'seed') AND {BEGUN}", EARLIER).replace("FROM obs", "FROM program_obs")}) GROUP BY program) s ON s.program = f.program
    LEFT JOIN (SELECT program, COUNT(*) AS n FROM ({state("TRUE", EARLIER).replace("FROM obs", "FROM program_obs")}) GROUP BY program) a ON a.program = f.program""")
def strict_start(t: Tables):
    """How many rows either reading has of each program: none strictly before its own first instant."""
    read = lambda strict, name: asof.as_of(t("program_obs"), t("committed"), instant(EARLIER), strict=strict, first_instants=t("first_instants")).groupBy("program").agg(F.count("*").alias(name))
    both = t("first_instants").join(read(True, "s"), "program", "left").join(read(False, "a"), "program", "left")
    return both.select("program", micros("first_instant").alias("first_us"), F.coalesce("s", F.lit(0)).alias("strict_rows"), F.coalesce("a", F.lit(0)).alias("all_rows"))


@query("SELECT o.program, o.sequence, CAST(epoch_us(o.knowledge_time) AS BIGINT) AS known_us FROM program_obs o JOIN first_instants f ON o.program = f.program WHERE o.provenance = 'seed' AND o.knowledge_time <> f.first_instant")
def n1_seed_pinned(t: Tables):
    """Seed rows that claim to have been known at another instant than their program's first."""
    return asof.unpinned_seeds(t("program_obs"), t("first_instants")).select("program", "sequence", micros("knowledge_time").alias("known_us"))
