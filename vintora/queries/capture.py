"""Queries on the capture log."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintora.operators import capture
from vintora.plans.registry import Tables, query
from vintora.queries.asof import micros

BEARING = "outcome IN ('unchanged', 'restamp_only', 'new_bytes')"
STATE = f"""SELECT v.url, v.etag, v.last_modified, v.requested_at AS validators_at, c.content_hash, c.requested_at AS content_at
    FROM (SELECT * FROM fetch_log WHERE {BEARING} QUALIFY row_number() OVER (PARTITION BY url ORDER BY requested_at DESC, request_id DESC) = 1) v
    LEFT JOIN (SELECT * FROM fetch_log WHERE outcome = 'new_bytes' AND content_hash IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY requested_at DESC, request_id DESC) = 1) c ON v.url = c.url"""


@query(f"SELECT url, etag, last_modified, CAST(epoch_us(validators_at) AS BIGINT) AS validators_us, content_hash, CAST(epoch_us(content_at) AS BIGINT) AS content_us FROM ({STATE})")
def watch_state(t: Tables):
    return capture.watch_state(t("fetch_log")).select("url", "etag", "last_modified", micros("validators_at").alias("validators_us"), "content_hash", micros("content_at").alias("content_us"))


PROBES = "SELECT p.request_id, s.url IS NOT NULL AS known, p.status_code, p.etag, s.etag AS prior_etag, p.last_modified, s.last_modified AS prior_modified, p.content_hash, s.content_hash AS prior_hash FROM (SELECT * FROM fetch_log WHERE request_id % 4 = 0) p LEFT JOIN ({}) s ON p.url = s.url".format(STATE.replace("fetch_log WHERE", "fetch_log WHERE request_id % 4 <> 0 AND artifact % 9 <> 0 AND"))


def _probes(t: Tables):
    log = t("fetch_log")
    state = capture.watch_state(log.where("request_id % 4 <> 0 AND artifact % 9 <> 0"))
    prior = state.select("url", F.lit(True).alias("known"), F.col("etag").alias("prior_etag"), F.col("last_modified").alias("prior_modified"), F.col("content_hash").alias("prior_hash"))
    return log.where("request_id % 4 = 0").join(prior, "url", "left").withColumn("known", F.coalesce("known", F.lit(False)))


@query(f"SELECT request_id, CASE WHEN NOT known THEN TRUE WHEN status_code IS DISTINCT FROM 200 THEN FALSE WHEN etag <> prior_etag OR last_modified <> prior_modified THEN TRUE ELSE NOT ((etag IS NOT NULL AND prior_etag IS NOT NULL) OR (last_modified IS NOT NULL AND prior_modified IS NOT NULL)) END AS fetch FROM ({PROBES})")
def decide_fetch(t: Tables):
    c = F.col
    return _probes(t).select("request_id", capture.decide_fetch(c("known"), c("status_code"), c("etag"), c("prior_etag"), c("last_modified"), c("prior_modified")).alias("fetch"))


@query(f"SELECT request_id, CASE WHEN prior_hash IS NULL OR prior_hash <> content_hash THEN 'new_bytes' ELSE 'restamp_only' END AS outcome FROM ({PROBES}) WHERE content_hash IS NOT NULL")
def classify_bytes(t: Tables):
    return _probes(t).where("content_hash IS NOT NULL").select("request_id", capture.classify_bytes(F.col("prior_hash"), F.col("content_hash")).alias("outcome"))


@query("SELECT request_id, CASE WHEN status_code = 403 THEN 'blocked' WHEN status_code IS NULL OR status_code >= 400 THEN 'error' WHEN request_id % 10 = 0 THEN 'error' ELSE 'unchanged' END AS result FROM fetch_log")
def http_outcome(t: Tables):
    error = F.when(F.col("request_id") % 10 == 0, "timeout")
    return t("fetch_log").select("request_id", capture.outcome_of(F.col("status_code"), error).alias("result"))


@query(f"SELECT request_id, CASE WHEN NOT known THEN 'get' WHEN status_code <> 200 THEN 'log_status' WHEN artifact % 7 = 0 THEN 'conditional_get' WHEN etag <> prior_etag OR last_modified <> prior_modified THEN 'get' WHEN (etag IS NOT NULL AND prior_etag IS NOT NULL) OR (last_modified IS NOT NULL AND prior_modified IS NOT NULL) THEN 'log_unchanged' ELSE 'get' END AS plan FROM ({PROBES.replace('p.request_id,', 'p.request_id, p.artifact,')})")
def capture_plan(t: Tables):
    """What a sweep does with each probe: log it, or fetch, unconditionally or with validators."""
    c = F.col
    fetch = capture.decide_fetch(c("known"), c("status_code"), c("etag"), c("prior_etag"), c("last_modified"), c("prior_modified"))
    plan = F.when(~c("known"), "get").when(c("status_code") != 200, "log_status").when(c("artifact") % 7 == 0, "conditional_get").when(fetch, "get").otherwise("log_unchanged")
    return _probes(t).select("request_id", plan.alias("plan"))


NEW = "SELECT request_id, url, content_hash, artifact, requested_at FROM fetch_log WHERE outcome = 'new_bytes'"


@query(f"SELECT request_id, url, content_hash, CAST(epoch_us(requested_at) AS BIGINT) AS first_us FROM ({NEW}) WHERE request_id % 3 <> 0")
def file_vintage(t: Tables):
    """Vintages still to be materialized: a third of them has a row already."""
    log = t("fetch_log")
    known = capture.file_vintages(log.where("request_id % 3 = 0"))
    return capture.file_vintages(log, known).select("request_id", "url", "content_hash", micros("requested_at").alias("first_us"))


@query("SELECT request_id, sha256(url || '|' || COALESCE(content_hash, '~') || '|' || strftime(requested_at, '%Y-%m-%d %H:%M:%S')) AS vintage_id FROM fetch_log WHERE outcome = 'new_bytes'")
def vintage_id(t: Tables):
    stamp = F.date_format("requested_at", "yyyy-MM-dd HH:mm:ss")
    return t("fetch_log").where("outcome = 'new_bytes'").select("request_id", F.sha2(F.concat_ws("|", "url", F.coalesce("content_hash", F.lit("~")), stamp), 256).alias("vintage_id"))


@query("SELECT request_id, row_number() OVER (ORDER BY requested_at, request_id) AS sequence FROM fetch_log WHERE outcome = 'new_bytes'")
def vintage_sequence(t: Tables):
    return capture.numbered(t("fetch_log").where("outcome = 'new_bytes'")).select("request_id", "sequence")


@query("SELECT request_id, url, content_hash, status_code, row_number() OVER (ORDER BY requested_at, request_id) AS sequence FROM fetch_log")
def log_sequence(t: Tables):
    """The whole log in order, with what each record says beside its place."""
    return capture.numbered(t("fetch_log")).select("request_id", "url", "content_hash", "status_code", "sequence")


@query("SELECT artifact, url FROM inventory WHERE list_contains(string_split(CASE WHEN artifact % 2 = 0 THEN program || ',3' ELSE program END, ','), '3')")
def artifacts_of_program(t: Tables):
    """Artifacts that serve a program, alone or among others."""
    programs = F.when(F.col("artifact") % 2 == 0, F.array("program", F.lit("3"))).otherwise(F.array("program"))
    return t("inventory").where(F.array_contains(programs, "3")).select("artifact", "url")


@query("SELECT run_id, COUNT(*) AS n, MIN(request_id) AS first_request FROM (SELECT strftime(date_trunc('hour', requested_at), '%Y%m%dT%H%M%SZ') || '-' || substr(sha256(CAST(artifact % 3 AS VARCHAR)), 1, 8) AS run_id, request_id FROM fetch_log) GROUP BY run_id ORDER BY run_id LIMIT 100")
def runs_in_order(t: Tables):
    """The first hundred runs by name, which is by time: a run's name begins with its start."""
    run = capture.run_id(F.date_trunc("hour", "requested_at").cast("timestamp_ntz"), F.col("artifact") % 3)
    return t("fetch_log").groupBy(run.alias("run_id")).agg(F.count("*").alias("n"), F.min("request_id").alias("first_request")).orderBy("run_id").limit(100)


@query(f"SELECT n.request_id, i.program, i.artifact_key FROM ({NEW}) n LEFT JOIN inventory i ON n.url = i.url")
def vintage_resolve(t: Tables):
    return capture.file_vintages(t("fetch_log")).join(t("inventory").select("url", "program", "artifact_key"), "url", "left").select("request_id", "program", "artifact_key")


@query("SELECT artifact % 11 AS run, COUNT(*) AS checked, COUNT(*) FILTER (WHERE outcome = 'unchanged') AS unchanged, COUNT(*) FILTER (WHERE outcome = 'restamp_only') AS restamp_only, COUNT(*) FILTER (WHERE outcome = 'new_bytes') AS new_bytes, COUNT(*) FILTER (WHERE outcome = 'error') AS error, COUNT(*) FILTER (WHERE outcome = 'blocked') AS blocked, COUNT(*) FILTER (WHERE artifact % 7 = 0 AND outcome IN ('error', 'blocked')) AS html_failures, COUNT(*) FILTER (WHERE artifact % 7 = 0 AND outcome IN ('error', 'blocked')) > 0 AS degraded FROM fetch_log GROUP BY 1")
def capture_summary(t: Tables):
    log = t("fetch_log").withColumns({"run": F.col("artifact") % 11, "profile": F.when(F.col("artifact") % 7 == 0, "html").otherwise("flatfile")})
    return capture.summary(log, "run")


@query("SELECT url FROM inventory WHERE url NOT IN (SELECT url FROM fetch_log WHERE CAST(requested_at AS DATE) = DATE '2024-01-15')")
def sweep_coverage(t: Tables):
    swept = t("fetch_log").where("CAST(requested_at AS DATE) = DATE'2024-01-15'").select("url")
    return t("inventory").select("url").join(swept, "url", "left_anti")


@query("SELECT doc_id, sha256(text) AS content_sha256, CAST(strlen(text) AS BIGINT) AS byte_size FROM documents")
def dual_hash(t: Tables):
    """Content hash and size of each blob."""
    return t("documents").select("doc_id", F.sha2("text", 256).alias("content_sha256"), F.octet_length("text").cast("long").alias("byte_size"))


@query("SELECT doc_id, 'raw/blob/sha256=' || substr(h, 1, 2) || '/' || substr(h, 3, 2) || '/' || h AS blob_key FROM (SELECT doc_id, sha256(text) AS h FROM documents)")
def blob_key(t: Tables):
    return t("documents").select("doc_id", capture.two_level_key(F.sha2("text", 256)).alias("blob_key"))


@query("SELECT sha256(text) AS digest, MIN(doc_id) AS doc_id, COUNT(*) AS copies FROM documents WHERE doc_id % 2 = 1 AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0) GROUP BY 1")
def blob_dedup(t: Tables):
    """Blobs still to be stored: one of each content that isn't there yet."""
    blobs = t("documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    new = blobs.where("doc_id % 2 = 1").join(blobs.where("doc_id % 2 = 0").select("digest"), "digest", "left_anti")
    return new.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("SELECT digest, doc_id FROM (SELECT sha256(text) AS digest, doc_id FROM documents) ORDER BY digest, doc_id LIMIT 25")
def fixity_sample(t: Tables):
    """A reproducible sample of blobs to re-read: the 25 least hashes."""
    return t("documents").select(F.sha2("text", 256).alias("digest"), "doc_id").orderBy("digest", "doc_id").limit(25)


@query("SELECT release_event_id, COUNT(*) AS n_rows, MIN(unit_key) AS min_key, MAX(unit_key) AS max_key, CAST(epoch_us(MIN(knowledge_time)) AS BIGINT) AS min_us, CAST(epoch_us(MAX(knowledge_time)) AS BIGINT) AS max_us FROM obs GROUP BY release_event_id")
def manifest_stats(t: Tables):
    """Statistics by which a reader drops a release's objects unopened."""
    found = t("obs").groupBy("release_event_id").agg(F.count("*").alias("n_rows"), F.min("unit_key").alias("min_key"), F.max("unit_key").alias("max_key"), F.min("knowledge_time").alias("lo"), F.max("knowledge_time").alias("hi"))
    return found.select("release_event_id", "n_rows", "min_key", "max_key", micros("lo").alias("min_us"), micros("hi").alias("max_us"))


@query("SELECT what, name, n FROM (SELECT 'key' AS what, artifact_key AS name, COUNT(*) AS n FROM (SELECT CASE WHEN artifact % 25 = 0 THEN 'twin' ELSE artifact_key END AS artifact_key FROM inventory) GROUP BY artifact_key UNION ALL SELECT 'url', url, COUNT(*) FROM (SELECT CASE WHEN artifact % 30 = 1 THEN 'https://files.example/twin' ELSE url END AS url FROM inventory) GROUP BY url) WHERE n > 1")
def inventory_unique(t: Tables):
    """Keys and urls that several artifacts share; some are falsified on purpose."""
    rows = t("inventory").withColumns({"artifact_key": F.when(F.col("artifact") % 25 == 0, "twin").otherwise(F.col("artifact_key")), "url": F.when(F.col("artifact") % 30 == 1, "https://files.example/twin").otherwise(F.col("url"))})
    names = rows.select(F.inline(F.array(F.struct(F.lit("key").alias("what"), F.col("artifact_key").alias("name")), F.struct(F.lit("url").alias("what"), F.col("url").alias("name")))))
    return names.groupBy("what", "name").agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT split_part(artifact_key, '.', 1) AS prefix, COUNT(*) AS n FROM inventory GROUP BY 1 HAVING COUNT(*) > 1")
def prefix_guard(t: Tables):
    """Prefixes with more than one data file: a superset and its subset would report a change twice."""
    return t("inventory").groupBy(F.split("artifact_key", r"\.")[0].alias("prefix")).agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT DISTINCT program FROM slots_programs WHERE program NOT IN (SELECT program FROM inventory WHERE artifact % 3 = 0)".replace("slots_programs", "(SELECT CAST(o_custkey % 13 AS VARCHAR) AS program FROM orders)"))
def scope_coverage(t: Tables):
    """Programs in scope that no captured artifact covers."""
    wanted = t("orders").select((F.col("o_custkey") % 13).cast("string").alias("program"))
    return wanted.distinct().exceptAll(t("inventory").where("artifact % 3 = 0").select("program").distinct())


# Path prefixes a publisher's robots file disallows.
DISALLOWED = ("/scripts", "/crs", "/_private", "/iisadmin", "/srchadm", "/advisory/members/", "/idcf")


@query("SELECT page_id, path, NOT (" + " OR ".join(f"starts_with(path, '{p}')" for p in DISALLOWED) + " OR contains(path, 'print')) AS allowed FROM (SELECT page_id, '/' || array_to_string(array_slice(string_split(url, '/'), 4, 99), '/') AS path FROM pages)")
def path_policy(t: Tables):
    path = F.concat(F.lit("/"), F.array_join(F.slice(F.split("url", "/"), 4, 99), "/"))
    bad = F.contains("path", F.lit("print"))
    for p in DISALLOWED:
        bad |= F.startswith("path", F.lit(p))
    return t("pages").select("page_id", path.alias("path")).withColumn("allowed", ~bad)


@query("SELECT request_id, CASE WHEN e < -300 THEN NULL WHEN e <= 1800 THEN 60 WHEN e <= 14400 THEN 300 WHEN e < 48600 THEN 1800 WHEN e <= 259200 THEN 21600 ELSE 0 END AS every FROM (SELECT request_id, request_id % 400 * 900 - 600 AS e FROM fetch_log)")
def poll_ladder(t: Tables):
    """Seconds between polls for a slot due at 10:30, by time since."""
    elapsed = F.col("request_id") % 400 * 900 - 600
    return t("fetch_log").select("request_id", capture.poll_interval(elapsed, 48_599 - elapsed).alias("every"))


@query("SELECT outcome, median(d) AS median_ms FROM (SELECT outcome, CAST(request_id % 97 AS DOUBLE) AS d FROM fetch_log) GROUP BY outcome")
def latency_median(t: Tables):
    return t("fetch_log").groupBy("outcome").agg(F.median((F.col("request_id") % 97).cast("double")).alias("median_ms"))


@query("SELECT artifact, MIN(request_id) FILTER (WHERE outcome = 'blocked') AS first_block, MAX(request_id) FILTER (WHERE outcome <> 'blocked') AS last_pass, CASE WHEN MIN(request_id) FILTER (WHERE outcome = 'blocked') IS NULL THEN 'never_blocked' WHEN MAX(request_id) FILTER (WHERE outcome <> 'blocked') IS NULL THEN 'always_blocked' WHEN MIN(request_id) FILTER (WHERE outcome = 'blocked') > MAX(request_id) FILTER (WHERE outcome <> 'blocked') THEN 'blocked_from_then_on' ELSE 'interleaved' END AS verdict FROM fetch_log GROUP BY artifact")
def sequence_verdict(t: Tables):
    """Whether blocks came from some request on, or in between others."""
    block, rest = F.min(F.when(F.col("outcome") == "blocked", F.col("request_id"))), F.max(F.when(F.col("outcome") != "blocked", F.col("request_id")))
    found = t("fetch_log").groupBy("artifact").agg(block.alias("first_block"), rest.alias("last_pass"))
    return found.withColumn("verdict", F.when(F.col("first_block").isNull(), "never_blocked").when(F.col("last_pass").isNull(), "always_blocked").when(F.col("first_block") > F.col("last_pass"), "blocked_from_then_on").otherwise("interleaved"))


@query("SELECT artifact, COALESCE(bool_and(CASE WHEN request_id % 2 = 0 THEN status_code = 200 ELSE status_code IN (200, 206) END) FILTER (WHERE request_id % 5 <> 0), FALSE) AS passed FROM fetch_log GROUP BY artifact")
def ingest_gate(t: Tables):
    """Whether all data requests of an artifact succeeded, ranged ones included; every fifth is a robots file."""
    ok = F.when(F.col("request_id") % 2 == 0, F.col("status_code") == 200).otherwise(F.col("status_code").isin(200, 206))
    return t("fetch_log").groupBy("artifact").agg(F.coalesce(F.bool_and(F.when(F.col("request_id") % 5 != 0, ok)), F.lit(False)).alias("passed"))


@query("SELECT artifact, MAX(CAST(requested_at AS VARCHAR)[1:10]) FILTER (WHERE status_code = 200) AS newest FROM fetch_log GROUP BY artifact")
def newest_available(t: Tables):
    return t("fetch_log").groupBy("artifact").agg(F.max(F.when(F.col("status_code") == 200, F.col("requested_at").cast("date").cast("string"))).alias("newest"))


@query("SELECT c.release_event_id, CAST(c.release_date AS VARCHAR) AS release_date FROM committed c WHERE c.release_date < DATE '2024-01-25' AND c.release_event_id NOT IN (SELECT release_event_id FROM obs WHERE sequence % 40 = 0)")
def attest_backlog(t: Tables):
    """Committed releases without a proof beyond the tolerance."""
    proven = t("obs").where("sequence % 40 = 0").select("release_event_id")
    return t("committed").where("release_date < DATE'2024-01-25'").join(proven, "release_event_id", "left_anti").select("release_event_id", F.col("release_date").cast("string").alias("release_date"))


@query("SELECT request_id, program FROM (SELECT f.request_id, i.program, row_number() OVER (PARTITION BY i.program ORDER BY f.requested_at DESC, f.request_id DESC) AS n FROM fetch_log f JOIN inventory i ON f.url = i.url) WHERE n <= 3")
def last_observations(t: Tables):
    """The last three requests of each program."""
    rows = t("fetch_log").join(t("inventory").select("url", "program"), "url")
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("program").orderBy(F.desc("requested_at"), F.desc("request_id")))).where("n <= 3").select("request_id", "program")
