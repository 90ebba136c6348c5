"""Queries that compare vintages."""

from __future__ import annotations

from pyspark.sql import functions as F

from vintora.operators import diff, hashtree, ledger, links
from vintora.plans.registry import Tables, query

KINDS = "CASE WHEN p_in IS NULL THEN 'first_print' WHEN c_in IS NULL THEN 'deleted' WHEN p IS NOT NULL AND c IS NULL THEN 'suppressed' WHEN p IS NULL AND c IS NOT NULL THEN 'unsuppressed' WHEN p <> c THEN 'revised'{more} END"
JOINED = "wide_prev p FULL JOIN wide_cur c ON p.unit_key = c.unit_key AND p.ref_year = c.ref_year"


def cells(where: str, more: str = "") -> str:
    one = lambda m: f"SELECT COALESCE(p.unit_key, c.unit_key) AS unit_key, COALESCE(p.ref_year, c.ref_year) AS ref_year, '{m}' AS measure, c.{m} AS c, p.{m} AS p, p.unit_key AS p_in, c.unit_key AS c_in, p.footnote AS pf, c.footnote AS cf FROM {JOINED}"
    return f"SELECT unit_key, ref_year, measure, c AS value, p AS prev_value, {KINDS.format(more=more)} AS change_kind FROM ({one('price')} UNION ALL {one('customer')}) WHERE {KINDS.format(more=more)} IS NOT NULL AND ({where})"


KEY, MEASURES = ["unit_key", "ref_year"], ["price", "customer"]


@query(cells("c_in IS NOT NULL OR ref_year = 1996"))
def wide_diff(t: Tables):
    """Changed cells, with one year in scope for deletions."""
    return diff.wide_diff(t("wide_prev"), t("wide_cur"), KEY, MEASURES, scope=F.col("ref_year") == 1996)


@query(f"SELECT change_kind, measure, COUNT(*) AS n FROM ({cells('TRUE', more=chr(32) + 'WHEN pf IS DISTINCT FROM cf THEN ' + chr(39) + 'footnote_only' + chr(39))}) GROUP BY change_kind, measure")
def change_kind(t: Tables):
    """Cells by kind of change, changed footnotes included."""
    found = diff.wide_diff(t("wide_prev"), t("wide_cur"), KEY, MEASURES, scope=F.lit(True), footnote="footnote")
    return found.groupBy("change_kind", "measure").agg(F.count("*").alias("n"))


@query("SELECT unit_key, ref_year FROM wide_prev WHERE ref_year = 1996 AND unit_key NOT IN (SELECT unit_key FROM wide_cur)")
def scoped_deletes(t: Tables):
    prev = t("wide_prev").where("ref_year = 1996").select(*KEY)
    return prev.join(t("wide_cur").select(*KEY), KEY, "left_anti")


@query("SELECT ref_year, COUNT(*) AS flagged FROM wide_prev WHERE unit_key NOT IN (SELECT unit_key FROM wide_cur) GROUP BY ref_year")
def unscoped_flag(t: Tables):
    """Keys that went missing from an artifact without a scope: flagged, never deleted."""
    gone = t("wide_prev").select(*KEY).join(t("wide_cur").select(*KEY), KEY, "left_anti")
    return gone.groupBy("ref_year").agg(F.count("*").alias("flagged"))


@query(f"SELECT unit_key, ref_year, prev_value, value IS NULL AS suppressed FROM ({cells('TRUE')}) WHERE change_kind = 'suppressed'")
def suppression(t: Tables):
    """Suppressed cells keep their history: the value is null, never 0."""
    found = diff.wide_diff(t("wide_prev"), t("wide_cur"), KEY, MEASURES).where("change_kind = 'suppressed'")
    return found.select(*KEY, "prev_value", F.col("value").isNull().alias("suppressed"))


@query("SELECT unit_key, ref_year, CASE WHEN v IS NULL OR w IS NULL THEN 'suppressed' WHEN v = w THEN 'unchanged' WHEN round(v) = round(w) THEN 'precision_only' ELSE 'revised' END AS change FROM (SELECT unit_key, ref_year, price AS v, CASE WHEN unit_key % 3 = 0 THEN round(price, 1) WHEN unit_key % 3 = 1 THEN price + 3 ELSE price END AS w FROM wide_prev)")
def precision_only(t: Tables):
    """Values that agree once both are rounded to the coarser precision are no revision."""
    v, w, k = F.col("v"), F.col("w"), F.col("unit_key") % 3
    rows = t("wide_prev").select(*KEY, F.col("price").alias("v"), F.when(k == 0, F.round("price", 1)).when(k == 1, F.col("price") + 3).otherwise(F.col("price")).alias("w"))
    return rows.select(*KEY, F.when(v.isNull() | w.isNull(), "suppressed").when(v == w, "unchanged").when(diff.same_at(v, w, 0), "precision_only").otherwise("revised").alias("change"))


COARSE = "SELECT unit_key, ref_year, price AS p, CASE WHEN unit_key % 3 = 0 THEN round(price) WHEN unit_key % 7 = 0 THEN price + 3 ELSE price END AS c FROM wide_prev"


@query(f"SELECT unit_key, ref_year, p AS prev_value, c AS value, CASE WHEN ref_year >= 1995 AND round(p) = round(c) THEN 'precision_only' ELSE 'revised' END AS change_kind FROM ({COARSE}) WHERE p <> c")
def precision_change(t: Tables):
    """Values given with fewer digits: since 1995, when a marker announced it, a change of precision, before a revision."""
    k = F.col("unit_key")
    cur = t("wide_prev").withColumn("price", F.when(k % 3 == 0, F.round("price")).when(k % 7 == 0, F.col("price") + 3).otherwise(F.col("price")))
    found = diff.wide_diff(t("wide_prev"), cur, KEY, ["price"], precision=(F.col("ref_year") >= 1995, 0))
    return found.select(*KEY, "prev_value", "value", "change_kind")


@query("SELECT COALESCE(p.series_id, c.series_id) AS series_id, CASE WHEN p.series_id IS NULL THEN 'added' WHEN c.series_id IS NULL THEN 'discontinued' WHEN p.code IS DISTINCT FROM c.code THEN 'recoded' WHEN p.title IS DISTINCT FROM c.title THEN 'retitled' ELSE 'present' END AS status FROM catalog_prev p FULL JOIN catalog_cur c ON p.series_id = c.series_id")
def catalog_diff(t: Tables):
    return diff.catalog_diff(t("catalog_prev"), t("catalog_cur"), "series_id")


@query("SELECT p.series_id FROM catalog_prev p WHERE p.series_id NOT IN (SELECT series_id FROM catalog_cur) AND p.series_id % 46 <> 0")
def unexpected_loss(t: Tables):
    """Discontinued series that no marker announced."""
    lost = diff.catalog_diff(t("catalog_prev"), t("catalog_cur"), "series_id").where("status = 'discontinued'").select("series_id")
    return lost.join(t("catalog_prev").where("series_id % 46 = 0").select("series_id"), "series_id", "left_anti")


LINKS = "SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"?]+)\"', 1)) AS link FROM pages"


@query(f"WITH links AS ({LINKS}), prev AS (SELECT DISTINCT link FROM links WHERE page_id % 5 <> 0), cur AS (SELECT DISTINCT link FROM links WHERE page_id % 7 <> 0) SELECT link, 'added' AS change FROM cur WHERE link NOT IN (SELECT link FROM prev) UNION ALL SELECT link, 'removed' AS change FROM prev WHERE link NOT IN (SELECT link FROM cur)")
def link_set_diff(t: Tables):
    """Links gained and lost between two captures of the landing pages."""
    links = t("pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"?]+)"'), F.lit(1))).alias("link"))
    return diff.set_diff(links.where("page_id % 5 <> 0").select("link"), links.where("page_id % 7 <> 0").select("link"))


@query("SELECT COALESCE(p.unit_key, c.unit_key) AS unit_key, p.price AS left_value, c.price AS right_value FROM wide_prev p FULL JOIN wide_cur c ON p.unit_key = c.unit_key WHERE p.price IS DISTINCT FROM c.price")
def benchmark_diff(t: Tables):
    """Own earlier vintage against the publisher's `as previously published` column: they must match exactly."""
    return diff.disagreement(t("wide_prev"), t("wide_cur"), ["unit_key"], "price")


@query("SELECT p.unit_key, p.price AS left_value, c.price AS right_value FROM wide_prev p JOIN wide_cur c ON p.unit_key = c.unit_key WHERE abs(p.price - c.price) > 0.00001 * abs(c.price)")
def external_check(t: Tables):
    """Values beyond a tolerance from an external database; either may be wrong."""
    return diff.disagreement(t("wide_prev"), t("wide_cur"), ["unit_key"], "price", 0.00001)


def hashes(table: str) -> str:
    text = "concat_ws('|', CAST(unit_key AS VARCHAR), CAST(ref_year AS VARCHAR), COALESCE(CAST(CAST(customer AS BIGINT) AS VARCHAR), '~'), COALESCE(CAST(CAST(price AS DECIMAL(18,4)) AS VARCHAR), '~'), COALESCE(footnote, '~'))"
    key = "concat_ws('|', CAST(unit_key AS VARCHAR), CAST(ref_year AS VARCHAR))"
    number = lambda s, n: f"CAST('0x' || substr(md5({s}), 1, {n}) AS BIGINT)"
    return f"SELECT ref_year, {number(key, 8)} % 16 AS bucket, COUNT(*) AS n, CAST(SUM({number(text, 12)}) AS VARCHAR) AS hash FROM {table} GROUP BY 1, 2"


def _buckets(df):
    df = df.withColumns({"customer": F.col("customer").cast("long"), "price": F.col("price").cast("decimal(18,4)")})
    return diff.bucket_hashes(df, KEY, ["customer", "price", "footnote"], 16, ["ref_year"])


@query(f"SELECT COALESCE(a.ref_year, b.ref_year) AS ref_year, COALESCE(a.bucket, b.bucket) AS bucket, a.hash AS left_hash, b.hash AS right_hash FROM ({hashes('wide_prev')}) a FULL JOIN ({hashes('wide_cur')}) b ON a.ref_year = b.ref_year AND a.bucket = b.bucket WHERE a.hash IS DISTINCT FROM b.hash")
def replay_bucket_hash(t: Tables):
    """Buckets in which a replay and a fresh parse differ; only these are compared row by row."""
    return diff.differing_buckets(_buckets(t("wide_prev")), _buckets(t("wide_cur")), ["ref_year"])


LIVE = "SELECT ref_year, COUNT(*) AS live FROM wide_prev GROUP BY ref_year"
REVISED = f"SELECT ref_year, COUNT(DISTINCT unit_key) AS revised FROM ({cells('c_in IS NOT NULL')}) WHERE change_kind = 'revised' GROUP BY ref_year"


@query(f"SELECT l.ref_year, l.live, COALESCE(r.revised, 0) AS revised, COALESCE(r.revised, 0) > 0.09 * l.live AS tripped FROM ({LIVE}) l LEFT JOIN ({REVISED}) r ON l.ref_year = r.ref_year")
def mass_change_breaker(t: Tables):
    """Whether a routine release revises more than 9 % of a year's live series: then its commit is aborted."""
    return diff.mass_change(t("wide_prev"), t("wide_cur"), KEY, MEASURES, ["ref_year"], 0.09)


@query(f"SELECT COALESCE(p.unit_key, c.unit_key) AS unit_key, COALESCE(p.ref_year, c.ref_year) AS ref_year, CASE WHEN p.unit_key IS NULL THEN 'right_only' WHEN c.unit_key IS NULL THEN 'left_only' ELSE 'differs' END AS difference FROM {JOINED} WHERE p.price IS DISTINCT FROM c.price OR p.customer IS DISTINCT FROM c.customer OR p.footnote IS DISTINCT FROM c.footnote")
def replay_rows(t: Tables):
    """The rows in which a replay and a fresh parse differ, found by descent into differing nodes of a hash tree alone."""
    return hashtree.differing_rows(t("wide_prev"), t("wide_cur"), KEY, ["customer", "price", "footnote"])


@query("SELECT unit_key, ref_year, CASE WHEN unit_key % 26 = 0 THEN 'reinstated' ELSE 'first_print' END AS change_kind FROM wide_cur WHERE unit_key % 13 = 0")
def reinstatement(t: Tables):
    """A key that comes back after a deletion is reinstated; the last recorded change tells."""
    new = diff.wide_diff(t("wide_prev"), t("wide_cur"), KEY, ["customer"]).where("change_kind = 'first_print'")
    last = t("orders").where("o_orderkey % 26 = 0").select(F.col("o_orderkey").alias("unit_key"), F.year("o_orderdate").cast("long").alias("ref_year"), F.lit("deleted").alias("change_kind"))
    return diff.reinstated(new, last, KEY).select(*KEY, "change_kind")


CELLS = "SELECT lpad(CAST(s_nationkey AS VARCHAR), 5, '0') || l_returnflag || p_brand AS unit_key, CAST(year(l_shipdate) AS BIGINT) AS ref_year, CAST(quarter(l_shipdate) AS BIGINT) AS q, COUNT(*) AS establishments, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS employment FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3"


@query(CELLS.replace("SUM(CAST(l_quantity AS DECIMAL(18,2)))", "CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE)"))
def composite_cells(t: Tables):
    """Cells under a composed key that keeps leading zeros; quantities are summed as decimals."""
    rows = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    # one row for each raw key: the key is composed after the aggregate, not row by row
    raw = ["s_nationkey", "l_returnflag", "p_brand"]
    cells = rows.groupBy(*raw, F.year("l_shipdate").cast("long").alias("ref_year"), F.quarter("l_shipdate").cast("long").alias("q")).agg(F.count("*").alias("establishments"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("employment"))
    unit = F.concat(F.lpad(F.col("s_nationkey").cast("string"), 5, "0"), "l_returnflag", "p_brand").alias("unit_key")
    return cells.select(unit, "ref_year", "q", "establishments", "employment")


NEWEST, MARKED = 12, "ref_year >= 1995 AND vintage >= 6"
_row = "unit_key, ref_year, vintage, price, customer, footnote"
_steps = f"""SELECT k.unit_key, k.ref_year, k.vintage, c.unit_key AS c_in, p.unit_key AS p_in, c.price AS c_price, p.price AS p_price, c.customer AS c_customer, p.customer AS p_customer, c.footnote AS cf, p.footnote AS pf, k.first < k.vintage AS known
    FROM (SELECT unit_key, ref_year, first, unnest(range(1, {NEWEST + 1})) AS vintage FROM (SELECT unit_key, ref_year, min(vintage) AS first FROM wide_vintages GROUP BY unit_key, ref_year)) k
    LEFT JOIN wide_vintages c ON c.unit_key = k.unit_key AND c.ref_year = k.ref_year AND c.vintage = k.vintage
    LEFT JOIN (SELECT w.*, n.vintage AS at FROM wide_vintages w JOIN (SELECT unit_key, ref_year, v AS vintage, CASE WHEN ref_year = 1996 THEN (SELECT max(x.vintage) FROM wide_vintages x WHERE x.unit_key = y.unit_key AND x.ref_year = y.ref_year AND x.vintage < v) ELSE v - 1 END AS before
        FROM (SELECT DISTINCT unit_key, ref_year FROM wide_vintages) y, range(1, {NEWEST + 1}) r(v)) n ON w.unit_key = n.unit_key AND w.ref_year = n.ref_year AND w.vintage = n.before) p ON p.unit_key = k.unit_key AND p.ref_year = k.ref_year AND p.at = k.vintage
    WHERE c.unit_key IS NOT NULL OR (p.unit_key IS NOT NULL AND k.ref_year <> 1996)"""
_step_kind = f"CASE WHEN p_in IS NULL AND known THEN 'reinstated' WHEN p_in IS NULL THEN 'first_print' WHEN c_in IS NULL THEN 'deleted' WHEN p IS NOT NULL AND c IS NULL THEN 'suppressed' WHEN p IS NULL AND c IS NOT NULL THEN 'unsuppressed' WHEN p <> c AND {MARKED} AND round(p) = round(c) THEN 'precision_only' WHEN p <> c THEN 'revised' WHEN pf IS DISTINCT FROM cf THEN 'footnote_only' END"
VINTAGE_LOG = f"SELECT unit_key, ref_year, CAST(vintage AS BIGINT) AS vintage, measure, c AS value, p AS prev_value, {_step_kind} AS change_kind FROM (" + " UNION ALL ".join(f"SELECT unit_key, ref_year, vintage, '{m}' AS measure, c_{m} AS c, p_{m} AS p, c_in, p_in, cf, pf, known FROM ({_steps})" for m in MEASURES) + f") WHERE {_step_kind} IS NOT NULL"


@query(VINTAGE_LOG)
def vintage_log(t: Tables):
    """The change log of twelve vintages in one pass; its twin compares each vintage with the state before it. Keys of 1996 lie
    out of scope and are never deleted."""
    return diff.change_log(t("wide_vintages"), KEY, "vintage", MEASURES, F.lit(NEWEST), scope=F.col("ref_year") != 1996, footnote="footnote", precision=(F.expr(MARKED), 0))


@query(f"SELECT change_kind, CAST(vintage AS BIGINT) AS vintage, COUNT(*) AS n FROM ({VINTAGE_LOG}) GROUP BY change_kind, vintage")
def vintage_kinds(t: Tables):
    """How much of each kind every vintage brought: all eight kinds occur."""
    return vintage_log(t).groupBy("change_kind", "vintage").agg(F.count("*").alias("n"))


_vint = "SELECT url, artifact, CAST(artifact % 11 AS STRING) AS program, content_hash AS h, requested_at, row_number() OVER (ORDER BY requested_at, request_id) AS sequence, row_number() OVER (PARTITION BY url ORDER BY requested_at, request_id) AS vintage FROM fetch_log WHERE outcome = 'new_bytes'"
_slots = "SELECT DISTINCT CAST(artifact % 11 AS STRING) || '/' || CAST(CAST(requested_at AS DATE) AS STRING) AS slot_id, CAST(artifact % 11 AS STRING) AS program, CAST(CAST(requested_at AS DATE) AS TIMESTAMP) + INTERVAL 8 HOUR AS scheduled_at, CASE WHEN artifact % 11 < 6 THEN 'ics' ELSE 'cadence_estimate' END AS scheduled_at_source, CAST(NULL AS DATE) AS notice_date FROM fetch_log WHERE day(requested_at) % 9 = 0"


@query(f"""WITH v AS ({_vint}), s AS ({_slots}),
    e AS (SELECT v.*, s.slot_id, CASE WHEN s.scheduled_at_source = 'ics' AND v.requested_at <= s.scheduled_at + INTERVAL 30 MINUTE THEN s.scheduled_at END AS used FROM v LEFT JOIN s ON s.slot_id = (SELECT arg_min(x.slot_id, (abs(CAST(x.scheduled_at AS DATE) - CAST(v.requested_at AS DATE)), x.slot_id)) FROM s x WHERE x.program = v.program AND abs(CAST(x.scheduled_at AS DATE) - CAST(v.requested_at AS DATE)) <= 3)),
    g AS (SELECT e.*, k, substr(h, k, 1) < 'c' AS here, CASE WHEN substr(h, k, 1) < 'c' AND substr(h, k + 4, 1) <> '0' THEN CAST(instr('0123456789abcdef', substr(h, k + 4, 1)) AS DOUBLE) END AS val FROM e, range(1, 5) r(k)),
    p AS (SELECT *, coalesce(lag(here) OVER q, FALSE) AS was, lag(val) OVER q AS prev, coalesce(bool_or(here) OVER (PARTITION BY url, k ORDER BY vintage ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS ever FROM g WINDOW q AS (PARTITION BY url, k ORDER BY vintage)),
    c AS (SELECT *, CASE WHEN here AND NOT was THEN CASE WHEN ever THEN 'reinstated' ELSE 'first_print' END WHEN was AND NOT here THEN 'deleted' WHEN here AND prev IS NOT NULL AND val IS NULL THEN 'suppressed' WHEN here AND prev IS NULL AND val IS NOT NULL THEN 'unsuppressed' WHEN here AND prev <> val THEN 'revised' END AS change_kind FROM p)
    SELECT program, url || '#' || CAST(k AS STRING) AS unit_key, val AS value, change_kind, CAST(epoch_us(coalesce(used, requested_at)) AS BIGINT) AS known_at, CASE WHEN used IS NULL THEN 'observed' ELSE 'scheduled' END AS knowledge_time_source, CAST(vintage AS BIGINT) AS vintage
    FROM c WHERE change_kind IS NOT NULL AND (slot_id IS NOT NULL OR program <> '3') QUALIFY row_number() OVER (PARTITION BY url, k ORDER BY coalesce(used, requested_at) DESC, sequence DESC) = 1""")
def rebuilt_state(t: Tables):
    """Current state, rebuilt from the log alone: vintages, slots, events, the differ over all vintages, what was committed."""
    log = t("fetch_log").withColumn("program", (F.col("artifact") % 11).cast("string"))
    slots = log.where("day(requested_at) % 9 = 0").select("program", F.col("requested_at").cast("date").alias("d"), F.col("artifact") % 11 < 6).toDF("program", "d", "ics").distinct()
    slots = slots.select(F.concat_ws("/", "program", F.col("d").cast("string")).alias("slot_id"), "program", (F.col("d").cast("timestamp_ntz") + F.expr("INTERVAL 8 HOURS")).alias("scheduled_at"), F.when(F.col("ics"), "ics").otherwise("cadence_estimate").alias("scheduled_at_source"), F.lit(None).cast("date").alias("notice_date"))

    def parse(vintages):
        cell = lambda k: F.substring("content_hash", k, 1)
        rows = F.array(*(F.struct(F.lit(k).alias("k"), cell(k).alias("here"), F.when(cell(k + 4) != "0", F.instr(F.lit("0123456789abcdef"), cell(k + 4))).cast("double").alias("val")) for k in range(1, 5)))
        found = vintages.select("file_vintage_id", "program", "url", F.explode(rows).alias("r")).where("r.here < 'c'")
        return found.select("file_vintage_id", "program", F.concat("url", F.lit("#"), F.col("r.k").cast("string")).alias("unit_key"), F.lit("2024-01-01").cast("date").alias("ref_date"), F.lit("A01").alias("period_code"), F.col("r.val").alias("val"))

    tables = ledger.rebuild(log, parse, ["val"], lambda events: events.where("slot_id IS NOT NULL OR program <> '3'"), scope=F.lit(True), slots=slots)
    return tables["current_state"].select("program", "unit_key", "value", "change_kind", F.unix_micros(F.col("knowledge_time").cast("timestamp")).alias("known_at"), "knowledge_time_source", "vintage")


CAPTURED = f"SELECT DISTINCT lang AS link_set, link, v AS vintage FROM (SELECT page_id, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS lang, unnest(regexp_extract_all(html, 'href=\"([^\"?]+)\"', 1)) AS link FROM pages) CROSS JOIN range(1, 9) r(v) WHERE (page_id + v) % 5 <> 0 AND page_id % 11 <> v"


def _captures(t: Tables, vintages=range(1, 9)):
    """Eight captures of the landing pages, in each of which some pages were out of reach."""
    link = F.explode(F.regexp_extract_all("html", F.lit('href="([^"?]+)"'), F.lit(1)))
    found = t("pages").select("page_id", F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("link_set"), link.alias("link"))
    rows = found.withColumn("vintage", F.explode(F.array(*(F.lit(v).cast("long") for v in vintages))))
    return rows.where("(page_id + vintage) % 5 <> 0 AND page_id % 11 <> vintage").select("link_set", "link", "vintage")


HELD = f"SELECT link_set, link, MIN(vintage) AS first, MAX(vintage) AS last FROM (SELECT *, vintage - row_number() OVER (PARTITION BY link_set, link ORDER BY vintage) AS run FROM ({CAPTURED})) GROUP BY link_set, link, run"


@query(HELD)
def link_intervals(t: Tables):
    """Link sets by vintage: when each link was there, over all captures."""
    return links.intervals(_captures(t), ["link_set"], "link")


@query(HELD, name="link_advance")
def link_advance(t: Tables):
    """The same from the intervals of seven captures and the eighth alone."""
    held = links.intervals(_captures(t, range(1, 8)), ["link_set"], "link")
    return links.advanced(held, _captures(t, [8]), ["link_set"], "link", 8)


@query(f"WITH c AS ({CAPTURED}) (SELECT link_set, link, 'added' AS change FROM (SELECT link_set, link FROM c WHERE vintage = 6 EXCEPT SELECT link_set, link FROM c WHERE vintage = 3)) UNION ALL (SELECT link_set, link, 'removed' AS change FROM (SELECT link_set, link FROM c WHERE vintage = 3 EXCEPT SELECT link_set, link FROM c WHERE vintage = 6))")
def link_changes(t: Tables):
    """Links gained and lost between two vintages, read from the intervals."""
    return links.between(links.intervals(_captures(t), ["link_set"], "link"), ["link_set"], "link", 3, 6)
