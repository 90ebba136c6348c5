"""Deterministic views that give general tables the shape of a release ledger.

One text serves Spark and DuckDB. @ts(...) is a timestamp without zone in either.
"""

from __future__ import annotations

import re

#: The instant queries look from, and the first instant of observation.
CUT, T0 = "2024-01-20 00:00:00", "2024-01-05 00:00:00"


def for_spark(sql: str) -> str:
    return re.sub(r"@ts\(([^)]*)\)", r"TIMESTAMP_NTZ'\1'", sql)


def for_duckdb(sql: str) -> str:
    return re.sub(r"@ts\(([^)]*)\)", r"TIMESTAMP '\1'", sql)


VIEWS = {
    # the change log: one row for each published value of a key
    "obs": f"""
        SELECT event_type AS program, CAST(user_id AS STRING) AS unit_key, 'value' AS measure_code,
               CAST(date_trunc('week', ts) AS DATE) AS ref_date, 'W' || lpad(CAST(weekofyear(ts) AS STRING), 2, '0') AS period_code,
               CASE WHEN user_id % 17 = 0 THEN 'annual_average' ELSE 'period' END AS period_kind,
               event_id AS sequence, event_type || '-' || CAST(CAST(ts AS DATE) AS STRING) AS release_event_id, value,
               CASE WHEN event_id % 11 = 0 THEN 'deleted' ELSE 'revised' END AS change_kind,
               CASE WHEN ts < @ts({T0}) THEN CASE WHEN event_id % 3 = 0 THEN 'reconstructed' ELSE 'seed' END
                    WHEN event_id % 23 = 0 THEN 'external' ELSE 'observed' END AS provenance,
               CASE WHEN ts < @ts({T0}) AND event_id % 3 <> 0 THEN @ts({T0}) ELSE ts END AS knowledge_time
        FROM events""",
    # the first instant of observation of each program, and a log seeded at it
    "first_instants": "SELECT event_type AS program, MIN(ts) + CAST(length(event_type) AS INT) * INTERVAL 1 DAY AS first_instant FROM events GROUP BY event_type",
    "program_obs": """
        SELECT e.event_type AS program, CAST(e.user_id AS STRING) AS unit_key, 'value' AS measure_code, CAST(date_trunc('week', e.ts) AS DATE) AS ref_date,
               'W' || lpad(CAST(weekofyear(e.ts) AS STRING), 2, '0') AS period_code, e.event_id AS sequence,
               e.event_type || '-' || CAST(CAST(e.ts AS DATE) AS STRING) AS release_event_id, e.value,
               CASE WHEN e.event_id % 11 = 0 THEN 'deleted' ELSE 'revised' END AS change_kind,
               CASE WHEN e.ts >= f.first_instant THEN 'observed' WHEN e.event_id % 3 = 0 THEN 'reconstructed' ELSE 'seed' END AS provenance,
               CASE WHEN e.ts < f.first_instant AND e.event_id % 3 <> 0 AND e.user_id % 41 <> 0 THEN f.first_instant ELSE e.ts END AS knowledge_time
        FROM events e JOIN first_instants f ON e.event_type = f.program""",
    # assertions overridden by a named reason; one reason was left blank
    "overrides": "SELECT DISTINCT event_type || '-' || CAST(CAST(ts AS DATE) AS STRING) AS release_event_id, 'n5' AS rule, CASE WHEN event_type = 'click' THEN ' ' ELSE 'checked by hand' END AS reason FROM events WHERE day(ts) % 2 = 0",
    # manifest of committed releases
    "committed": "SELECT DISTINCT event_type || '-' || CAST(CAST(ts AS DATE) AS STRING) AS release_event_id, event_type AS program, CAST(ts AS DATE) AS release_date FROM events WHERE day(ts) % 7 <> 0",
    # two wide snapshots of one artifact
    "wide_prev": "SELECT o_orderkey AS unit_key, CAST(year(o_orderdate) AS BIGINT) AS ref_year, o_totalprice AS price, CAST(o_custkey AS DOUBLE) AS customer, o_orderpriority AS footnote FROM orders WHERE o_orderkey % 13 <> 0",
    "wide_cur": """
        SELECT o_orderkey AS unit_key, CAST(year(o_orderdate) AS BIGINT) AS ref_year,
               CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS price,
               CAST(o_custkey AS DOUBLE) AS customer, CASE WHEN o_orderkey % 19 = 0 THEN 'r' ELSE o_orderpriority END AS footnote
        FROM orders WHERE o_orderkey % 29 <> 0""",
    # twelve vintages of a wide artifact: keys come, go and return, values move, go missing and lose digits
    "wide_vintages": """
        SELECT o_orderkey AS unit_key, CAST(year(o_orderdate) AS BIGINT) AS ref_year, v AS vintage,
               CASE WHEN (o_orderkey + v) % 17 = 0 THEN NULL WHEN o_orderkey % 5 = 0 AND v >= 6 THEN round(o_totalprice + 0.3)
                    ELSE o_totalprice + 0.3 + CASE WHEN o_orderkey % 7 < v - 4 THEN 25 ELSE 0 END END AS price,
               CAST(o_custkey AS DOUBLE) AS customer, CASE WHEN (o_orderkey + v) % 19 = 0 THEN 'r' ELSE o_orderpriority END AS footnote
        FROM orders CROSS JOIN (SELECT 1 AS v UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5 UNION ALL SELECT 6 UNION ALL SELECT 7 UNION ALL SELECT 8 UNION ALL SELECT 9 UNION ALL SELECT 10 UNION ALL SELECT 11 UNION ALL SELECT 12) n
        WHERE v > o_orderkey % 4 AND o_orderkey % 13 <> v AND NOT (o_orderkey % 29 = 0 AND v > 8)""",
    # one record for each request of a capture run
    "fetch_log": """
        SELECT event_id AS request_id, 'https://files.example/u/' || CAST(user_id AS STRING) AS url, user_id AS artifact, ts AS requested_at,
               CASE event_type WHEN 'view' THEN 'unchanged' WHEN 'click' THEN 'restamp_only' WHEN 'purchase' THEN 'new_bytes' WHEN 'error' THEN 'error' ELSE 'blocked' END AS outcome,
               CASE event_type WHEN 'error' THEN 500 + event_id % 4 WHEN 'signup' THEN 403 ELSE 200 END AS status_code,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE regexp_extract(props, '[0-9]+', 0) END AS etag,
               CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS STRING) END AS last_modified,
               CASE WHEN event_type = 'purchase' THEN md5(regexp_extract(props, '[0-9]+', 0)) END AS content_hash
        FROM events""",
    # artifacts and the programs they serve
    "inventory": "SELECT DISTINCT user_id AS artifact, 'https://files.example/u/' || CAST(user_id AS STRING) AS url, CAST(user_id % 11 AS STRING) AS program, CASE WHEN user_id % 7 = 0 THEN 'html' ELSE 'flatfile' END AS profile, 'x' || CAST(user_id % 40 AS STRING) || '.data.' || CAST(user_id AS STRING) AS artifact_key FROM events",
    # expected releases: program and month, with three signals
    "slots": """
        SELECT o_custkey % 11 AS program, CAST(date_trunc('month', o_orderdate) AS DATE) AS occurrence,
               (o_custkey % 11 + month(CAST(date_trunc('month', MIN(o_orderdate)) AS DATE))) % 5 <> 0 AS cadence,
               MAX(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 7 < 3 THEN 1 ELSE 0 END) = 1 AS calendar,
               MAX(CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 = 0 THEN 1 ELSE 0 END) = 1 AS artifact,
               o_custkey % 11 <> 4 AS expects_change, MAX(CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END) = 1 AS noticed,
               MIN(o_orderkey) AS first_order
        FROM orders GROUP BY o_custkey % 11, CAST(date_trunc('month', o_orderdate) AS DATE)""",
    # calendar entries: dates near some slots
    "calendar": "SELECT o_orderkey AS entry_id, o_custkey % 11 AS program, CAST(o_orderdate AS DATE) AS entry_date FROM orders",
    # slots in every state; what matches asks for open ones
    "open_slots": "SELECT o_orderkey AS slot_id, o_custkey % 11 AS program, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INT) AS due, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN 'late' ELSE 'committed' END AS state FROM orders",
    # announced corrections, and changes nobody expected
    "errata": "SELECT o_orderkey AS row_key, o_custkey % 11 AS program, CAST(o_orderdate AS DATE) AS added, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Database' ELSE 'News release' END AS product_type, 'Corrections to be made on ' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/' || lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '/' || CAST(year(o_orderdate) AS STRING) AS correction_status FROM orders",
    "mutations": "SELECT DISTINCT l_orderkey * 10 + l_linenumber AS mutation_id, l_partkey % 11 AS program, CAST(l_shipdate AS DATE) AS seen FROM lineitem",
    # publication dates before observation began
    "knowability": """
        SELECT program, ref_date, news_date, CASE WHEN k % 7 = 0 THEN NULL WHEN ref_date < DATE '1998-01-01' THEN news_date + INTERVAL 14 DAY ELSE CAST(news_date AS TIMESTAMP) END AS data_at
        FROM (SELECT o_custkey % 11 AS program, CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_date, MIN(CAST(o_orderdate AS DATE)) AS news_date, MIN(o_orderkey) AS k
              FROM orders GROUP BY o_custkey % 11, CAST(date_trunc('month', o_orderdate) AS DATE)) x""",
    # periods with the day a monthly cadence expects, and the dates an archive lists: some late by weeks, lacking or twice
    "cadence_periods": "SELECT DISTINCT o_custkey % 11 AS program, CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_date, CAST(date_trunc('month', o_orderdate) AS DATE) + CAST(40 AS INT) AS expected FROM orders",
    "archive_dates": """
        SELECT program, ref_date + CAST(40 + CASE WHEN k % 7 = 1 AND n = 0 THEN 14 WHEN n = 1 THEN 4 ELSE k % 3 END AS INT) AS release_date
        FROM (SELECT o_custkey % 11 AS program, CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_date, MIN(o_orderkey) AS k
              FROM orders GROUP BY o_custkey % 11, CAST(date_trunc('month', o_orderdate) AS DATE)) x CROSS JOIN (SELECT 0 AS n UNION ALL SELECT 1 AS n) y
        WHERE (n = 0 AND k % 7 <> 0) OR (n = 1 AND k % 7 = 2)""",
    # markers from notices, by scope, and series values before and after
    "markers": """
        SELECT notice_id AS marker_id, CAST(area % 11 AS BIGINT) AS program,
               CASE WHEN notice_id % 3 = 0 THEN '' WHEN notice_id % 3 = 1 THEN CAST(1 + notice_id % 9 AS STRING) ELSE CAST(10 + notice_id % 90 AS STRING) END AS prefix,
               CASE WHEN title LIKE '%weights%' THEN 'reweight' WHEN title LIKE '%decimals%' THEN 'precision_change' WHEN title LIKE '%population control%' THEN 'population_control'
                    WHEN title LIKE '%discontinued%' THEN 'discontinuation' WHEN title LIKE '%suspended%' THEN 'suspension' WHEN title LIKE '%resumed%' THEN 'resumption' ELSE 'other' END AS kind,
               published - CAST(9000 + notice_id % 7 * 300 AS INT) AS effective
        FROM notices""",
    "measured": """
        SELECT o_orderkey AS row_id, o_custkey % 11 AS program, CAST(o_custkey AS STRING) AS unit_key, CAST(o_orderdate AS DATE) AS ref_date, o_totalprice AS prev_value,
               CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN round(o_totalprice) WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 3 ELSE o_totalprice END AS value
        FROM orders""",
    # a roster of series and its next vintage
    "catalog_prev": "SELECT p_partkey AS series_id, p_name AS title, p_type AS code FROM part WHERE p_partkey % 31 <> 0",
    "catalog_cur": "SELECT p_partkey AS series_id, CASE WHEN p_partkey % 12 = 0 THEN p_name || ' (revised)' ELSE p_name END AS title, CASE WHEN p_partkey % 15 = 0 THEN 'RECODED' ELSE p_type END AS code FROM part WHERE p_partkey % 23 <> 0",
    # catalog rows by the release that brought them, and the releases that were committed
    "catalog_log": "SELECT p_partkey AS series_id, p_name AS title, 'catalog-' || CAST(p_size AS STRING) AS release_event_id FROM part",
    "catalog_committed": "SELECT DISTINCT 'catalog-' || CAST(p_size AS STRING) AS release_event_id FROM part WHERE p_size % 5 <> 0",
    # notices with prose titles
    "notices": """
        SELECT c_custkey AS notice_id, c_nationkey AS area, CAST(DATE '2024-01-01' + CAST(c_custkey % 300 AS INT) AS DATE) AS published,
               CASE c_custkey % 11 WHEN 0 THEN 'Release rescheduled to a new date' WHEN 1 THEN 'Release postponed until further notice' WHEN 2 THEN 'Correction to published data'
                    WHEN 3 THEN 'Fixed weights updated' WHEN 4 THEN 'Estimates now shown to three decimals' WHEN 5 THEN 'Annual population control adjustment'
                    WHEN 6 THEN 'Series discontinued' WHEN 7 THEN 'State data suspended' WHEN 8 THEN 'Publication resumed' WHEN 9 THEN 'Sample redesign' ELSE c_name END AS title
        FROM customer""",
    # releases with the four clocks
    "releases": """
        SELECT o_orderkey AS release_id, o_custkey % 11 AS program, o_orderdate AS first_observed_at,
               CASE WHEN o_orderkey % 3 = 0 THEN 'ics' WHEN o_orderkey % 3 = 1 THEN 'cadence_estimate' ELSE 'schedule_page' END AS scheduled_at_source,
               CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE o_orderdate + CAST(o_orderkey % 9 - 4 AS INT) * INTERVAL 10 MINUTE END AS scheduled_at,
               CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS DATE) END AS notice_date,
               CAST(month(o_orderdate) AS BIGINT) AS ref_month, CAST(year(o_orderdate) AS BIGINT) AS ref_year, o_totalprice AS value, o_orderkey % 13 AS k
        FROM orders""",
}
