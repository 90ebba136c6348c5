"""Queries on pages, codes and other text."""

from __future__ import annotations

from pyspark.sql import functions as F

from vintora.functions import text as fn
from vintora.plans.registry import Tables, query

HREFS = "SELECT page_id, regexp_extract_all(html, '(?i)href=\"([^\"?]+)\"', 1) AS hrefs FROM pages"


@query(f"SELECT page_id, name, MIN(pos) AS pos FROM (SELECT page_id, unnest(list_transform(hrefs, lambda x: list_last(string_split(rtrim(x, '/'), '/')))) AS name, CAST(unnest(range(0, len(hrefs))) AS BIGINT) AS pos FROM ({HREFS})) WHERE starts_with(name, 't') GROUP BY page_id, name")
def listing_links(t: Tables):
    """Names in a listing with a prefix, each where it stands first."""
    return fn.listing(t("pages"), "page_id", "html", "t")


@query("SELECT page_id, unnest(list_distinct(list_transform(list_filter(h, lambda x: contains(x, '/feed/') AND ends_with(x, '.rss')), lambda x: CASE WHEN starts_with(x, 'http') THEN x ELSE 'https://files.example' || x END))) AS url FROM (SELECT page_id, regexp_extract_all(replace(html, 'href=\"/the', 'href=\"/feed/the.rss\" x=\"'), '(?i)href=\"([^\"?]+)\"', 1) AS h FROM pages)")
def feed_links(t: Tables):
    pages = t("pages").withColumn("html", F.replace("html", F.lit('href="/the'), F.lit('href="/feed/the.rss" x="')))
    return fn.feeds(pages, "page_id", "html", "https://files.example")


@query("SELECT page_id, regexp_extract(url, '^https?://([^/?]+)', 1) AS host, regexp_extract(url, '^https?://[^/?]+([^?]*)', 1) AS path FROM pages")
def url_parts(t: Tables):
    return t("pages").select("page_id", F.regexp_extract("url", "^https?://([^/?]+)", 1).alias("host"), F.regexp_extract("url", "^https?://[^/?]+([^?]*)", 1).alias("path"))


@query("SELECT page_id, CASE WHEN contains(lower(html), 'class=\"ad\"') AND page_id % 3 = 0 THEN 'blocked' WHEN contains(lower(html), '<article>') THEN 'passed' ELSE 'other' END AS outcome FROM pages")
def page_outcome(t: Tables):
    signature = F.contains(F.lower("html"), F.lit('class="ad"')) & (F.col("page_id") % 3 == 0)
    return t("pages").select("page_id", F.when(signature, "blocked").when(F.contains(F.lower("html"), F.lit("<article>")), "passed").otherwise("other").alias("outcome"))


@query("SELECT p_partkey, trim(code) AS code, TRY_CAST(trim(raw) AS DOUBLE) AS value FROM (SELECT p_partkey, '  ' || lpad(CAST(p_size AS VARCHAR), 5, '0') || '   ' AS code, CASE WHEN p_partkey % 9 = 0 THEN ' - ' ELSE '  ' || CAST(p_size AS VARCHAR) || ' ' END AS raw FROM part)")
def labstat_strip(t: Tables):
    """Padded codes and values: codes keep their zeros, what isn't a number is null."""
    code = F.concat(F.lit("  "), F.lpad(F.col("p_size").cast("string"), 5, "0"), F.lit("   "))
    raw = F.when(F.col("p_partkey") % 9 == 0, " - ").otherwise(F.concat(F.lit("  "), F.col("p_size").cast("string"), F.lit(" ")))
    return t("part").select("p_partkey", F.trim(code).alias("code"), fn.number(raw).alias("value"))


@query("SELECT s_suppkey, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS area FROM supplier")
def code_preserve(t: Tables):
    return t("supplier").select("s_suppkey", F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("area"))


@query("SELECT DISTINCT l_suppkey, lpad(CAST(l_suppkey AS VARCHAR), 5, '0') || '|' || l_returnflag || '|' || COALESCE(CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE CAST(l_partkey % 3 AS VARCHAR) END, '~') AS unit_key FROM lineitem")
def unit_key_compose(t: Tables):
    third = F.when(F.col("l_partkey") % 4 != 0, (F.col("l_partkey") % 3).cast("string"))
    return t("lineitem").select("l_suppkey", fn.composed(F.lpad(F.col("l_suppkey").cast("string"), 5, "0"), F.col("l_returnflag"), third).alias("unit_key")).distinct()


@query("SELECT event_id, 'etag=' || regexp_extract(props, '[0-9]+', 0) || ';server=' || event_type AS headers FROM events")
def header_norm(t: Tables):
    """Header names in lower case, values as they are."""
    given = F.create_map(F.lit("ETag"), F.regexp_extract("props", "[0-9]+", 0), F.lit("Server"), F.col("event_type"))
    low = F.transform_keys(given, lambda k, _: F.lower(k))
    return t("events").select("event_id", F.array_join(F.transform(F.array_sort(F.map_entries(low)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("headers"))


STAMPS = "SELECT o_orderkey, '/archives/empsit_' || strftime(o_orderdate, '%m%d%Y') || '.htm' AS href FROM orders"


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS released FROM orders")
def href_release_date(t: Tables):
    """The release date an archive address carries as MMDDYYYY."""
    href = F.concat(F.lit("/archives/empsit_"), F.date_format("o_orderdate", "MMddyyyy"), F.lit(".htm"))
    return t("orders").select("o_orderkey", fn.href_date(href).cast("string").alias("released"))


@query("SELECT o_orderkey, CAST(CAST(date_trunc('month', CAST(o_orderdate AS DATE) - CAST(day(o_orderdate) AS INT)) AS DATE) AS VARCHAR) AS ref_date FROM orders")
def title_period(t: Tables):
    """The reference month a title names; its year follows from the release date, since titles may lack it."""
    month = F.date_format(F.add_months("o_orderdate", -1), "MMMM")
    return t("orders").select("o_orderkey", fn.title_month(F.concat(F.lit("Situation for "), month), F.col("o_orderdate").cast("date")).cast("string").alias("ref_date"))


@query("SELECT conv_id, COUNT(*) AS n_points, COUNT(*) FILTER (WHERE role = 'user') AS n_series, COUNT(*) > 0 AND COUNT(*) FILTER (WHERE role = 'user') > 0 AS success FROM conversations GROUP BY conv_id")
def api_verdict(t: Tables):
    """Whether a payload holds series and points: the payload decides, not the status."""
    found = t("conversations").groupBy("conv_id").agg(F.count("*").alias("n_points"), F.count_if(F.col("role") == "user").alias("n_series"))
    return found.withColumn("success", (F.col("n_points") > 0) & (F.col("n_series") > 0))


@query("SELECT conv_id, turn, CAST(CASE WHEN turn % 4 = 3 THEN 0 ELSE turn % 4 + 1 END AS INT) AS n_series, CAST(CASE WHEN turn % 4 = 3 THEN 0 ELSE (turn % 4 + 1) * (turn % 3) END AS INT) AS n_points, turn % 4 <> 3 AND turn % 3 > 0 AS success FROM conversations")
def api_payload(t: Tables):
    """Answers of an API, some without series and some without points, whatever their status says."""
    from vintora.sources.files import api_payload as parsed

    point = F.lit('{"value":"1"}')
    data = F.array_join(F.slice(F.array(point, point), F.lit(1), (F.col("turn") % 3).cast("int")), ",")
    one = F.concat(F.lit('{"seriesID":"x","data":['), data, F.lit("]}"))
    series = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("turn") % 4), lambda k: one), ",")
    payload = F.when(F.col("turn") % 4 == 3, '{"status":"REQUEST_SUCCEEDED","Results":{}}').otherwise(F.concat(F.lit('{"status":"REQUEST_SUCCEEDED","Results":{"series":['), series, F.lit("]}}")))
    return parsed(t("conversations").select("conv_id", "turn", payload.alias("payload"))).select("conv_id", "turn", "n_series", "n_points", "success")


@query("SELECT page_id, CAST(strlen(html) AS BIGINT) AS n_bytes, CAST(len(html) - len(replace(html, chr(10), '')) AS BIGINT) AS n_lines FROM pages")
def member_measure(t: Tables):
    """Size and lines of each member of an archive."""
    return t("pages").select("page_id", F.octet_length("html").cast("long").alias("n_bytes"), F.regexp_count("html", F.lit("\n")).cast("long").alias("n_lines"))
