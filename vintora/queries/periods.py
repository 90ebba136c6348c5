"""Queries on reference periods and footprints."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintora.operators import periods
from vintora.plans.registry import Tables, query

PROGRAMS = list(periods.STEP)
_table = ", ".join(f"('{p}', '{k}', {m}, '{s}', {periods.STEP[p]}, '{a[0]}', {12 * a[1] + a[2]}, '{b[0]}', {12 * b[1] + b[2]})" for p, k, m, season, a, b in periods.RULES for s in (("nsa", "sa") if season == "both" else (season,)))
_names = "CASE o_custkey % 11 " + " ".join(f"WHEN {n} THEN '{p}'" for n, p in enumerate(PROGRAMS)) + " END"
_step = "CASE o_custkey % 11 " + " ".join(f"WHEN {n} THEN {s}" for n, s in enumerate(periods.STEP.values())) + " END"
RELEASES = f"SELECT DISTINCT {_names} AS program, CAST(make_date(year(o_orderdate), 1 + (month(o_orderdate) - 1) // ({_step}) * ({_step}), 1) AS DATE) AS t_max FROM orders"
_at = "date_trunc('month', CASE {f} WHEN 't' THEN r.t_max ELSE make_date(year(r.t_max), 1, 1) END) + {n} * INTERVAL 1 MONTH"
FOOT = f"""SELECT DISTINCT program, t_max, kind, seasonality, CAST(unnest(generate_series(lo_at, hi_at, step * INTERVAL 1 MONTH)) AS DATE) AS ref_date FROM (SELECT r.program, r.t_max, d.kind, d.seasonality, d.step, {_at.format(f='d.lo_from', n='d.lo')} AS lo_at, {_at.format(f='d.hi_from', n='d.hi')} AS hi_at
    FROM ({RELEASES}) r JOIN (VALUES {_table}) d(program, kind, month, seasonality, step, lo_from, lo, hi_from, hi) ON r.program = d.program AND (d.month = 0 OR d.month = month(r.t_max)))"""


def releases(t: Tables):
    """Releases by program and newest period, from orders."""
    n = F.col("o_custkey") % 11
    table = t.spark.createDataFrame([(k, p, s) for k, (p, s) in enumerate(periods.STEP.items())], "n long, program string, step int")
    rows = t("orders").select(n.alias("n"), "o_orderdate").join(table, "n")
    month = 1 + F.floor((F.month("o_orderdate") - 1) / F.col("step")) * F.col("step")
    return rows.select("program", F.make_date(F.year("o_orderdate"), month.cast("int"), F.lit(1)).alias("t_max")).distinct()


def _foot(t: Tables):
    return periods.footprint(releases(t), periods.rules(t.spark))


def text(*names: str):
    return [F.col(n).cast("string").alias(n) for n in names]


DATES = "CAST(t_max AS VARCHAR) AS t_max, CAST(ref_date AS VARCHAR) AS ref_date"


@query(f"SELECT program, kind, seasonality, {DATES} FROM ({FOOT})")
def footprint_union(t: Tables):
    return _foot(t).select("program", "kind", "seasonality", *text("t_max", "ref_date"))


@query(f"SELECT program, seasonality, CAST(ref_date AS VARCHAR) AS ref_date, COUNT(DISTINCT t_max) AS prints, CAST(MIN(t_max) AS VARCHAR) AS first_release, CAST(MAX(t_max) AS VARCHAR) AS last_release FROM ({FOOT}) WHERE kind <> 'annual_average' GROUP BY program, seasonality, ref_date")
def prints_of(t: Tables):
    return periods.prints_of(_foot(t)).select("program", "seasonality", *text("ref_date"), "prints", *text("first_release", "last_release"))


_forward = f"SELECT DISTINCT program, t_max, ref_date FROM ({FOOT}) WHERE kind = 'routine' AND program IN ('ces-n', 'sae', 'jolts', 'cps-ln')"
_falsified = f"SELECT program, t_max, CAST(CASE WHEN month(t_max) = 6 AND t_max <> ref_date THEN ref_date - INTERVAL 2 MONTH ELSE ref_date END AS DATE) AS ref_date FROM ({_forward})"
_inverse = f"SELECT DISTINCT p.program, r.t_max, p.ref_date FROM ({_forward}) p JOIN (VALUES ('ces-n', 2), ('sae', 1), ('jolts', 1), ('cps-ln', 0)) n(program, reach) ON p.program = n.program JOIN ({RELEASES}) r ON r.program = p.program AND date_diff('month', p.ref_date, r.t_max) BETWEEN 0 AND n.reach"


@query(f"SELECT program, {DATES} FROM ((SELECT * FROM ({_falsified}) EXCEPT SELECT * FROM ({_inverse})) UNION ALL (SELECT * FROM ({_inverse}) EXCEPT SELECT * FROM ({_falsified})))")
def footprint_duality(t: Tables):
    """Periods of routine monthly footprints that the inverse rule doesn't give, or the other way round.

    June's earlier periods are moved by two months on purpose; without that there are none.
    """
    monthly = ["ces-n", "sae", "jolts", "cps-ln"]
    reach = t.spark.createDataFrame([("ces-n", 2), ("sae", 1), ("jolts", 1), ("cps-ln", 0)], "program string, reach int")
    forward = _foot(t).where(F.col("program").isin(monthly) & (F.col("kind") == "routine")).select("program", "t_max", "ref_date").distinct()
    # the inverse: a period is printed by the releases of the next `reach` months; equality on exploded months
    refs = forward.select("program", "ref_date").distinct().join(reach, "program")
    later = refs.select("program", "ref_date", F.explode(F.expr("sequence(ref_date, add_months(ref_date, reach), interval 1 month)")).alias("t_max"))
    inverse = later.join(releases(t), ["program", "t_max"], "left_semi").select("program", "t_max", "ref_date")
    forward = forward.withColumn("ref_date", F.when((F.month("t_max") == 6) & (F.col("t_max") != F.col("ref_date")), F.add_months("ref_date", -2)).otherwise(F.col("ref_date"))).distinct()
    return forward.exceptAll(inverse).unionByName(inverse.exceptAll(forward)).select("program", *text("t_max", "ref_date"))


@query(f"SELECT program, {DATES}, k AS print, CASE WHEN program = 'ces-n' THEN CASE k WHEN 1 THEN 'first_prelim' WHEN 2 THEN 'second_prelim' ELSE 'third_final' END WHEN program IN ('sae', 'jolts') THEN CASE k WHEN 1 THEN 'preliminary' ELSE 'final' END WHEN program IN ('cps-ln', 'bed', 'eci', 'ecec', 'jolts-state', 'qcew') THEN 'unknown' ELSE 'vintage' END AS stage FROM (SELECT program, t_max, ref_date, CAST(date_diff('month', ref_date, t_max) // CASE program WHEN 'x' THEN 0 {' '.join(f'''WHEN '{p}' THEN {s}''' for p, s in periods.STEP.items())} END AS BIGINT) + 1 AS k FROM (SELECT DISTINCT program, t_max, ref_date FROM ({FOOT}) WHERE kind IN ('routine', 'new_vintage', 'full_data')))")
def publication_stage(t: Tables):
    """Stage of each printed period by its distance from the newest; programs without named stages are `unknown`."""
    rows = _foot(t).where(F.col("kind").isin("routine", "new_vintage", "full_data")).select("program", "t_max", "ref_date").distinct()
    steps = t.spark.createDataFrame(list(periods.STEP.items()), "program string, step int")
    months = (F.year("t_max") - F.year("ref_date")) * 12 + F.month("t_max") - F.month("ref_date")
    rows = rows.join(steps, "program").withColumn("print", F.floor(months / F.col("step")) + 1)
    names = {p: s for p, s in periods.STAGES.items() if p != "cps-ln"}
    stage = F.lit("unknown")
    for p, s in names.items():
        stage = F.when(F.col("program") == p, F.coalesce(F.get(F.array(*map(F.lit, s)), F.least(F.col("print"), F.lit(len(s))).cast("int") - 1), F.lit("unknown"))).otherwise(stage)
    return rows.select("program", *text("t_max", "ref_date"), "print", stage.alias("stage"))


OBSERVED = "SELECT release_event_id, program, COUNT(DISTINCT ref_date) AS periods, CAST(MIN(ref_date) AS VARCHAR) AS first_period, CAST(MAX(ref_date) AS VARCHAR) AS last_period FROM obs GROUP BY release_event_id, program"


@query(OBSERVED)
def observed_footprint(t: Tables):
    found = t("obs").groupBy("release_event_id", "program").agg(F.count_distinct("ref_date").alias("periods"), F.min("ref_date").alias("first_period"), F.max("ref_date").alias("last_period"))
    return found.select("release_event_id", "program", "periods", *text("first_period", "last_period"))


@query("SELECT COALESCE(e.release_event_id, o.release_event_id) AS release_event_id, CAST(COALESCE(e.ref_date, o.ref_date) AS VARCHAR) AS ref_date, CASE WHEN e.release_event_id IS NULL THEN 'unexpected' ELSE 'missing' END AS divergence FROM (SELECT DISTINCT release_event_id, CAST(date_trunc('week', release_date) AS DATE) AS ref_date FROM committed) e FULL JOIN (SELECT DISTINCT release_event_id, CAST(ref_date - CAST(CASE WHEN sequence % 50 = 0 THEN 7 ELSE 0 END AS INT) AS DATE) AS ref_date FROM obs) o ON e.release_event_id = o.release_event_id AND e.ref_date = o.ref_date WHERE e.release_event_id IS NULL OR o.release_event_id IS NULL")
def footprint_divergence(t: Tables):
    """Periods a release was to touch and didn't, or touched unexpectedly: data, not an error."""
    key = ["release_event_id", "ref_date"]
    expected = t("committed").select("release_event_id", F.date_trunc("week", "release_date").cast("date").alias("ref_date")).distinct().withColumn("e", F.lit(1))
    seen = t("obs").select("release_event_id", F.when(F.col("sequence") % 50 == 0, F.date_sub("ref_date", 7)).otherwise(F.col("ref_date")).alias("ref_date")).distinct().withColumn("o", F.lit(1))
    both = expected.join(seen, key, "full_outer").where("e IS NULL OR o IS NULL")
    return both.select("release_event_id", *text("ref_date"), F.when(F.col("e").isNull(), "unexpected").otherwise("missing").alias("divergence"))


@query(f"SELECT program, CAST(t_max AS VARCHAR) AS t_max, '{{\"lo\":\"' || CAST(MIN(ref_date) AS VARCHAR) || '\",\"hi\":\"' || CAST(MAX(ref_date) AS VARCHAR) || '\",\"n\":' || CAST(COUNT(DISTINCT ref_date) AS VARCHAR) || '}}' AS footprint FROM ({FOOT}) GROUP BY program, t_max")
def footprint_json(t: Tables):
    found = _foot(t).groupBy("program", "t_max").agg(F.min("ref_date").cast("string").alias("lo"), F.max("ref_date").cast("string").alias("hi"), F.count_distinct("ref_date").alias("n"))
    return found.select("program", *text("t_max"), F.to_json(F.struct("lo", "hi", "n")).alias("footprint"))


CODES = "SELECT event_id, CAST(2000 + event_id % 25 AS INT) AS y, CASE event_id % 4 WHEN 0 THEN 'M' || lpad(CAST(event_id // 4 % 13 + 1 AS VARCHAR), 2, '0') WHEN 1 THEN 'Q' || lpad(CAST(event_id // 4 % 5 + 1 AS VARCHAR), 2, '0') WHEN 2 THEN 'A01' ELSE '' END AS code, CASE WHEN event_id % 4 <> 3 THEN 'series' WHEN event_id % 8 = 3 THEN 'occupation' ELSE 'projection' END AS kind FROM events"


def _codes(t: Tables):
    e, n = F.col("event_id"), F.floor(F.col("event_id") / 4)
    two = lambda m: F.lpad((n % m + 1).cast("string"), 2, "0")
    code = F.when(e % 4 == 0, F.concat(F.lit("M"), two(13))).when(e % 4 == 1, F.concat(F.lit("Q"), two(5))).when(e % 4 == 2, "A01").otherwise("")
    kind = F.when(e % 4 != 3, "series").when(e % 8 == 3, "occupation").otherwise("projection")
    return t("events").select(e, (2000 + e % 25).cast("int").alias("y"), code.alias("code"), kind.alias("kind"))


@query(f"SELECT event_id, code, CAST(make_date(y, CASE WHEN kind = 'occupation' THEN 5 WHEN kind = 'projection' OR code IN ('M13', 'Q05', 'A01') THEN 1 WHEN code LIKE 'M%' THEN CAST(substr(code, 2) AS INT) ELSE 3 * CAST(substr(code, 2) AS INT) - 2 END, 1) AS VARCHAR) AS ref_date, CASE WHEN kind <> 'series' THEN 'vintage' WHEN code IN ('M13', 'Q05', 'A01') THEN 'annual_average' ELSE 'period' END AS period_kind FROM ({CODES})")
def ref_date_canon(t: Tables):
    rows = _codes(t).withColumn("ref_date", periods.canonical_date(F.col("y"), F.col("code"), F.col("kind")))
    return rows.select("event_id", "code", *text("ref_date"), periods.period_kind(F.col("code"), F.col("kind")).alias("period_kind"))


# stages that each program declares, by name
VOCABULARY = {"click": ("first_prelim", "second_prelim", "third_final"), "purchase": ("first_prelim", "final"), "signup": ("final",), "error": ("first_prelim", "second_prelim", "final")}
_declared = ", ".join(f"('{p}', '{x}')" for p, xs in VOCABULARY.items() for x in xs)
_counts = ", ".join(f"('{p}', {len(xs)})" for p, xs in VOCABULARY.items())


def _stages(t: Tables):
    """program, declared (array) of the programs with a vocabulary."""
    return F.broadcast(t.spark.createDataFrame([(p, list(x)) for p, x in VOCABULARY.items()], "program string, declared array<string>"))


@query("SELECT event_type AS program, list_sort(list_distinct(list(s))).array_to_string(',') AS outside FROM (SELECT event_type, CASE event_id %% 5 WHEN 0 THEN 'first_prelim' WHEN 1 THEN 'second_prelim' WHEN 2 THEN 'third_final' WHEN 3 THEN 'final' ELSE 'draft' END AS s FROM events WHERE event_type <> 'view') WHERE (event_type, s) NOT IN (VALUES %s) GROUP BY event_type" % _declared)
def stage_vocab(t: Tables):
    """Stage labels a program uses outside its declared vocabulary."""
    names = F.array(*map(F.lit, ("first_prelim", "second_prelim", "third_final", "final", "draft")))
    rows = t("events").where("event_type <> 'view'").select(F.col("event_type").alias("program"), F.get(names, (F.col("event_id") % 5).cast("int")).alias("s"))
    used = rows.groupBy("program").agg(F.collect_set("s").alias("used"))
    used, outside = used.join(_stages(t), "program"), F.array_except("used", "declared")
    return used.select("program", F.array_join(F.sort_array(outside), ",").alias("outside"))


@query(f"SELECT o.program, unit_key, CAST(ref_date AS VARCHAR) AS ref_date, COUNT(*) AS prints, s.n - 1 AS priors FROM obs o JOIN (VALUES {_counts}) s(program, n) ON o.program = s.program GROUP BY o.program, unit_key, ref_date, s.n HAVING COUNT(*) > s.n")
def stage_cardinality(t: Tables):
    """Periods printed more often than their program has stages: one new print and its N - 1 priors."""
    found = t("obs").groupBy("program", "unit_key", "ref_date").agg(F.count("*").alias("prints")).join(_stages(t), "program").where("prints > size(declared)")
    return found.select("program", "unit_key", *text("ref_date"), "prints", (F.size("declared") - 1).alias("priors"))


@query("SELECT program, unit_key, CAST(ref_date AS VARCHAR) AS ref_date, sequence FROM (SELECT *, row_number() OVER (PARTITION BY program, unit_key, ref_date ORDER BY knowledge_time, sequence) AS n, lag(value) OVER (PARTITION BY program, unit_key, ref_date ORDER BY knowledge_time, sequence) AS v FROM obs) o WHERE n > (SELECT s.n FROM (VALUES %s) s(program, n) WHERE s.program = o.program) AND value <> v" % _counts)
def stage_window(t: Tables):
    """Values that changed after their last stage."""
    order = Window.partitionBy("program", "unit_key", "ref_date").orderBy("knowledge_time", "sequence")
    rows = t("obs").withColumns({"n": F.row_number().over(order), "v": F.lag("value").over(order)}).join(_stages(t), "program").where("n > size(declared) AND value <> v")
    return rows.select("program", "unit_key", *text("ref_date"), "sequence")


_qcew = f"SELECT t_max, ref_date FROM ({FOOT}) WHERE program = 'qcew' AND kind <> 'annual_average'"


@query(f"SELECT CAST(ref_date AS VARCHAR) AS ref_date, COUNT(DISTINCT t_max) AS prints, CAST(6 - quarter(ref_date) AS BIGINT) AS allowed FROM (SELECT * FROM ({_qcew}) UNION ALL SELECT CAST(t_max + INTERVAL 120 MONTH AS DATE), ref_date FROM ({_qcew}) WHERE year(ref_date) % 3 = 0 AND t_max = ref_date) GROUP BY ref_date HAVING COUNT(DISTINCT t_max) > 6 - quarter(ref_date)")
def inv16_prints(t: Tables):
    """Quarters printed more often than five, four, three and two times; those of every third year get a print on purpose."""
    rows = _foot(t).where("program = 'qcew' AND kind <> 'annual_average'")
    more = rows.where("year(ref_date) % 3 = 0 AND t_max = ref_date").withColumn("t_max", F.add_months("t_max", 120))
    found = periods.prints_of(rows.unionByName(more)).withColumn("allowed", (6 - F.quarter("ref_date")).cast("long"))
    return found.where("prints > allowed").select(*text("ref_date"), "prints", "allowed")


_bounds = " OR ".join(f"({'TRUE' if p == 'all' else f'program = {chr(39)}{p}{chr(39)}'} AND kind = '{k}')" for p, k in sorted(periods.LOWER_BOUND))


@query(f"SELECT program, kind, seasonality, COUNT(*) AS periods, {_bounds} AS lower_bound FROM ({FOOT}) GROUP BY program, kind, seasonality")
def footprint_bounds(t: Tables):
    """Periods touched by kind, and whether that is all or a lower bound."""
    found = _foot(t).groupBy("program", "kind", "seasonality").agg(F.count("*").alias("periods"))
    return found.withColumn("lower_bound", periods.is_lower_bound(F.col("program"), F.col("kind")))


_events = "SELECT DISTINCT program, t_max, CASE month(t_max) WHEN 1 THEN 'correction' WHEN 7 THEN 'preliminary_benchmark' WHEN 4 THEN 'reweight' ELSE 'wage_refresh' END AS kind FROM (%s)" % RELEASES
_announced = ", ".join(f"('{p}', '{k}', {str(c).upper()}, '{r}')" for p, k, c, r in periods.ANNOUNCED)


@query(f"SELECT r.program, CAST(r.t_max AS VARCHAR) AS t_max, e.kind, a.expects_change, a.reach, {_bounds.replace('program', 'r.program').replace('kind', 'e.kind')} AS lower_bound FROM ({RELEASES}) r JOIN ({_events}) e ON r.program = e.program AND r.t_max = e.t_max JOIN (VALUES {_announced}) a(of_program, kind, expects_change, reach) ON a.kind = e.kind AND (a.of_program = 'all' OR a.of_program = r.program)")
def announced_kinds(t: Tables):
    """Kinds that only an announcement gives a release: they add to what its newest period implies."""
    rows = releases(t)
    kind = F.when(F.month("t_max") == 1, "correction").when(F.month("t_max") == 7, "preliminary_benchmark").when(F.month("t_max") == 4, "reweight").otherwise("wage_refresh")
    found = periods.announced(rows, rows.withColumn("kind", kind))
    return found.select("program", *text("t_max"), "kind", "expects_change", "reach", "lower_bound")


_reach = f"SELECT program, t_max, seasonality, ref_date, bool_or({_bounds}) AS lb FROM ({FOOT}) GROUP BY ALL"
_seen = f"SELECT program, t_max, seasonality, ref_date FROM ({_reach}) WHERE month(ref_date) % 5 <> 0 UNION SELECT program, t_max, seasonality, CAST(MIN(ref_date) - INTERVAL 12 MONTH AS DATE) FROM ({_reach}) GROUP BY program, t_max, seasonality"


@query(f"SELECT COALESCE(e.program, o.program) AS program, CAST(COALESCE(e.t_max, o.t_max) AS VARCHAR) AS t_max, COALESCE(e.seasonality, o.seasonality) AS seasonality, CAST(COALESCE(e.ref_date, o.ref_date) AS VARCHAR) AS ref_date, CASE WHEN e.program IS NULL THEN 'unexpected' ELSE 'missing' END AS divergence FROM ({_reach}) e FULL JOIN ({_seen}) o ON e.program = o.program AND e.t_max = o.t_max AND e.seasonality = o.seasonality AND e.ref_date = o.ref_date LEFT JOIN (SELECT program, t_max, seasonality, bool_or(lb) AS lb FROM ({_reach}) GROUP BY ALL) l ON l.program = COALESCE(e.program, o.program) AND l.t_max = COALESCE(e.t_max, o.t_max) AND l.seasonality = COALESCE(e.seasonality, o.seasonality) WHERE o.program IS NULL OR e.program IS NULL AND NOT COALESCE(l.lb, FALSE)")
def footprint_reach(t: Tables):
    """Divergences by seasonality; some periods are left out on purpose, and one a year before each footprint is added."""
    by = ["program", "t_max", "seasonality"]
    expected = _foot(t).withColumn("lower_bound", periods.is_lower_bound(F.col("program"), F.col("kind")))
    earlier = expected.groupBy(*by).agg(F.add_months(F.min("ref_date"), -12).alias("ref_date"))
    seen = expected.where("month(ref_date) % 5 <> 0").select(*by, "ref_date").unionByName(earlier)
    found = periods.divergence(expected, seen, by)
    return found.select("program", *text("t_max"), "seasonality", *text("ref_date"), "divergence")


# what orders say of each release: when it came, its bytes, whether it stood in the calendar, whether it came twice
_said = f"SELECT program, t_max, count(*) AS n, min(o_orderkey) AS k, max(o_orderkey) AS k2, max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) = 0 AS on_calendar FROM (SELECT *, {_names} AS program, CAST(make_date(year(o_orderdate), 1 + (month(o_orderdate) - 1) // ({_step}) * ({_step}), 1) AS DATE) AS t_max FROM orders) GROUP BY program, t_max"
EVENTS = f"""SELECT program || '@' || CAST(t_max AS STRING) || '/0' AS release_id, program, t_max, t_max AS released_at, md5(CAST(k AS STRING)) AS content_hash, on_calendar OR k % 2 = 0 AS on_calendar, CASE WHEN k % 3 = 0 THEN 'all' WHEN k % 3 = 1 THEN 'most' ELSE 'routine' END AS touched FROM ({_said})
    UNION ALL SELECT program || '@' || CAST(t_max AS STRING) || '/1', program, t_max, CAST(t_max + INTERVAL 9 DAY AS DATE), CASE WHEN k2 % 2 = 0 THEN md5(CAST(k AS STRING)) ELSE md5(CAST(k2 AS STRING)) END, FALSE, CASE WHEN k2 % 2 = 0 THEN 'none' ELSE 'history' END FROM ({_said}) WHERE k2 % 4 < 3 AND n > 1"""
TOUCHED = f"""SELECT e.release_id, f.seasonality, f.ref_date FROM ({EVENTS}) e JOIN ({FOOT}) f ON e.program = f.program AND e.t_max = f.t_max WHERE e.touched = 'all' OR (e.touched = 'most' AND month(f.ref_date) <> 7) OR (e.touched = 'routine' AND f.kind IN ('routine', 'new_vintage', 'full_data')) OR (e.touched = 'history' AND f.kind <> 'routine')
    UNION SELECT release_id, 'nsa', CAST(t_max - INTERVAL 40 YEAR AS DATE) FROM ({EVENTS}) WHERE touched = 'history'"""
NOTICED = f"SELECT DISTINCT r.program, r.t_max, n.kind FROM ({_said}) r JOIN (SELECT area, CASE notice_id % 11 WHEN 2 THEN 'correction' WHEN 3 THEN 'reweight' ELSE 'population_control' END AS kind, month(published) AS m FROM notices WHERE notice_id % 11 IN (2, 3, 5)) n ON n.area = r.k % 25 AND n.m = month(r.t_max)"
_kinds = f"""SELECT release_id, kind, count(*) AS expected, count(*) FILTER (WHERE seen) AS hit, count(*) FILTER (WHERE NOT base) AS beyond, count(*) FILTER (WHERE NOT base AND seen) AS beyond_hit FROM (
    SELECT e.release_id, f.kind, EXISTS (SELECT 1 FROM ({TOUCHED}) o WHERE o.release_id = e.release_id AND o.seasonality = f.seasonality AND o.ref_date = f.ref_date) AS seen,
        EXISTS (SELECT 1 FROM ({FOOT}) b WHERE b.program = f.program AND b.t_max = f.t_max AND b.seasonality = f.seasonality AND b.ref_date = f.ref_date AND b.kind IN ('routine', 'new_vintage', 'full_data')) AS base
    FROM ({EVENTS}) e JOIN ({FOOT}) f ON e.program = f.program AND e.t_max = f.t_max) GROUP BY release_id, kind"""
_in = lambda names: "(" + ", ".join(f"'{n}'" for n in names) + ")"
CLASSIFIED = f"""WITH ev AS MATERIALIZED ({EVENTS}), seen AS MATERIALIZED ({TOUCHED}), kinds AS MATERIALIZED ({_kinds}), told AS MATERIALIZED ({NOTICED}),
    r AS (SELECT *, lag(content_hash) OVER q AS hash_before, max(t_max) OVER (PARTITION BY program ORDER BY released_at, release_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest, row_number() OVER q AS n FROM ev WINDOW q AS (PARTITION BY program ORDER BY released_at, release_id)),
    s AS (SELECT release_id, count(*) AS n_observed FROM seen GROUP BY release_id),
    spare AS (SELECT release_id, count(*) AS spare FROM seen o WHERE NOT EXISTS (SELECT 1 FROM ev e JOIN ({FOOT}) f ON e.program = f.program AND e.t_max = f.t_max WHERE e.release_id = o.release_id AND f.seasonality = o.seasonality AND f.ref_date = o.ref_date) GROUP BY release_id),
    k AS (SELECT release_id, bool_or(kind IN ('routine', 'full_data') AND hit > 0 AND 100 * hit >= 80 * expected) AS routine, bool_or(kind = 'new_vintage' AND hit > 0 AND 100 * hit >= 80 * expected) AS vintage,
        list(kind) FILTER (WHERE kind NOT IN {_in(periods.PRIMARY)} AND beyond > 0 AND 100 * beyond_hit >= 80 * beyond) AS shown, sum(CASE WHEN kind NOT IN {_in(periods.PRIMARY)} AND NOT (beyond > 0 AND 100 * beyond_hit >= 80 * beyond) THEN beyond_hit ELSE 0 END) AS loose FROM kinds GROUP BY release_id),
    x AS (SELECT r.release_id, r.program, r.t_max, r.content_hash IS DISTINCT FROM r.hash_before AS changed, r.n, coalesce(s.n_observed, 0) AS n_observed, coalesce(r.t_max > r.newest, TRUE) AND r.on_calendar AS fresh, coalesce(k.routine, FALSE) AS routine, coalesce(k.vintage, FALSE) AS vintage, coalesce(k.shown, []) AS shown, coalesce(k.loose, 0) + coalesce(spare.spare, 0) AS loose,
        CASE WHEN r.content_hash IS DISTINCT FROM r.hash_before THEN coalesce((SELECT list(kind) FROM told t WHERE t.program = r.program AND t.t_max = r.t_max), []) ELSE [] END AS told
        FROM r LEFT JOIN s USING (release_id) LEFT JOIN k USING (release_id) LEFT JOIN spare USING (release_id)),
    y AS (SELECT *, CASE WHEN n = 1 THEN 'seed' WHEN n_observed = 0 AND NOT changed THEN 'unchanged_republication' WHEN fresh AND routine THEN 'routine' WHEN fresh AND vintage THEN 'new_vintage' ELSE 'out_of_cycle' END AS primary_kind FROM x)
    SELECT release_id, program, CAST(t_max AS VARCHAR) AS t_max, primary_kind, array_to_string(list_filter([{', '.join(f"'{k}'" for k in periods.SECONDARY)}], lambda z: list_contains(shown, z) OR list_contains(told, z)), ',') AS secondary_kinds,
        CASE WHEN loose > 0 AND NOT list_has_any(told, ['reweight', 'correction']) AND primary_kind <> 'seed' THEN 'unexplained_mutation' END AS finding FROM y"""


def _orders_by_release(t: Tables):
    n = F.col("o_custkey") % 11
    table = t.spark.createDataFrame([(k, p, s) for k, (p, s) in enumerate(periods.STEP.items())], "n long, program string, step int")
    month = 1 + F.floor((F.month("o_orderdate") - 1) / F.col("step")) * F.col("step")
    rows = t("orders").withColumn("n", n).join(table, "n").withColumn("t_max", F.make_date(F.year("o_orderdate"), month.cast("int"), F.lit(1)))
    return rows.groupBy("program", "t_max").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("k"), F.max("o_orderkey").alias("k2"), (F.max((F.col("o_orderstatus") == "P").cast("int")) == 0).alias("on_calendar"))


def release_events(t: Tables):
    """Releases as they came: some twice, with the same bytes or others, some without a calendar entry."""
    said = _orders_by_release(t)
    k, k2, name = F.col("k"), F.col("k2"), lambda n: F.concat("program", F.lit("@"), F.col("t_max").cast("string"), F.lit(f"/{n}"))
    bytes_of = lambda c: F.md5(c.cast("string"))
    once = said.select(name(0).alias("release_id"), "program", "t_max", F.col("t_max").alias("released_at"), bytes_of(k).alias("content_hash"), (F.col("on_calendar") | (k % 2 == 0)).alias("on_calendar"), F.when(k % 3 == 0, "all").when(k % 3 == 1, "most").otherwise("routine").alias("touched"))
    twice = said.where("k2 % 4 < 3 AND n > 1").select(name(1).alias("release_id"), "program", "t_max", F.date_add("t_max", 9).alias("released_at"), F.when(k2 % 2 == 0, bytes_of(k)).otherwise(bytes_of(k2)).alias("content_hash"), F.lit(False).alias("on_calendar"), F.when(k2 % 2 == 0, "none").otherwise("history").alias("touched"))
    return once.unionByName(twice)


def touched_periods(t: Tables, events):
    """What each release touched: all of its footprint, parts of it, or history nobody announced."""
    foot = _foot(t).join(events.select("release_id", "program", "t_max", "touched"), ["program", "t_max"])
    base = F.col("kind").isin(*periods.PRIMARY)
    how = F.col("touched")
    seen = foot.where((how == "all") | ((how == "most") & (F.month("ref_date") != 7)) | ((how == "routine") & base) | ((how == "history") & (F.col("kind") != "routine")))
    old = events.where("touched = 'history'").select("release_id", F.lit("nsa").alias("seasonality"), F.add_months("t_max", -480).alias("ref_date"))
    return seen.select("release_id", "seasonality", "ref_date").unionByName(old).distinct()


@query(CLASSIFIED)
def classified_releases(t: Tables):
    """Every release's primary and secondary kinds from observed periods, footprints, bytes, calendar and notices."""
    events = release_events(t)
    kind = F.when(F.col("notice_id") % 11 == 2, "correction").when(F.col("notice_id") % 11 == 3, "reweight").otherwise("population_control")
    told = t("notices").where("notice_id % 11 IN (2, 3, 5)").select(F.col("area").cast("long").alias("area"), kind.alias("kind"), F.month("published").alias("m")).distinct()
    noticed = _orders_by_release(t).withColumns({"area": F.col("k") % 25, "m": F.month("t_max")}).join(told, ["area", "m"]).select("program", "t_max", "kind").distinct()
    found = periods.classified(events, touched_periods(t, events), periods.rules(t.spark), noticed)
    return found.select("release_id", "program", *text("t_max"), "primary_kind", F.array_join("secondary_kinds", ",").alias("secondary_kinds"), "finding")
