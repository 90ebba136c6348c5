"""Queries on slots, clocks, notices and errata."""

from __future__ import annotations

from pyspark.sql import functions as F

from vintora.operators import control, markers, matching, slots
from vintora.plans.registry import Tables, query
from vintora.queries.asof import micros

SIGNAL = "CASE WHEN cadence AND calendar AND artifact THEN CASE WHEN expects_change THEN 'normal' ELSE 'unexpected_change' END WHEN cadence AND calendar THEN CASE WHEN expects_change THEN 'late' ELSE 'news_only' END WHEN cadence AND artifact THEN 'unannounced' WHEN cadence THEN 'predicted' WHEN calendar AND artifact THEN 'cadence_gap' WHEN calendar THEN 'registry_gap' WHEN artifact THEN 'silent_mutation' ELSE 'nothing' END"
SLOTS = f"SELECT *, {SIGNAL} AS signal FROM slots"
NOW = "2000-06-15"


def _slots(t: Tables):
    c = F.col
    return t("slots").withColumn("signal", control.three_signal(c("cadence"), c("calendar"), c("artifact"), c("expects_change")))


def day(c: str):
    return F.col(c).cast("string").alias(c)


@query(f"SELECT program, CAST(occurrence AS VARCHAR) AS occurrence, signal FROM ({SLOTS})")
def three_signal(t: Tables):
    return _slots(t).select("program", day("occurrence"), "signal")


@query(f"""SELECT COALESCE(a.program, b.program, c.program) AS program, CAST(COALESCE(a.occurrence, b.occurrence, c.occurrence) AS VARCHAR) AS occurrence, a.program IS NOT NULL AS cadence, b.program IS NOT NULL AS calendar, c.program IS NOT NULL AS artifact
    FROM (SELECT program, occurrence FROM slots WHERE cadence) a FULL JOIN (SELECT program, occurrence FROM slots WHERE calendar) b ON a.program = b.program AND a.occurrence = b.occurrence
    FULL JOIN (SELECT program, occurrence FROM slots WHERE artifact) c ON COALESCE(a.program, b.program) = c.program AND COALESCE(a.occurrence, b.occurrence) = c.occurrence""")
def signal_join(t: Tables):
    """The three signals as separate tables, joined on program and occurrence."""
    key = ["program", "occurrence"]
    one = lambda s: t("slots").where(s).select(*key, F.lit(True).alias(s))
    both = one("cadence").join(one("calendar"), key, "full_outer").join(one("artifact"), key, "full_outer")
    return both.select("program", day("occurrence"), *(F.coalesce(s, F.lit(False)).alias(s) for s in ("cadence", "calendar", "artifact")))


@query(f"SELECT program, CAST(occurrence AS VARCHAR) AS occurrence, CASE WHEN noticed AND signal = 'late' THEN 'rescheduled' WHEN noticed AND signal = 'cadence_gap' THEN 'classified_by_notice' WHEN noticed AND signal = 'silent_mutation' THEN 'correction' ELSE signal END AS action FROM ({SLOTS})")
def three_signal_notice(t: Tables):
    return _slots(t).select("program", day("occurrence"), control.with_notice(F.col("signal"), F.col("noticed")).alias("action"))


# a notice for every noticed slot, which names a new day in even months; what a person decided on late ones
NOTICED = f"SELECT *, CASE WHEN noticed THEN CASE WHEN program % 2 = 0 THEN 'reschedule' ELSE 'delay' END END AS notice, CASE WHEN noticed AND month(occurrence) % 2 = 0 THEN CAST(occurrence + CAST(400 + 400 * (program % 5) AS INT) AS DATE) END AS new_date, CASE WHEN program = 3 THEN 'cancelled' WHEN program = 7 THEN 'delayed' END AS triage FROM ({SLOTS})"


@query(f"""SELECT program, CAST(occurrence AS VARCHAR) AS occurrence, CASE WHEN signal IN ('normal', 'unexpected_change') THEN 'committed' WHEN signal = 'news_only' THEN 'news_only' WHEN signal IN ('unannounced', 'cadence_gap') THEN 'captured' WHEN signal = 'silent_mutation' THEN 'unscheduled'
    WHEN signal = 'late' AND notice = 'reschedule' AND new_date IS NOT NULL THEN CASE WHEN new_date > DATE '{NOW}' THEN 'scheduled' WHEN DATE '{NOW}' - new_date > 3 THEN 'late' ELSE 'watching' END
    WHEN signal = 'late' AND DATE '{NOW}' - occurrence > 3 THEN COALESCE(triage, CASE WHEN notice = 'delay' THEN 'delayed' END, 'late') WHEN signal = 'late' THEN CASE WHEN occurrence > DATE '{NOW}' THEN 'scheduled' ELSE 'watching' END WHEN signal = 'registry_gap' THEN 'scheduled' ELSE 'predicted' END AS state FROM ({NOTICED})""")
def slot_state(t: Tables):
    c, now = F.col, F.lit(NOW).cast("date")
    notice = F.when(c("noticed"), F.when(c("program") % 2 == 0, "reschedule").otherwise("delay"))
    new_date = F.when(c("noticed") & (F.month("occurrence") % 2 == 0), F.date_add("occurrence", (400 + 400 * (c("program") % 5)).cast("int")))
    triage = F.when(c("program") == 3, "cancelled").when(c("program") == 7, "delayed")
    return _slots(t).select("program", day("occurrence"), control.slot_state(c("signal"), c("occurrence"), now, notice=notice, new_date=new_date, triage=triage).alias("state"))


@query(f"SELECT program, CAST(occurrence AS VARCHAR) AS occurrence, CAST(new_date AS VARCHAR) AS new_date FROM ({NOTICED}) WHERE signal = 'late' AND notice = 'reschedule' AND new_date IS NOT NULL")
def slot_history(t: Tables):
    """Late slots whose day a notice moved: the slot stays, its day changes, and the change is written down."""
    c = F.col
    rows = _slots(t).where("signal = 'late' AND noticed AND program % 2 = 0 AND month(occurrence) % 2 = 0")
    return rows.select("program", day("occurrence"), F.date_add("occurrence", (400 + 400 * (c("program") % 5)).cast("int")).cast("string").alias("new_date"))


# events of slots: an order foretells its slot, its lines give it days, and say what became of it
SLOT_EVENTS = """SELECT o_orderkey AS slot_id, CAST(o_orderdate AS TIMESTAMP) - INTERVAL 20 DAY AS moment, 0 AS seq, 'predicted' AS kind, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 10 DAY AS due FROM orders
    UNION ALL SELECT l_orderkey, CAST(l_shipdate AS TIMESTAMP), l_linenumber, 'scheduled', CAST(l_shipdate AS TIMESTAMP) + CAST(4 + l_linenumber AS INT) * INTERVAL 1 DAY FROM lineitem
    UNION ALL SELECT l_orderkey, CAST(l_shipdate AS TIMESTAMP) + INTERVAL 20 DAY, 10 + l_linenumber, CASE CAST(round(l_tax * 100) AS INT) WHEN 0 THEN 'captured' WHEN 1 THEN 'captured' WHEN 2 THEN 'news_only' WHEN 3 THEN 'cancelled' ELSE 'delayed' END, NULL FROM lineitem WHERE l_returnflag <> 'N'
    UNION ALL SELECT l_orderkey, CAST(l_shipdate AS TIMESTAMP) + INTERVAL 22 DAY, 20 + l_linenumber, 'committed', NULL FROM lineitem WHERE l_returnflag = 'R' AND CAST(round(l_tax * 100) AS INT) = 0"""
LIFE_NOW = "1998-06-15"


@query(f"""WITH d AS (SELECT *, COALESCE(MAX(CAST(kind = 'captured' AS INT)) OVER (PARTITION BY slot_id ORDER BY moment, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken FROM ({SLOT_EVENTS}) WHERE moment <= TIMESTAMP '{LIFE_NOW}'),
    e AS (SELECT *, last_value(CASE WHEN taken = 0 THEN due END IGNORE NULLS) OVER (PARTITION BY slot_id ORDER BY moment, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS due_now FROM d),
    f AS (SELECT * FROM e WHERE kind IN ('committed', 'news_only') OR (taken = 0 AND (kind NOT IN ('delayed', 'cancelled') OR moment >= due_now + INTERVAL 3 DAY))),
    g AS (SELECT *, COALESCE(MAX(CAST(kind IN ('cancelled', 'committed', 'news_only') AS INT)) OVER (PARTITION BY slot_id ORDER BY moment, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS over_ FROM f)
    SELECT slot_id, CASE WHEN kind NOT IN ('predicted', 'scheduled') THEN kind WHEN TIMESTAMP '{LIFE_NOW}' >= due_now + INTERVAL 3 DAY THEN 'late' WHEN TIMESTAMP '{LIFE_NOW}' >= due_now - INTERVAL 5 MINUTE THEN 'watching' ELSE kind END AS state, CAST(CAST(due_now AS DATE) AS VARCHAR) AS due
    FROM g WHERE over_ = 0 QUALIFY row_number() OVER (PARTITION BY slot_id ORDER BY moment DESC, seq DESC) = 1""")
def slot_life(t: Tables):
    """State of each slot at an instant, from all its events; streaming.slots keeps the same with timers."""
    return slots.life(slot_events(t), F.lit(LIFE_NOW).cast("timestamp_ntz")).select("slot_id", "state", F.col("due").cast("date").cast("string").alias("due"))


def slot_events(t: Tables):
    at = lambda c, days=0: F.date_add(F.col(c).cast("date"), days).cast("timestamp_ntz")
    event = lambda when, seq, kind, due=F.lit(None).cast("timestamp_ntz"): F.struct(when.alias("at"), seq.cast("int").alias("seq"), kind.alias("kind"), due.alias("due"))
    tax, back, line = F.round(F.col("l_tax") * 100).cast("int"), F.col("l_returnflag"), F.col("l_linenumber").cast("int")
    outcome = F.when(tax <= 1, "captured").when(tax == 2, "news_only").when(tax == 3, "cancelled").otherwise("delayed")
    of_line = F.array(
        event(at("l_shipdate"), line, F.lit("scheduled"), at("l_shipdate", 4 + line)),
        F.when(back != "N", event(at("l_shipdate", 20), 10 + line, outcome)),
        F.when((back == "R") & (tax == 0), event(at("l_shipdate", 22), 20 + line, F.lit("committed"))),
    )
    lines = t("lineitem").select(F.col("l_orderkey").alias("slot_id"), F.inline(F.array_compact(of_line)))
    foretold = t("orders").select(F.col("o_orderkey").alias("slot_id"), at("o_orderdate", -20).alias("at"), F.lit(0).alias("seq"), F.lit("predicted").alias("kind"), at("o_orderdate", 10).alias("due"))
    return foretold.unionByName(lines)


TITLES = [("BUILDING", ("ces-n", "cps-ln")), ("MACHINERY", ("eci", "ecec")), ("FURNITURE", ("qcew",)), ("AUTOMOBILE", ("jolts", "jolts-state"))]
ENTRIES = "SELECT c_custkey AS entry_id, c_mktsegment AS title FROM customer"


@query(f"SELECT e.entry_id, COALESCE(p.program, 'unassigned') AS program FROM ({ENTRIES}) e LEFT JOIN (VALUES " + ", ".join(f"('{n}', '{p}')" for n, ps in TITLES for p in ps) + ") p(title, program) ON e.title = p.title")
def calendar_fan_out(t: Tables):
    """One calendar entry mints a slot for each program that its title stands for; an unknown title one for triage."""
    registry = t.spark.createDataFrame([(n, list(ps)) for n, ps in TITLES], "title string, programs array<string>")
    return control.fan_out(t("customer").select(F.col("c_custkey").alias("entry_id"), F.col("c_mktsegment").alias("title")), registry).select("entry_id", "program")


@query("""SELECT slot_id, CAST(CASE WHEN entry_id IS NULL THEN due WHEN entry_date IS NULL THEN estimate ELSE entry_date END AS VARCHAR) AS due, CASE WHEN entry_id IS NULL OR entry_date IS NULL THEN 'cadence' ELSE 'calendar' END AS predicted_from, CASE WHEN entry_id IS NULL THEN 'none' WHEN entry_date IS NULL THEN 'removed' WHEN entry_date <> due THEN 'moved' ELSE 'none' END AS change
    FROM (SELECT s.*, e.entry_date FROM (SELECT o_orderkey AS slot_id, CASE WHEN o_orderkey % 6 <> 1 THEN o_orderkey END AS entry_id, CAST(o_orderdate AS DATE) AS due, CAST(date_trunc('month', o_orderdate) AS DATE) AS estimate FROM orders) s LEFT JOIN (SELECT o_orderkey AS entry_id, CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 8 = 0 THEN 7 ELSE 0 END AS INT) AS entry_date FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '3-MEDIUM') e ON s.entry_id = e.entry_id)""")
def calendar_moves(t: Tables):
    """Slots after their calendar was read again: moved entries move them, withdrawn ones leave them to their cadence."""
    o, key = t("orders"), F.col("o_orderkey")
    date = F.col("o_orderdate").cast("date")
    slots = o.select(key.alias("slot_id"), F.when(key % 6 != 1, key).alias("entry_id"), date.alias("due"), F.trunc("o_orderdate", "month").alias("estimate"))
    entries = o.where("o_orderstatus <> 'P' AND o_orderpriority <> '3-MEDIUM'").select(key.alias("entry_id"), F.date_add(date, F.when(key % 8 == 0, 7).otherwise(0)).alias("entry_date"))
    return control.rescheduled(slots, entries).withColumn("due", F.col("due").cast("string"))


FEED = "SELECT o_custkey % 11 AS program, o_orderkey AS entry, CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) AS stamp FROM orders"
SEEN = "SELECT o_custkey % 11 AS program, o_orderkey AS entry, CAST(o_orderdate AS DATE) - CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INT) AS stamp FROM orders WHERE o_orderstatus <> 'P'"


@query(f"SELECT f.program, f.entry, s.slot_id, CASE WHEN s.slot_id IS NULL THEN 'mint_out_of_cycle' ELSE 'arm' END AS arms FROM (SELECT * FROM ({FEED}) WHERE (program, entry, stamp) NOT IN (SELECT (program, entry, stamp) FROM ({SEEN}))) f LEFT JOIN (SELECT f.entry, s.slot_id FROM ({FEED}) f JOIN open_slots s ON f.program = s.program AND s.state = 'open' AND abs(s.due - f.day) <= 1 QUALIFY row_number() OVER (PARTITION BY f.entry ORDER BY abs(s.due - f.day), s.slot_id) = 1) s ON f.entry = s.entry")
def feed_arming(t: Tables):
    """New and changed feed entries arm the poll ladder of their program, or mint a slot where none is due."""
    rows = t("orders")
    date = F.col("o_orderdate").cast("date")
    name = [(F.col("o_custkey") % 11).alias("program"), F.col("o_orderkey").alias("entry")]
    feed = rows.select(*name, date.alias("day"), date.alias("stamp"))
    seen = rows.where("o_orderstatus <> 'P'").select(*name, F.date_sub(date, F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("stamp"))
    return control.armed_by_feed(seen, feed, t("open_slots").where("state = 'open'")).select("program", "entry", "slot_id", "arms")


LATE = f"SELECT program, occurrence FROM ({SLOTS}) WHERE signal = 'late' AND DATE '{NOW}' - occurrence > 3"


@query(f"SELECT program, CAST(occurrence AS VARCHAR) AS occurrence, DATE '{NOW}' - occurrence AS days_late FROM ({LATE})")
def late_slots(t: Tables):
    days = F.datediff(F.lit(NOW).cast("date"), F.col("occurrence"))
    return _slots(t).where("signal = 'late'").where(days > 3).select("program", day("occurrence"), days.cast("long").alias("days_late"))


@query(f"SELECT grp, program, CAST(occurrence AS VARCHAR) AS occurrence, CAST(SUM(new) OVER (PARTITION BY grp ORDER BY occurrence RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS incident FROM (SELECT *, CASE WHEN occurrence - lag(occurrence) OVER (PARTITION BY grp ORDER BY occurrence, program) <= 31 THEN 0 ELSE 1 END AS new FROM (SELECT program % 3 AS grp, * FROM ({LATE})))")
def incident_group(t: Tables):
    """Late slots of sibling programs that follow one another are one incident."""
    days = F.datediff(F.lit(NOW).cast("date"), F.col("occurrence"))
    late = _slots(t).where("signal = 'late'").where(days > 3).select((F.col("program") % 3).alias("grp"), "program", "occurrence")
    # days are few: incidents are found over them, and every slot takes its day's
    days = matching.incidents(late.select("grp", "occurrence").distinct(), ["grp"], "occurrence", 31)
    return late.join(days, ["grp", "occurrence"]).select("grp", "program", day("occurrence"), "incident")


@query(f"SELECT program, CAST(MAX(occurrence) FILTER (WHERE artifact) AS VARCHAR) AS newest, CAST(date_diff('month', MAX(occurrence) FILTER (WHERE artifact), DATE '{NOW}') AS BIGINT) AS staleness, date_diff('month', MAX(occurrence) FILTER (WHERE artifact), DATE '{NOW}') > CASE program % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 12 END AS flagged FROM slots WHERE occurrence <= DATE '{NOW}' GROUP BY program")
def coverage(t: Tables):
    """How far each program's newest period lags behind what its cadence implies."""
    newest = F.max(F.when(F.col("artifact"), F.col("occurrence")))
    step = F.when(F.col("program") % 3 == 0, 1).when(F.col("program") % 3 == 1, 3).otherwise(12)  # monthly, quarterly, annual
    months = (F.year(F.lit(NOW).cast("date")) - F.year("d")) * 12 + F.month(F.lit(NOW).cast("date")) - F.month("d")
    found = t("slots").where(f"occurrence <= DATE'{NOW}'").groupBy("program").agg(newest.alias("d")).withColumn("staleness", months.cast("long"))
    return found.select("program", F.col("d").cast("string").alias("newest"), "staleness", (F.col("staleness") > step).alias("flagged"))


@query("SELECT c.entry_id, c.program, s.slot_id, COALESCE(CASE WHEN s.slot_id IS NOT NULL THEN 'update' END, 'mint') AS action, s.distance FROM calendar c LEFT JOIN (SELECT c.entry_id, s.slot_id, s.due - c.entry_date AS distance FROM calendar c JOIN open_slots s ON c.program = s.program AND s.state = 'open' AND abs(s.due - c.entry_date) <= 10 QUALIFY row_number() OVER (PARTITION BY c.entry_id ORDER BY abs(s.due - c.entry_date), s.slot_id) = 1) s ON c.entry_id = s.entry_id")
def calendar_match(t: Tables):
    """Calendar entries update the nearest open slot within ten days, or mint one."""
    best = matching.nearest_within(t("calendar"), t("open_slots").where("state = 'open'"), ["program"], "entry_date", "due", "slot_id", 10)
    return best.select("entry_id", "program", "slot_id", F.when(F.col("slot_id").isNotNull(), "update").otherwise("mint").alias("action"), "distance")


@query("SELECT m.mutation_id, e.row_key, e.added - m.seen AS distance FROM mutations m JOIN errata e ON m.program = e.program AND e.product_type = 'Database' AND abs(e.added - m.seen) <= 14 QUALIFY row_number() OVER (PARTITION BY m.mutation_id, m.program, m.seen ORDER BY abs(e.added - m.seen), e.row_key) = 1")
def errata_match(t: Tables):
    """Each unexpected change with its nearest announced correction within 14 days."""
    return _explained(t).where("row_key IS NOT NULL").select("mutation_id", "row_key", "distance")


def _explained(t: Tables):
    return matching.nearest_within(t("mutations"), t("errata").where("product_type = 'Database'"), ["program"], "seen", "added", "row_key", 14)


@query("SELECT m.mutation_id, m.program FROM mutations m WHERE NOT EXISTS (SELECT 1 FROM errata e WHERE m.program = e.program AND e.product_type = 'Database' AND abs(e.added - m.seen) <= 14)")
def unexplained_mutation(t: Tables):
    """Changes that no correction within 14 days explains."""
    return _explained(t).where("row_key IS NULL").select("mutation_id", "program")


DUE = "TRY_CAST(regexp_extract(correction_status, '([0-9]{2})/([0-9]{2})/([0-9]{4})', 3) || '-' || regexp_extract(correction_status, '([0-9]{2})/([0-9]{2})/([0-9]{4})', 1) || '-' || regexp_extract(correction_status, '([0-9]{2})/([0-9]{2})/([0-9]{4})', 2) AS DATE)"


def _due():
    return F.to_date(F.try_to_timestamp(F.regexp_extract("correction_status", r"on (\d{2}/\d{2}/\d{4})", 1), F.lit("MM/dd/yyyy")))


@query(f"SELECT row_key, CAST({DUE} AS VARCHAR) AS due FROM errata")
def errata_due(t: Tables):
    return t("errata").select("row_key", _due().cast("string").alias("due"))


@query(f"SELECT row_key, CASE WHEN program > 8 THEN 'triage' WHEN product_type <> 'Database' THEN 'record' WHEN {DUE} > added - CAST(row_key % 2 AS INT) THEN 'arm_scheduled' ELSE 'arm' END AS action FROM errata")
def errata_arm(t: Tables):
    """Announced database corrections arm the watcher; those of unknown programs go to triage."""
    added = F.date_sub("added", (F.col("row_key") % 2).cast("int"))
    return t("errata").select("row_key", control.errata_action(F.col("product_type"), F.col("program") <= 8, _due(), added).alias("action"))


@query("SELECT DISTINCT CAST(added AS VARCHAR) AS added, COUNT(*) OVER (ORDER BY added RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW) AS trailing FROM errata")
def errata_rate(t: Tables):
    """Errata of the trailing 90 days at each date with errata. Days are counted before the running sum."""
    from pyspark.sql.window import Window

    daily = t("errata").groupBy("added").agg(F.count("*").alias("n")).withColumn("d", F.unix_date("added"))
    return daily.select(day("added"), F.sum("n").over(Window.orderBy("d").rangeBetween(-89, 0)).alias("trailing"))


@query("SELECT program, CAST(COUNT(*) AS DOUBLE) / 80 AS monthly, CAST(COUNT(*) FILTER (WHERE added >= DATE '2001-05-01') AS DOUBLE) / 3 AS recent, NOT (CAST(COUNT(*) FILTER (WHERE added >= DATE '2001-05-01') AS DOUBLE) / 3 BETWEEN 0.3 * COUNT(*) / 80 AND 3.0 * COUNT(*) / 80) AS broken FROM errata GROUP BY program")
def errata_budget(t: Tables):
    """Programs whose recent errata rate lies outside 0.3 to 3 times the usual one: the monitor is broken."""
    recent = F.count(F.when(F.col("added") >= "2001-05-01", 1)).cast("double") / 3
    found = t("errata").groupBy("program").agg((F.count("*").cast("double") / 80).alias("monthly"), recent.alias("recent"), F.count("*").alias("n"))
    return found.select("program", "monthly", "recent", (~F.col("recent").between(0.3 * F.col("n") / 80, 3.0 * F.col("n") / 80)).alias("broken"))


CLASS = "CASE " + " ".join(f"WHEN regexp_matches(lower(title), '{p}') THEN '{n}'" for n, p in control.NOTICE_CLASSES) + " ELSE 'unknown' END"


@query(f"SELECT notice_id, {CLASS} AS classification FROM notices")
def notice_class(t: Tables):
    return t("notices").select("notice_id", control.notice_class(F.col("title")).alias("classification"))


@query("SELECT n.notice_id, p.program, CASE WHEN p.program = 'ecec' AND NOT n.names_ecec THEN FALSE ELSE TRUE END AS applied FROM (SELECT notice_id, area, notice_id % 4 = 0 AS names_ecec FROM notices WHERE area = 0) n CROSS JOIN (VALUES ('eci'), ('ecec')) p(program)")
def inv24c_ncs(t: Tables):
    """Notices of the shared compensation survey go to both programs, but are applied to the second only if they name it."""
    rows = t("notices").where("area = 0").select("notice_id", (F.col("notice_id") % 4 == 0).alias("names_ecec"), F.explode(F.array(F.lit("eci"), F.lit("ecec"))).alias("program"))
    return rows.select("notice_id", "program", ((F.col("program") != "ecec") | F.col("names_ecec")).alias("applied"))


AREAS = [(0, ("eci", "ecec")), (1, ("ces-n",)), (2, ("sae",)), (3, ("cps-ln",)), (4, ("jolts", "jolts-state")), (5, ("qcew",)), (6, ("bed",)), (7, ("oews",))]


@query("SELECT n.notice_id, COALESCE(a.program, 'unassigned') AS program, CASE WHEN a.program IS NULL THEN 'uncertain' WHEN a.area IN (0, 4) THEN 'inferred' ELSE 'exact' END AS confidence FROM notices n LEFT JOIN (VALUES " + ", ".join(f"({a}, '{p}')" for a, ps in AREAS for p in ps) + ") a(area, program) ON n.area = a.area")
def notice_route(t: Tables):
    """Every notice with its programs: all of a shared area's, and `unassigned` rather than none."""
    areas = t.spark.createDataFrame([(a, list(ps)) for a, ps in AREAS], "area int, programs array<string>")
    routed = t("notices").join(areas, "area", "left")
    confidence = F.when(F.col("programs").isNull(), "uncertain").when(F.size("programs") > 1, "inferred").otherwise("exact")
    return routed.select("notice_id", F.explode(F.coalesce("programs", F.array(F.lit("unassigned")))).alias("program"), confidence.alias("confidence"))


RESOLVED = """SELECT release_id, first_observed_at AS observed, CASE WHEN scheduled_at_source IN ('ics', 'schedule_page') THEN scheduled_at END AS eligible,
    CASE WHEN notice_date IS NOT NULL THEN greatest(((CAST(notice_date AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC', first_observed_at) END AS noticed FROM releases"""


@query(f"""SELECT release_id, CAST(epoch_us(COALESCE(CASE WHEN NOT late THEN eligible END, noticed, observed)) AS BIGINT) AS known_us, CASE WHEN eligible IS NOT NULL AND NOT late THEN 'scheduled' WHEN noticed IS NOT NULL THEN 'notice' ELSE 'observed' END AS source,
    CASE WHEN late THEN 'late_artifact' WHEN eligible IS NOT NULL AND observed < eligible - INTERVAL 15 MINUTE THEN 'early_artifact' END AS flag FROM (SELECT *, eligible IS NOT NULL AND observed > eligible + INTERVAL 15 MINUTE AS late FROM ({RESOLVED}))""")
def knowledge_time_resolve(t: Tables):
    c = F.col
    at, source, flag = control.knowledge_time(c("scheduled_at"), c("scheduled_at_source"), c("notice_date"), c("first_observed_at"), F.expr("INTERVAL 15 MINUTES"))
    return t("releases").select("release_id", at.alias("at"), source.alias("source"), flag.alias("flag")).select("release_id", micros("at").alias("known_us"), "source", "flag")


@query(f"SELECT release_id, CAST(epoch_us(noticed) AS BIGINT) AS instant_us FROM ({RESOLVED}) WHERE noticed IS NOT NULL")
def notice_instant(t: Tables):
    """A notice's date is its local day's end, and never before the artifact was seen."""
    at = F.greatest(control.end_of_day(F.col("notice_date")), F.col("first_observed_at"))
    return t("releases").where("notice_date IS NOT NULL").select("release_id", at.alias("at")).select("release_id", micros("at").alias("instant_us"))


@query("SELECT event_id, CAST(epoch_us(((CAST(DATE '2024-03-01' + CAST(event_id % 300 AS INT) AS TIMESTAMP) + INTERVAL 510 MINUTE) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC') AS BIGINT) AS utc_us FROM events")
def et_to_utc(t: Tables):
    """08:30 local time in UTC, across the changes of daylight saving."""
    local = F.date_add(F.lit("2024-03-01").cast("date"), (F.col("event_id") % 300).cast("int")).cast("timestamp_ntz") + F.expr("INTERVAL 510 MINUTES")
    return t("events").select("event_id", control.to_utc(local).alias("at")).select("event_id", micros("at").alias("utc_us"))


@query("SELECT event_id, CAST(epoch_us(date_trunc('second', ts)) AS BIGINT) AS at_us FROM events")
def http_date(t: Tables):
    """HTTP dates read back. The weekday isn't parsed: it adds nothing and isn't accepted by patterns."""
    stamp = F.date_format("ts", "'Mon, 'dd MMM yyyy HH:mm:ss' GMT'")
    return t("events").select("event_id", F.to_timestamp_ntz(F.substring(stamp, 6, 20), F.lit("dd MMM yyyy HH:mm:ss")).alias("at")).select("event_id", micros("at").alias("at_us"))


@query("SELECT o_orderkey, sha256(CAST(o_custkey % 11 AS VARCHAR) || '|routine|' || COALESCE(CAST(o_orderkey // 7 AS VARCHAR), '~')) AS slot_id FROM orders")
def slot_id(t: Tables):
    """Keyed by the occurrence, not the date: a slot survives its rescheduling."""
    parts = ((F.col("o_custkey") % 11).cast("string"), F.lit("routine"), F.coalesce(F.floor(F.col("o_orderkey") / 7).cast("string"), F.lit("~")))
    return t("orders").select("o_orderkey", F.sha2(F.concat_ws("|", *parts), 256).alias("slot_id"))


@query("SELECT release_id, CASE WHEN k = 0 THEN 'seed' WHEN k IN (1, 2) THEN 'out_of_cycle' WHEN k = 3 THEN 'unchanged_republication' ELSE 'routine' END AS primary_kind, array_to_string(list_filter([CASE WHEN ref_month = 1 THEN 'benchmark' END, CASE WHEN ref_month = 12 THEN 'annual_revision' END, CASE WHEN k % 6 = 1 THEN 'correction' END], lambda x: x IS NOT NULL), ',') AS secondary_kinds FROM releases")
def release_kinds(t: Tables):
    """One primary kind, and the others in order; a correction is always secondary."""
    k = F.col("k")
    primary = F.when(k == 0, "seed").when(k.isin(1, 2), "out_of_cycle").when(k == 3, "unchanged_republication").otherwise("routine")
    more = F.array_compact(F.array(F.when(F.col("ref_month") == 1, "benchmark"), F.when(F.col("ref_month") == 12, "annual_revision"), F.when(k % 6 == 1, "correction")))
    return t("releases").select("release_id", primary.alias("primary_kind"), F.array_join(more, ",").alias("secondary_kinds"))


# What each program depends on directly.
DEPENDS = [("ces-n", "qcew"), ("sae", "qcew"), ("bed", "qcew"), ("oews", "qcew"), ("jolts", "ces-n"), ("eci", "ncs"), ("ecec", "ncs"), ("eci", "oews"), ("eci", "qcew"), ("ecec", "cpi"), ("eci", "cpi"), ("cps-ln", "census-popest"), ("cpi", "cex"), ("ep", "bea-io")]
EDGES = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in DEPENDS) + ") e(source, target)"


@query(f"WITH RECURSIVE walk AS (SELECT source, target, 1 AS tier FROM {EDGES} UNION SELECT w.source, e.target, w.tier + 1 FROM walk w JOIN {EDGES} ON w.target = e.source WHERE w.tier < 10) SELECT source, target, CAST(MIN(tier) AS BIGINT) AS tier FROM walk GROUP BY source, target")
def dependency_closure(t: Tables):
    edges = t.spark.createDataFrame(DEPENDS, "source string, target string")
    return matching.closure(edges).withColumn("tier", F.col("tier").cast("long"))


@query(f"SELECT r.release_id, e.source AS hinted FROM releases r JOIN {EDGES} ON e.target = CASE r.program WHEN 0 THEN 'qcew' WHEN 1 THEN 'ces-n' WHEN 2 THEN 'cpi' ELSE 'none' END")
def cascade_hint(t: Tables):
    """Programs to look at again after a release upstream: a hint, no row of theirs is touched."""
    program = F.when(F.col("program") == 0, "qcew").when(F.col("program") == 1, "ces-n").when(F.col("program") == 2, "cpi")
    edges = t.spark.createDataFrame(DEPENDS, "hinted string, target string")
    return t("releases").select("release_id", program.alias("target")).join(edges, "target").select("release_id", "hinted")


@query("SELECT release_id, CAST(notice_id AS BIGINT) AS marker_id FROM (SELECT r.release_id, n.notice_id, row_number() OVER (PARTITION BY r.release_id ORDER BY n.effective DESC, n.notice_id DESC) AS k FROM releases r JOIN (SELECT notice_id, area % 11 AS program, published - CAST(9000 AS INT) AS effective FROM notices WHERE notice_id % 11 = 4) n ON r.program = n.program AND n.effective <= CAST(r.first_observed_at AS DATE)) WHERE k = 1")
def marker_effective(t: Tables):
    """The precision marker in force at each release: the newest effective by then, carried forward in time."""
    markers = t("notices").where("notice_id % 11 = 4").select((F.col("area") % 11).cast("long").alias("program"), F.date_sub("published", 9000).alias("d"), "notice_id")
    asks = t("releases").select("program", F.col("first_observed_at").cast("date").alias("d"), "release_id")
    known = matching.carried_forward(markers, asks, ["program"], "d", "notice_id")
    return known.where("notice_id IS NOT NULL").select("release_id", F.col("notice_id").alias("marker_id"))


LEVELS = "SELECT program, CAST(make_date(ref_year, ref_month, 1) AS DATE) AS ref_date, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS level FROM releases GROUP BY 1, 2"
ANNOUNCED = "SELECT DISTINCT program FROM (SELECT area % 11 AS program FROM notices WHERE notice_id % 11 = 5)"


@query(f"SELECT s.program, CAST(s.ref_date AS VARCHAR) AS ref_date, s.step FROM (SELECT *, level - lag(level) OVER (PARTITION BY program ORDER BY ref_date) AS step FROM ({LEVELS})) s JOIN (SELECT program, median(abs(step)) / 3 AS usual FROM (SELECT *, level - lag(level) OVER (PARTITION BY program ORDER BY ref_date) AS step FROM ({LEVELS})) WHERE month(ref_date) <> 1 GROUP BY program) u ON s.program = u.program WHERE month(s.ref_date) = 1 AND abs(s.step) > 3 * u.usual AND s.program IN ({ANNOUNCED})")
def popctl_detect(t: Tables):
    """Breaks by new population controls: January, a step far beyond a program's usual one, and a notice. One isn't enough."""
    from pyspark.sql.window import Window

    levels = t("releases").groupBy("program", F.make_date(F.col("ref_year").cast("int"), F.col("ref_month").cast("int"), F.lit(1)).alias("ref_date")).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("level"))
    # a program has a level for each month: windows over them are small
    steps = levels.withColumn("step", F.col("level") - F.lag("level").over(Window.partitionBy("program").orderBy("ref_date")))
    usual = steps.where("month(ref_date) <> 1").groupBy("program").agg((F.median(F.abs("step")) / 3).alias("usual"))
    announced = t("notices").where("notice_id % 11 = 5").select((F.col("area") % 11).cast("long").alias("program")).distinct().withColumn("announced", F.lit(True))
    rows = steps.join(usual, "program").join(announced, "program", "left")
    return rows.where(control.population_break(F.month("ref_date"), F.col("step"), F.col("usual"), F.coalesce("announced", F.lit(False)))).select("program", day("ref_date"), "step")


@query("SELECT program, CAST(ref_date AS VARCHAR) AS ref_date, CASE WHEN data_at IS NULL THEN 'uncertain' WHEN CAST(data_at AS DATE) - ref_date BETWEEN 0 AND 20 THEN 'exact' ELSE 'inferred' END AS confidence, CAST(news_date AS VARCHAR) AS news_date FROM knowability")
def knowability(t: Tables):
    """Publication dates of periods before observation, with how sure they are; they never enter knowledge_time."""
    lag = F.datediff(F.col("data_at").cast("date"), F.col("ref_date"))
    return t("knowability").select("program", day("ref_date"), F.when(F.col("data_at").isNull(), "uncertain").when(lag.between(0, 20), "exact").otherwise("inferred").alias("confidence"), day("news_date"))


@query("""
    WITH placed AS (SELECT a.program, a.release_date, p.ref_date FROM (SELECT DISTINCT program, release_date FROM archive_dates) a LEFT JOIN cadence_periods p ON p.program = a.program AND abs(p.expected - a.release_date) <= 6
                    QUALIFY row_number() OVER (PARTITION BY a.program, a.release_date ORDER BY abs(p.expected - a.release_date), p.ref_date) = 1),
         every AS (SELECT p.program, p.ref_date, MIN(h.release_date) AS release_date, COUNT(h.release_date) AS dates FROM cadence_periods p LEFT JOIN placed h ON h.program = p.program AND h.ref_date = p.ref_date GROUP BY p.program, p.ref_date
                   UNION ALL SELECT program, NULL, release_date, 1 FROM placed WHERE ref_date IS NULL)
    SELECT program, CAST(ref_date AS VARCHAR) AS ref_date, CAST(release_date AS VARCHAR) AS release_date, dates, finding, CASE WHEN finding = 'on_cadence' THEN 'exact' ELSE 'uncertain' END AS confidence
    FROM (SELECT *, CASE WHEN ref_date IS NULL THEN 'off_cadence' WHEN dates = 0 THEN 'missing' WHEN dates > 1 THEN 'doubled' ELSE 'on_cadence' END AS finding FROM every)""")
def knowability_cadence(t: Tables):
    """Archive dates checked against the cadence: what is shifted, missing or doubled stays uncertain."""
    return control.placed_by_cadence(t("archive_dates"), t("cadence_periods"), 6).select("program", day("ref_date"), day("release_date"), "dates", "finding", "confidence")


def in_force(kinds: str) -> str:
    return f"SELECT r.*, m.marker_id, m.kind, m.effective FROM measured r LEFT JOIN markers m ON m.program = r.program AND starts_with(r.unit_key, m.prefix) AND m.effective <= r.ref_date AND m.kind IN ({kinds}) QUALIFY row_number() OVER (PARTITION BY r.row_id ORDER BY length(m.prefix) DESC NULLS LAST, m.effective DESC, m.marker_id DESC) = 1"


@query(f"SELECT row_id, CASE WHEN prev_value IS NOT DISTINCT FROM value THEN 'same' WHEN marker_id IS NOT NULL AND round(prev_value) IS NOT DISTINCT FROM round(value) THEN 'precision_change' ELSE 'revised' END AS change, marker_id FROM ({in_force(repr('precision_change'))})")
def precision_by_marker(t: Tables):
    """Changes of value, told from changes of precision by the marker in force for the series."""
    found = markers.in_force(t("measured"), t("markers"), ["precision_change"], "ref_date")
    return found.select("row_id", markers.change_kind(F.col("prev_value"), F.col("value"), F.col("marker"), 0).alias("change"), F.col("marker.marker_id").alias("marker_id"))


@query(f"""SELECT row_id, marker_id, COALESCE(kind IN ('suspension', 'discontinuation'), FALSE) AS expected FROM ({in_force("'suspension', 'discontinuation', 'resumption'")}) WHERE value IS NULL""")
def expected_loss(t: Tables):
    """Values that went missing, with whether a suspension or discontinuation of their scope announced it."""
    found = markers.in_force(t("measured").where("value IS NULL"), t("markers"), ["suspension", "discontinuation", "resumption"], "ref_date")
    return found.select("row_id", F.col("marker.marker_id").alias("marker_id"), markers.expected_loss(F.col("marker")).alias("expected"))


@query(f"""SELECT row_id, CAST(effective AS VARCHAR) AS effective FROM ({in_force("'reweight', 'population_control'")}) WHERE abs(value - prev_value) >= 2 AND NOT COALESCE(ref_date - effective <= 365, FALSE)""")
def inv20_rebase(t: Tables):
    """Jumps in a series that no reweight or population control of its scope accompanies within a year."""
    found = markers.in_force(t("measured"), t("markers"), ["reweight", "population_control"], "ref_date")
    broken = markers.unmarked_break(F.col("prev_value"), F.col("value"), F.col("ref_date"), F.col("marker"), 2, 365)
    return found.where(broken).select("row_id", F.col("marker.effective").cast("string").alias("effective"))
