"""Registered queries for the visit reports of §2.11."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kerbside.functions.timefn import day_range, local_time
from kerbside.functions.values import key_part
from kerbside.operators import joins as J
from kerbside.plans import visits as PV
from kerbside.sources import derived as D
from kerbside.sources.tables import scan
from kerbside.suite.common import day_text
from kerbside.suite.oracle_inputs import with_inputs

QUERIES: dict = {}
ORACLE: dict = {}


def q(name, sql=None, inputs=()):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_inputs(sql, *inputs) if inputs else sql.strip()
        return fn
    return deco


_LATEST = """lv AS (SELECT * FROM visits WHERE action <> 'deleted'
  QUALIFY row_number() OVER (PARTITION BY visit_id ORDER BY updated DESC, rev_id DESC) = 1)"""
_STAY = "coalesce(round(date_diff('second', {a}, {d}) / 60, 1), 0)"


@q("stay_duration", f"""
WITH lv AS (SELECT * FROM visits QUALIFY row_number() OVER (PARTITION BY visit_id ORDER BY updated DESC, rev_id DESC) = 1)
SELECT visit_id, arrival, departure, {_STAY.format(a='arrival', d='departure')} AS stay_minutes FROM lv
WHERE {_STAY.format(a='arrival', d='departure')} <= 10000""", ["visits"])
def stay_duration(spark, base):
    lv = PV.latest_visits(D.visits(spark, base), keep_deleted=True)
    return PV.with_stay(lv, cap=10000).select("visit_id", "arrival", "departure", "stay_minutes")


@q("recent_visits_clean", f"""
WITH near AS (SELECT * FROM visits WHERE action <> 'deleted' AND split_part(ors_id, '#', 3) = 'click'
              AND CAST(arrival AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'),
newest AS (SELECT visit_id, max({{'u': updated, 'r': rev_id}}) AS m FROM near GROUP BY visit_id)
SELECT n.visit_id, n.out_plate AS plate, timezone('Europe/London', n.arrival AT TIME ZONE 'UTC') AS local_arrival,
  timezone('Europe/London', n.departure AT TIME ZONE 'UTC') AS local_departure,
  {_STAY.format(a='n.arrival', d='n.departure')} AS stay_minutes
FROM near n JOIN newest w ON n.visit_id = w.visit_id AND n.rev_id = w.m.r AND n.updated = w.m.u
WHERE {_STAY.format(a='n.arrival', d='n.departure')} <= 10000""", ["visits"])
def recent_visits_clean(spark, base):
    """Filters first, then the newest revision of what is left (an older revision in range counts)."""
    v = D.visits(spark, base).where((key_part("ors_id", 2) == "click") & day_range("arrival", "20240110", "20240120"))
    return PV.with_stay(PV.latest_visits(v), cap=10000).select(
        "visit_id", F.col("out_plate").alias("plate"), local_time("arrival", "Europe/London").alias("local_arrival"),
        local_time("departure", "Europe/London").alias("local_departure"), "stay_minutes")


REPEAT_SQL = f"""
WITH {_LATEST},
r AS (SELECT *, lag(arrival) OVER (PARTITION BY out_plate, ors_id ORDER BY arrival, rev_id) AS prev_arrival
      FROM lv WHERE arrival >= TIMESTAMP '2024-01-07 00:00:00' AND arrival < TIMESTAMP '2024-01-21 00:00:00'),
k AS (SELECT *, row_number() OVER (PARTITION BY ors_id, out_plate ORDER BY arrival DESC, rev_id DESC) AS rn
      FROM r WHERE arrival >= TIMESTAMP '2024-01-10 00:00:00')
SELECT ors_id, out_plate, arrival, prev_arrival,
  CASE WHEN prev_arrival >= arrival - INTERVAL 6 HOUR THEN rn + 1 ELSE rn END AS entry_count,
  CASE WHEN (CASE WHEN prev_arrival >= arrival - INTERVAL 6 HOUR THEN rn + 1 ELSE rn END) > 1
       THEN 'repeated' ELSE 'not' END AS repeat_status
FROM k"""


@q("repeat_visitor", REPEAT_SQL, ["visits"])
def repeat_visitor(spark, base):
    lv = PV.latest_visits(D.visits(spark, base))
    r = PV.repeat_visitors(lv, "ors_id", "out_plate", "arrival", "20240110", "20240120",
                           within=dt.timedelta(hours=6), lookback=dt.timedelta(days=3), tiebreak="rev_id",
                           by_day=False)
    return r.select("ors_id", "out_plate", "arrival", "prev_arrival", "entry_count", "repeat_status")


VEHICLE = {"colour": ("in_colour", "out_colour"), "make": ("in_make", "out_make"), "model": ("in_model", "out_model"),
           "year": ("in_year", "out_year"), "fuel": ("in_fuel", "out_fuel"), "co2": ("in_co2", "in_co2"), "weight": ("in_weight", "out_weight")}


@q("vehicle_profile", """
WITH l AS (SELECT * FROM vehicle_visits WHERE CAST(arrival AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
           QUALIFY row_number() OVER (PARTITION BY ors_id, in_plate, out_plate ORDER BY updated DESC, rev_id DESC) = 1),
p AS (SELECT DISTINCT ors_id, coalesce(nullif(trim(in_plate), ''), nullif(trim(out_plate), '')) AS plate_no,
             timezone('Europe/Copenhagen', updated AT TIME ZONE 'UTC') AS update_time,
             coalesce(nullif(trim(in_colour), ''), nullif(trim(out_colour), '')) AS colour,
             coalesce(nullif(trim(in_make), ''), nullif(trim(out_make), '')) AS make,
             coalesce(nullif(trim(in_model), ''), nullif(trim(out_model), '')) AS model, coalesce(in_year, out_year) AS year,
             coalesce(nullif(trim(in_fuel), ''), nullif(trim(out_fuel), '')) AS fuel, in_co2 AS co2, coalesce(in_weight, out_weight) AS weight,
             coalesce(round(date_diff('second', arrival, departure) / 60, 1), 0) AS stay_minutes FROM l)
SELECT p.*, s.name AS site_name FROM p LEFT JOIN sites s
  ON p.ors_id = concat_ws('#', s.organization, s.parent, s.group_id)
WHERE model IS NOT NULL AND make IS NOT NULL AND fuel IS NOT NULL""", ["vehicle_visits", "group_log", "sites"])
def vehicle_profile(spark, base):
    from kerbside.plans.dimension import site_dimension
    return PV.vehicle_profile(D.vehicle_visits(spark, base), VEHICLE, ("model", "make", "fuel"), site_dimension(D.group_log(spark, base)),
                              "20240105", "20240125", "Europe/Copenhagen")


ORACLE_VISIT_FACT = """
WITH v AS (SELECT * FROM visits WHERE action <> 'deleted' AND arrival >= TIMESTAMP '2024-01-03 00:00:00'
           QUALIFY row_number() OVER (PARTITION BY visit_id ORDER BY updated, rev_id) = 1),
s AS (SELECT visit_id, coalesce(in_plate, out_plate) AS plate, ors_id, date_trunc('second', arrival) AS came,
             date_trunc('second', departure) AS went FROM v),
l AS (SELECT s.*, z.timezone, timezone(z.timezone, came AT TIME ZONE 'UTC') AS entry_time,
             timezone(z.timezone, went AT TIME ZONE 'UTC') AS exit_time
      FROM s LEFT JOIN org_timezone z ON z.org = split_part(ors_id, '#', 1))
SELECT visit_id, plate, split_part(ors_id, '#', 1) AS org, nullif(split_part(ors_id, '#', 3), '') AS site, timezone,
  entry_time, exit_time, round(date_diff('second', entry_time, exit_time) / 60, 1) AS stay_minutes,
  EXISTS (SELECT 1 FROM exemptions e WHERE e.org || '#' || e.region || '#' || e.site = l.ors_id AND e.plate = l.plate
          AND l.came >= date_trunc('second', CASE WHEN e.start_time < e.response_time THEN e.response_time ELSE e.start_time END)
          AND (e.end_time IS NULL OR year(e.end_time) = 2099 OR l.came <= date_trunc('second', e.end_time))) AS is_whitelisted
FROM l"""


@q("visit_fact_build", ORACLE_VISIT_FACT, ["visits", "exemptions", "org_timezone"])
def visit_fact_build(spark, base):
    return PV.build_visit_fact(D.visits(spark, base), D.exemptions(spark, base), D.org_timezone(spark),
                               since=dt.datetime(2024, 1, 3))


@q("visit_fact_refresh", ORACLE_VISIT_FACT, ["visits", "exemptions", "org_timezone"])
def visit_fact_refresh(spark, base):
    """The fact of the first two thirds of the revisions, brought up to date by the days that the rest touches."""
    from kerbside.sources import sinks
    from kerbside.sources import versions as V
    v, e, z, since = D.visits(spark, base), D.exemptions(spark, base), D.org_timezone(spark), dt.datetime(2024, 1, 3)
    path = sinks.scratch_table_path(spark, "visit-fact")
    new = F.col("rev_id") % 3 == 2
    V.publish_days(PV.build_visit_fact(v.where(~new), e, z, since=since, day="day"), path, "day")
    PV.refresh_visit_fact(path, v, v.where(new), e, z, since=since)
    return V.read_current(spark, path).drop("day")


@q("permit_normalise", """
SELECT permit_id, plate, date_trunc('second', CASE WHEN start_time < response_time THEN response_time ELSE start_time END) AS valid_from,
  CASE WHEN end_time IS NULL OR year(end_time) = 2099 THEN TIMESTAMP '9999-12-31 00:00:00' ELSE date_trunc('second', end_time) END AS valid_to,
  sha256(org || region || site || plate) AS permit_hash
FROM permits""", ["permits"])
def permit_normalise(spark, base):
    return PV.normalise_permits(D.permits(spark, base)).select("permit_id", "plate", "valid_from", "valid_to",
                                                                "permit_hash")


def _legacy_visits(spark, base):
    li = scan(spark, base, "lineitem")
    t = F.expr("timestampadd(HOUR, l_linenumber, l_shipdate)")
    return li.select(F.col("l_suppkey").alias("site_key"),
                     (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("visit_key"),
                     t.alias("entry_time"), F.to_date(t).alias("entry_date"))


@q("two_source_cutover", """
WITH o AS (SELECT l_suppkey AS site_key, l_orderkey * 10 + l_linenumber AS visit_key,
                  l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) AS entry_time FROM lineitem)
SELECT 'old' AS source, o.site_key, o.visit_key, o.entry_time FROM o JOIN cutover c ON o.site_key = c.site_key
WHERE CAST(o.entry_time AS DATE) < c.transition_date
UNION ALL
SELECT 'new', f.site_key, f.visit_key, f.entry_time FROM fact_visit f JOIN cutover c ON f.site_key = c.site_key
WHERE f.entry_date >= c.transition_date""", ["cutover", "fact_visit"])
def two_source_cutover(spark, base):
    """Legacy feed before each site's cut-over day, new fact from it on; sites without a day drop out."""
    old = _legacy_visits(spark, base)
    new = D.fact_visit(spark, base).select("site_key", "visit_key", "entry_time", "entry_date")
    u = PV.cutover_union(old, new, D.cutover(spark, base), "site_key", "entry_date")
    return u.select("source", "site_key", "visit_key", "entry_time")


_PERIODS = PV.month_periods(dt.date(1998, 6, 1))


def _period_sql():
    parts = []
    for label, (s, e) in _PERIODS.items():
        parts.append(f"SELECT '{label}' AS period, * FROM fact_visit WHERE entry_date BETWEEN DATE '{s}' AND DATE '{e}'")
    return "\nUNION ALL\n".join(parts)


@q("period_compare", f"""
WITH lab AS ({_period_sql()}),
r AS (SELECT *, row_number() OVER (PARTITION BY period, site_key, vehicle_key ORDER BY entry_time DESC, visit_key DESC) AS rn
      FROM lab)
SELECT period, site_key, count(*) AS visits, count(DISTINCT vehicle_key) AS vehicles, count_if(rn > 1) AS repeat_visits
FROM r GROUP BY ALL""", ["fact_visit"])
def period_compare(spark, base):
    return PV.period_report(D.fact_visit(spark, base), "entry_date", "entry_time", _PERIODS, "site_key",
                            "vehicle_key", "visit_key", rank_scope="period")


def _period_sql_from(src: str):
    parts = []
    for label, (s, e) in _PERIODS.items():
        parts.append(f"SELECT '{label}' AS period, * FROM {src} WHERE entry_date BETWEEN DATE '{s}' AND DATE '{e}'")
    return "\nUNION ALL\n".join(parts)


@q("period_compare_history", f"""
WITH h AS (SELECT *, row_number() OVER (PARTITION BY site_key, vehicle_key ORDER BY entry_time DESC, visit_key DESC) AS rn
           FROM fact_visit),
lab AS ({_period_sql_from('h')})
SELECT period, site_key, count(*) AS visits, count(DISTINCT vehicle_key) AS vehicles, count_if(rn > 1) AS repeat_visits
FROM lab GROUP BY ALL""", ["fact_visit"])
def period_compare_history(spark, base):
    return PV.period_report(D.fact_visit(spark, base), "entry_date", "entry_time", _PERIODS, "site_key",
                            "vehicle_key", "visit_key", rank_scope="history")


@q("period_visits", f"""
WITH lab AS ({_period_sql()}),
p AS (SELECT *, lag(entry_time) OVER (PARTITION BY period, vehicle_key, site_key ORDER BY entry_time, visit_key) AS prev_entry_time,
             row_number() OVER (PARTITION BY period, vehicle_key ORDER BY entry_time DESC, visit_key DESC) AS rn FROM lab)
SELECT period, visit_key, site_key, vehicle_key, entry_time, exit_time, prev_entry_time,
  rn + CASE WHEN CAST(prev_entry_time AS DATE) >= CAST(entry_time AS DATE) - 30 THEN 1 ELSE 0 END AS entry_count FROM p""", ["fact_visit"])
def period_visits(spark, base):
    v = PV.period_visits(D.fact_visit(spark, base), "entry_date", "entry_time", _PERIODS, "site_key", "vehicle_key", "visit_key")
    return v.select("period", "visit_key", "site_key", "vehicle_key", "entry_time", "exit_time", "prev_entry_time", "entry_count")


@q("week_over_week_rows", f"""
WITH {_LATEST},
d AS (SELECT *, split_part(ors_id, '#', 1) AS org, CAST(arrival AS DATE) AS d FROM lv),
t AS (SELECT org,
  sum(CASE WHEN (dayofyear(d) + 6 - dayofweek(d)) // 7 = (dayofyear(DATE '2024-01-24') + 6 - dayofweek(DATE '2024-01-24')) // 7
            AND year(d) = 2024 THEN 1 ELSE 0 END) AS current_week_visits,
  sum(CASE WHEN (dayofyear(d) + 6 - dayofweek(d)) // 7 = (dayofyear(DATE '2024-01-17') + 6 - dayofweek(DATE '2024-01-17')) // 7
            AND year(d) = 2024 THEN 1 ELSE 0 END) AS previous_week_visits
  FROM d GROUP BY org)
SELECT d.visit_id, d.ors_id, d.out_plate, d.arrival, t.current_week_visits, t.previous_week_visits FROM d JOIN t ON d.org = t.org""", ["visits"])
def week_over_week_rows(spark, base):
    """The totals joined back to the visits."""
    lv = PV.latest_visits(D.visits(spark, base)).withColumn("org", key_part("ors_id", 0))
    t = PV.week_totals(lv, "org", F.to_date("arrival"), dt.date(2024, 1, 24))
    return lv.join(t, "org").select("visit_id", "ors_id", "out_plate", "arrival", "current_week_visits", "previous_week_visits")


@q("week_over_week", f"""
WITH {_LATEST},
d AS (SELECT split_part(ors_id, '#', 1) AS org, CAST(arrival AS DATE) AS d FROM lv)
SELECT org,
  sum(CASE WHEN (dayofyear(d) + 6 - dayofweek(d)) // 7 = (dayofyear(DATE '2024-01-24') + 6 - dayofweek(DATE '2024-01-24')) // 7
            AND year(d) = 2024 THEN 1 ELSE 0 END) AS current_week_visits,
  sum(CASE WHEN (dayofyear(d) + 6 - dayofweek(d)) // 7 = (dayofyear(DATE '2024-01-17') + 6 - dayofweek(DATE '2024-01-17')) // 7
            AND year(d) = 2024 THEN 1 ELSE 0 END) AS previous_week_visits
FROM d GROUP BY org""", ["visits"])
def week_over_week(spark, base):
    lv = PV.latest_visits(D.visits(spark, base)).withColumn("org", key_part("ors_id", 0))
    return PV.week_totals(lv, "org", F.to_date("arrival"), dt.date(2024, 1, 24))


@q("visit_calendar_extract", """
SELECT f.visit_key, s.site_name, v.make, strftime(f.entry_date, '%Y-%m-%d') AS entry_day,
  strftime(c.transition_date, '%Y-%m-%d') AS transition_day
FROM fact_visit f LEFT JOIN dim_site s ON f.site_key = s.site_key LEFT JOIN dim_vehicle v ON f.vehicle_key = v.vehicle_key
FULL JOIN cutover c ON f.site_key = c.site_key
WHERE f.entry_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'""",
   ["fact_visit", "dim_site", "dim_vehicle", "cutover"])
def visit_calendar_extract(spark, base):
    as_of = dt.date(1998, 6, 15)
    lo, hi = dt.date(as_of.year - 1, 1, 1), dt.date(as_of.year, 12, 31)
    f = D.fact_visit(spark, base).where(F.col("entry_date").between(F.lit(lo), F.lit(hi)))
    s = J.star_join(f, [(D.dim_site(spark, base), "site_key", "site_key"),
                        (D.dim_vehicle(spark, base), "vehicle_key", "vehicle_key"),
                        (D.cutover(spark, base), "site_key", "site_key")])  # full join filtered on the fact = left
    return s.select("visit_key", "site_name", "make", day_text("entry_date").alias("entry_day"),
                    day_text("transition_date").alias("transition_day"))


@q("hourly_vehicle_counts", f"""
WITH {_LATEST},
z AS (SELECT lv.ors_id, lv.in_plate, lv.out_plate, timezone(t.timezone, arrival AT TIME ZONE 'UTC') AS came,
             timezone(t.timezone, departure AT TIME ZONE 'UTC') AS went
      FROM lv LEFT JOIN org_timezone t ON t.org = split_part(lv.ors_id, '#', 1))
SELECT ors_id, date_trunc('hour', came) AS hour, count(DISTINCT in_plate) AS vehicles_in,
  count(DISTINCT CASE WHEN date_trunc('hour', went) = date_trunc('hour', came) THEN out_plate END) AS vehicles_out
FROM z WHERE came IS NOT NULL GROUP BY ALL""", ["visits", "org_timezone"])
def hourly_vehicle_counts(spark, base):
    """Distinct plates per site and local entry hour; a plate counts as out only
    when it leaves in its entry hour, as the script compares both with that hour."""
    from kerbside.functions.values import with_timezone
    lv = PV.latest_visits(D.visits(spark, base)).withColumn("org", key_part("ors_id", 0))
    z = with_timezone(lv, "org", D.org_timezone(spark))
    hour = lambda c: F.date_trunc("hour", local_time(c, F.col("timezone"))).cast("timestamp_ntz")
    z = z.select("ors_id", "in_plate", "out_plate", hour("arrival").alias("hour"), hour("departure").alias("__exit")) \
         .where(F.col("hour").isNotNull())
    # distinct (site, hour, direction, plate) once, then conditional counts: the same
    # numbers as two COUNT(DISTINCT CASE ...) without expanding every row per distinct
    ev = z.select("ors_id", "hour", F.explode(F.array(
        F.struct(F.lit("in").alias("kind"), F.col("in_plate").alias("plate")),
        F.struct(F.lit("out").alias("kind"), F.when(F.col("__exit") == F.col("hour"), F.col("out_plate")).alias("plate")),
    )).alias("e")).select("ors_id", "hour", "e.kind", "e.plate").distinct()
    seen = lambda k: F.count_if((F.col("kind") == k) & F.col("plate").isNotNull())
    return ev.groupBy("ors_id", "hour").agg(seen("in").alias("vehicles_in"), seen("out").alias("vehicles_out"))


ATTRS = {"colour": ("in_colour", "out_colour"), "make": ("in_make", "out_make")}


@q("visit_fact_sites", """
WITH v AS (SELECT * FROM visits WHERE action <> 'deleted' AND arrival >= TIMESTAMP '2024-01-03 00:00:00'
           QUALIFY row_number() OVER (PARTITION BY visit_id ORDER BY updated, rev_id) = 1),
m AS (SELECT DISTINCT ors_id, coalesce(in_plate, out_plate) AS plate, coalesce(in_colour, out_colour) AS colour, coalesce(in_make, out_make) AS make,
             date_trunc('second', arrival) AS came, date_trunc('second', departure) AS went, date_trunc('second', updated) AS upd FROM v),
p AS (SELECT DISTINCT m.*, e.permit_id IS NOT NULL AS is_whitelisted FROM m
      LEFT JOIN exemptions e ON e.org || '#' || e.region || '#' || e.site = m.ors_id AND e.plate = m.plate
       AND m.came >= date_trunc('second', CASE WHEN e.start_time < e.response_time THEN e.response_time ELSE e.start_time END)
       AND (e.end_time IS NULL OR year(e.end_time) = 2099 OR m.came <= date_trunc('second', e.end_time))),
j AS (SELECT p.*, s.organization, s.parent, s.group_id, s.name AS site_name, z.timezone FROM p
      LEFT JOIN sites s ON s.organization = split_part(p.ors_id, '#', 1) AND s.group_id = split_part(p.ors_id, '#', 3)
      LEFT JOIN org_timezone z ON z.org = s.organization),
l AS (SELECT *, timezone(timezone, came AT TIME ZONE 'UTC') AS entry_time, timezone(timezone, went AT TIME ZONE 'UTC') AS exit_time,
             timezone(timezone, upd AT TIME ZONE 'UTC') AS update_time FROM j)
SELECT organization, parent, group_id, site_name, timezone, plate, colour, make, entry_time, exit_time, update_time, CAST(1 AS INT) AS visits,
  is_whitelisted, round(date_diff('second', entry_time, exit_time) / 60, 1) AS stay_minutes
FROM l""", ["visits", "exemptions", "org_timezone", "group_log", "sites"])
def visit_fact_sites(spark, base):
    from kerbside.plans.dimension import site_dimension
    sites = site_dimension(D.group_log(spark, base), zones=D.org_timezone(spark))
    return PV.visit_fact_with_sites(D.visits(spark, base), D.exemptions(spark, base), sites, ATTRS, since=dt.datetime(2024, 1, 3))


@q("hourly_visit_rows", """
WITH s AS (SELECT DISTINCT organization, group_id, name, length(name) * 3 AS bays FROM sites),
n AS (SELECT v.*, s.organization, s.group_id, s.name AS site_name, s.bays, z.timezone,
             timezone(z.timezone, arrival AT TIME ZONE 'UTC') AS came, timezone(z.timezone, departure AT TIME ZONE 'UTC') AS went
      FROM visits v JOIN s ON s.organization = split_part(ors_id, '#', 1) AND s.group_id = split_part(ors_id, '#', 3)
      LEFT JOIN org_timezone z ON z.org = s.organization),
l AS (SELECT * FROM n WHERE CAST(came AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
      QUALIFY row_number() OVER (PARTITION BY visit_id, organization, group_id, site_name, bays ORDER BY updated DESC, rev_id DESC) = 1)
SELECT DISTINCT organization, group_id, site_name, CAST(bays AS INT) AS bays, in_plate, out_plate, came AS arrival, went AS departure, updated,
  date_trunc('hour', came) AS hour,
  TIMESTAMP '2024-01-10 00:00:00' + to_minutes(CAST(floor(date_diff('second', date_trunc('second', came), date_trunc('second', went)) / 60) AS BIGINT)) AS stay_clock,
  CAST(in_plate IS NOT NULL AS BIGINT) AS vehicles_in,
  CAST(coalesce(date_trunc('hour', went) = date_trunc('hour', came), false) AND out_plate IS NOT NULL AS BIGINT) AS vehicles_out
FROM l""", ["visits", "org_timezone", "group_log", "sites"])
def hourly_visit_rows(spark, base):
    """Rows of the hourly counts with site name and bay count, by local day of arrival."""
    from kerbside.functions.values import json_text
    from kerbside.plans.dimension import site_dimension
    log = D.group_log(spark, base).withColumn("json", F.expr("concat('{\"metadata\": {\"bayCount\": \"', length(name) * 3, '\"}}')"))
    sites = site_dimension(log, zones=D.org_timezone(spark), extra=("json",)).withColumn("bays", json_text("json", "$.metadata.bayCount").try_cast("int"))
    return PV.hourly_visits(D.visits(spark, base), sites, "20240110", "20240120")
