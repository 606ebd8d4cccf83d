"""Registered queries for the grid and occupancy reports of §2.11."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.functions.timefn import between_local_days, bucket_floor, local_time, utc_time
from kerbside.functions.values import key_part, with_timezone
from kerbside.plans import occupancy as PO
from kerbside.plans.visits import latest_visits
from kerbside.sources import derived as D
from kerbside.suite.common import day_text, r6
from kerbside.suite.oracle_inputs import with_inputs

QUERIES: dict = {}
ORACLE: dict = {}
NZ = "Pacific/Auckland"


def q(name, sql=None, inputs=()):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_inputs(sql, *inputs) if inputs else sql.strip()
        return fn
    return deco


def _b(expr: str, secs: int = 900) -> str:
    return f"make_timestamp(CAST(floor(epoch({expr}) / {secs}) * {secs} AS BIGINT) * 1000000)"


def _loc(expr: str) -> str:
    return f"timezone('{NZ}', {expr} AT TIME ZONE 'UTC')"


_LATEST = """lv AS (SELECT * FROM visits WHERE action <> 'deleted'
  QUALIFY row_number() OVER (PARTITION BY visit_id ORDER BY updated DESC, rev_id DESC) = 1)"""


def _newest(start: str, end: str) -> str:
    """Newest revision among those that arrive on local days in [start, end]."""
    return f"""lv AS (SELECT * FROM visits WHERE action <> 'deleted' AND CAST({_loc('arrival')} AS DATE) BETWEEN DATE '{start}' AND DATE '{end}'
  QUALIFY row_number() OVER (PARTITION BY visit_id ORDER BY updated DESC, rev_id DESC) = 1)"""


def _lv(spark, base, start=None, end=None):
    """Newest revision of each visit; the local-day bounds apply before the ranking and reach the scan."""
    v = D.visits(spark, base)
    if start is not None:
        v = v.where(between_local_days("arrival", NZ, start, end))
    return latest_visits(v).withColumn("plate", F.coalesce("in_plate", "out_plate"))


@q("time_grid", """
WITH s AS (SELECT DISTINCT v.ors_id, z.timezone FROM visits v JOIN org_timezone z ON z.org = split_part(v.ors_id, '#', 1)),
u AS (SELECT ors_id, timezone, unnest(generate_series(timezone('UTC', timezone(timezone, TIMESTAMP '2024-03-31 00:00:00')),
                                                       timezone('UTC', timezone(timezone, TIMESTAMP '2024-03-31 23:59:59')),
                                                       INTERVAL 15 MINUTE)) AS slot_utc FROM s),
g AS (SELECT ors_id, slot_utc, timezone(timezone, slot_utc AT TIME ZONE 'UTC') AS slot_local FROM u)
SELECT ors_id, slot_local, slot_utc, strftime(slot_local, '%H:%M') AS slot_label FROM g""", ["visits", "org_timezone"])
def time_grid(spark, base):
    """The day on which Europe's clocks go forward: 92 slots there, 96 elsewhere."""
    v = D.visits(spark, base).select("ors_id").distinct().withColumn("org", key_part("ors_id", 0))
    s = with_timezone(v, "org", D.org_timezone(spark)).drop("org")
    tz = F.col("timezone")
    g = PO.slot_grid(s, "20240331", "20240331", 15, "slot_local", tz=tz)
    return g.select("ors_id", "slot_local", utc_time("slot_local", tz).alias("slot_utc"),
                    F.date_format("slot_local", "HH:mm").alias("slot_label"))


@q("hour_grid", """
WITH b AS (SELECT DISTINCT device_id FROM plate_events)
SELECT device_id, unnest(generate_series(TIMESTAMP '2024-01-10 00:00:00', TIMESTAMP '2024-01-11 23:59:59', INTERVAL 1 HOUR)) AS hour
FROM b""", ["plate_events"])
def hour_grid(spark, base):
    bays = D.plate_events(spark, base).select("device_id").distinct()
    return PO.slot_grid(bays, "20240110", "20240111", 60, "hour")


@q("bucket_floor", f"""
WITH {_LATEST}
SELECT split_part(ors_id, '#', 3) AS site, {_b('arrival')} AS slot, count(*) AS entries FROM lv GROUP BY ALL""",
   ["visits"])
def bucket_floor_q(spark, base):
    lv = _lv(spark, base)
    return lv.groupBy(key_part("ors_id", 2).alias("site"), bucket_floor("arrival", 900).alias("slot")).agg(
        F.count(F.lit(1)).alias("entries"))


_SPLIT_SQL = f"""
WITH {_LATEST},
x AS (SELECT visit_id, split_part(ors_id, '#', 3) AS site, arrival, departure,
             unnest(generate_series(date_trunc('hour', arrival), date_trunc('hour', departure), INTERVAL 1 HOUR)) AS hour
      FROM lv WHERE departure IS NOT NULL AND departure >= arrival)
SELECT visit_id, site, hour, date_sub('second', greatest(arrival, hour), least(departure, hour + INTERVAL 1 HOUR)) AS overlap_s
FROM x"""


@q("split_interval_by_hour", _SPLIT_SQL, ["visits"])
def split_interval_by_hour(spark, base):
    lv = _lv(spark, base).withColumn("site", key_part("ors_id", 2))
    return PO.split_by_hour(lv, "arrival", "departure", keep=["visit_id", "site"]).select(
        "visit_id", "site", "hour", "overlap_s")


@q("occupancy_share", f"""
WITH s AS ({_SPLIT_SQL})
SELECT site, hour, round(sum(overlap_s) / 60.0, 6) AS occupied_minutes,
  round(least(sum(overlap_s) / 3600.0, 1.0), 6) AS occupied_share
FROM s GROUP BY site, hour""", ["visits"])
def occupancy_share(spark, base):
    lv = _lv(spark, base).withColumn("site", key_part("ors_id", 2))
    s = PO.split_by_hour(lv, "arrival", "departure", keep=["visit_id", "site"])
    h = PO.hourly_share(s, ["site"])
    return h.select("site", "hour", r6("occupied_minutes").alias("occupied_minutes"),
                    r6("occupied_share").alias("occupied_share"))


_SENSOR_SQL = f"""
SELECT device_id AS bay, {_b('ts', 10800)} + INTERVAL 3 HOUR AS view_time,
  max(CASE WHEN split_part(ors_id, '#', 3) IN ('view', 'click') THEN ts END) AS last_message
FROM plate_events GROUP BY ALL"""


def sensor_status(spark, base):
    """Bay status snapshots every 3 hours: view time and latest healthy message."""
    p = D.plate_events(spark, base)
    return p.groupBy(F.col("device_id").alias("bay"),
                     (bucket_floor("ts", 10800) + F.expr("INTERVAL 3 hours")).alias("view_time")).agg(
        F.max(F.when(key_part("ors_id", 2).isin("view", "click"), F.col("ts"))).alias("last_message"))


@q("expand_status", f"""
WITH s AS ({_SENSOR_SQL})
SELECT bay, date_trunc('hour', view_time) + to_hours(i) AS hour,
  CASE WHEN last_message IS NOT NULL AND date_diff('minute', last_message, view_time) <= 150 THEN 1 ELSE 0 END AS online
FROM s, (SELECT unnest([0, 1, 2]) AS i)""", ["plate_events"])
def expand_status(spark, base):
    s = sensor_status(spark, base)
    return PO.expand_status(s, "view_time", "last_message", hours=3, max_age_minutes=150, keep=["bay"])


@q("dense_zero_fill", f"""
WITH {_newest('2024-01-10', '2024-01-10')},
g AS (SELECT ors_id, unnest(generate_series(TIMESTAMP '2024-01-10 00:00:00', TIMESTAMP '2024-01-10 23:59:59',
                                            INTERVAL 1 HOUR)) AS hour FROM (SELECT DISTINCT ors_id FROM visits)),
f AS (SELECT ors_id, date_trunc('hour', {_loc('arrival')}) AS hour, count(*) AS entries FROM lv GROUP BY ALL)
SELECT g.ors_id, g.hour, coalesce(f.entries, 0) AS entries FROM g LEFT JOIN f ON g.ors_id = f.ors_id AND g.hour = f.hour""",
   ["visits"])
def dense_zero_fill(spark, base):
    sites = D.visits(spark, base).select("ors_id").distinct()
    grid = PO.slot_grid(sites, "20240110", "20240110", 60, "hour")
    f = (_lv(spark, base, "20240110", "20240110").groupBy("ors_id", F.date_trunc("hour", local_time("arrival", NZ))
                                  .cast("timestamp_ntz").alias("hour"))
         .agg(F.count(F.lit(1)).alias("entries")))
    return PO.zero_fill(grid, f, ["ors_id", "hour"], ["entries"])


_BASE_SQL = f"""
{_newest('2024-01-09', '2024-01-11')},
base AS (SELECT ors_id, coalesce(in_plate, out_plate) AS plate, arrival, departure FROM lv),
ev AS (SELECT DISTINCT ors_id, plate, 'entry' AS dir, {_b(_loc('arrival'))} AS slot FROM base
       UNION
       SELECT DISTINCT ors_id, plate, 'exit' AS dir, {_b(_loc('departure'))} AS slot FROM base WHERE departure IS NOT NULL),
flows AS (SELECT ors_id, slot, count_if(dir = 'entry') AS entries, count_if(dir = 'exit') AS exits FROM ev GROUP BY ALL),
grid AS (SELECT ors_id, unnest(generate_series(TIMESTAMP '2024-01-10 00:00:00', TIMESTAMP '2024-01-11 23:59:59',
                                               INTERVAL 15 MINUTE)) AS slot FROM (SELECT DISTINCT ors_id FROM visits)),
g AS (SELECT grid.ors_id, grid.slot, coalesce(entries, 0) AS entries, coalesce(exits, 0) AS exits
      FROM grid LEFT JOIN flows ON grid.ors_id = flows.ors_id AND grid.slot = flows.slot)"""


@q("entry_exit_counts", f"""
WITH {_BASE_SQL}
SELECT ors_id, slot, entries, exits FROM flows""", ["visits"])
def entry_exit_counts(spark, base):
    return PO.flow_counts(_lv(spark, base, "20240109", "20240111"), "ors_id", "plate", "arrival", "departure", NZ)


@q("occupancy_running", f"""
WITH {_BASE_SQL},
op AS (SELECT ors_id, count_if({_b(_loc('arrival'))} <= TIMESTAMP '2024-01-09 23:45:00')
                      - count_if(departure IS NOT NULL AND {_b(_loc('departure'))} <= TIMESTAMP '2024-01-09 23:45:00') AS opening
       FROM base GROUP BY ors_id)
SELECT g.ors_id, g.slot, g.entries, g.exits,
  coalesce(op.opening, 0) + sum(g.entries - g.exits) OVER (PARTITION BY g.ors_id ORDER BY g.slot
                                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS occupancy
FROM g LEFT JOIN op ON g.ors_id = op.ors_id""", ["visits"])
def occupancy_running(spark, base):
    sites = D.visits(spark, base).select("ors_id").distinct()
    return PO.running_occupancy(_lv(spark, base, "20240109", "20240111"), sites, "ors_id", "plate", "arrival", "departure", NZ,
                                "20240110", "20240111")


@q("occupancy_daily_reset", f"""
WITH {_BASE_SQL}
SELECT ors_id, slot, entries, exits,
  sum(entries - exits) OVER (PARTITION BY ors_id, CAST(slot AS DATE) ORDER BY slot
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS occupancy
FROM g""", ["visits"])
def occupancy_daily_reset(spark, base):
    sites = D.visits(spark, base).select("ors_id").distinct()
    return PO.running_occupancy(_lv(spark, base, "20240109", "20240111"), sites, "ors_id", "plate", "arrival", "departure", NZ,
                                "20240110", "20240111", reset_daily=True)


@q("overnight_split", f"""
WITH {_LATEST},
l AS (SELECT visit_id, {_loc('arrival')} AS a, {_loc('departure')} AS d, time_bucket(INTERVAL 15 MINUTE, arrival) AS a15,
             time_bucket(INTERVAL 15 MINUTE, departure) AS d15 FROM lv)
SELECT visit_id, 'entry' AS part, strftime(a, '%Y-%m-%d') AS day, date_trunc('hour', a) AS entry_hour, a15 AS entry_slot,
  CASE WHEN CAST(a AS DATE) = CAST(d AS DATE) THEN date_trunc('hour', d) END AS exit_hour,
  CASE WHEN CAST(a AS DATE) = CAST(d AS DATE) THEN d15 END AS exit_slot FROM l
UNION ALL
SELECT visit_id, 'exit', strftime(d, '%Y-%m-%d'), NULL, NULL, date_trunc('hour', d), d15 FROM l
WHERE CAST(a AS DATE) <> CAST(d AS DATE)""", ["visits"])
def overnight_split(spark, base):
    s = PO.split_overnight(_lv(spark, base), "arrival", "departure", NZ, keep=["visit_id"])
    return s.withColumn("day", day_text("day"))
