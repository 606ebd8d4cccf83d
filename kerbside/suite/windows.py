"""Registered queries for §2.5 (window functions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.functions.timefn import between_local_days, boundaries, local_date
from kerbside.functions.values import hex_to_long, json_text
from kerbside.operators import windows as W
from kerbside.sources import derived as D
from kerbside.suite.common import day_text, r6, site_cols
from kerbside.suite.oracle_inputs import with_inputs

NZ = "Pacific/Auckland"
QUERIES: dict = {}
ORACLE: dict = {}


def q(name, sql=None, inputs=()):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_inputs(sql, *inputs)
        return fn
    return deco


@q("latest_by_key", """
SELECT visit_id, rev_id, ors_id, updated, action FROM visits
QUALIFY row_number() OVER (PARTITION BY visit_id ORDER BY updated DESC, rev_id DESC) = 1""", ["visits"])
def latest_by_key(spark, base):
    v = D.visits(spark, base).select("visit_id", "rev_id", "ors_id", "updated", "action")
    return W.latest_by_key(v, "visit_id", "updated", tiebreak="rev_id")


@q("earliest_by_key", """
SELECT key, "timestamp", name, action_type, event_id FROM site_log
QUALIFY row_number() OVER (PARTITION BY key ORDER BY "timestamp", event_id) = 1""", ["site_log"])
def earliest_by_key(spark, base):
    g = D.site_log(spark, base).select("key", "timestamp", "name", "action_type", "event_id")
    return W.earliest_by_key(g, "key", "timestamp", tiebreak="event_id")


@q("dedupe_any", """
SELECT transaction_id, segment, plate, start_time, amount FROM payments
QUALIFY row_number() OVER (PARTITION BY transaction_id, segment ORDER BY plate, start_time, amount) = 1""",
   ["payments"])
def dedupe_any(spark, base):
    p = D.payments(spark, base).select("transaction_id", "segment", "plate", "start_time", "amount")
    return W.dedupe_any(p, ["transaction_id", "segment"])


@q("dedupe_two_pass", """
WITH p1 AS (
  SELECT transaction_id, segment, plate, start_time, end_time, request_time, amount FROM payments
  QUALIFY row_number() OVER (PARTITION BY transaction_id, segment ORDER BY request_time DESC, amount DESC) = 1)
SELECT transaction_id, segment, plate, start_time, end_time FROM p1
QUALIFY row_number() OVER (PARTITION BY plate, start_time ORDER BY end_time DESC, transaction_id DESC, segment DESC) = 1""",
   ["payments"])
def dedupe_two_pass(spark, base):
    p = D.payments(spark, base).select("transaction_id", "segment", "plate", "start_time", "end_time",
                                       "request_time", "amount")
    p1 = W.latest_by_key(p, ["transaction_id", "segment"], "request_time", tiebreak="amount")
    p2 = W.latest_by_key(p1, ["plate", "start_time"], "end_time", tiebreak=["transaction_id", "segment"])
    return p2.select("transaction_id", "segment", "plate", "start_time", "end_time")


@q("rank_first_in_group", """
SELECT event_id, device_id, row_number() OVER (PARTITION BY device_id ORDER BY ts, event_id) AS rn
FROM plate_events""", ["plate_events"])
def rank_first_in_group(spark, base):
    p = D.plate_events(spark, base).select("event_id", "device_id", "ts")
    return W.rank_rows(p, "device_id", "ts", ascending=True, tiebreak="event_id").drop("ts")


@q("recency_rank", """
SELECT rev_id, out_plate, row_number() OVER (PARTITION BY out_plate ORDER BY arrival DESC, rev_id DESC) AS rn
FROM visits""", ["visits"])
def recency_rank(spark, base):
    v = D.visits(spark, base).select("rev_id", "out_plate", "arrival")
    w = W.rank_rows(v, "out_plate", ["arrival", "rev_id"])
    return w.drop("arrival")


@q("lag_previous_visit", """
SELECT rev_id, out_plate, ors_id, arrival,
  lag(arrival) OVER (PARTITION BY out_plate, ors_id ORDER BY arrival, rev_id) AS prev_arrival
FROM visits""", ["visits"])
def lag_previous_visit(spark, base):
    v = D.visits(spark, base).select("rev_id", "out_plate", "ors_id", "arrival")
    return W.with_previous(v, ["out_plate", "ors_id"], "arrival", ["arrival"],
                           tiebreak="rev_id")


@q("lag_period_over_period", """
WITH m AS (
  SELECT site_key, strftime(date_trunc('month', entry_time), '%Y-%m') AS month,
         count(*) AS visits, count(DISTINCT vehicle_key) AS vehicles
  FROM fact_visit GROUP BY ALL)
SELECT site_key, month, visits, vehicles,
  lag(month) OVER w AS prev_month, lag(visits) OVER w AS prev_visits, lag(vehicles) OVER w AS prev_vehicles
FROM m WINDOW w AS (PARTITION BY site_key ORDER BY month)""", ["fact_visit"])
def lag_period_over_period(spark, base):
    f = D.fact_visit(spark, base)
    m = (f.groupBy("site_key", F.date_format("entry_time", "yyyy-MM").alias("month"))
          .agg(F.count(F.lit(1)).alias("visits"), F.count_distinct("vehicle_key").alias("vehicles")))
    return W.period_lag(m, "site_key", "month", ["month", "visits", "vehicles"])


@q("lag_global_gap", """
WITH p AS (
  SELECT event_id, device_id,
    CASE WHEN regexp_full_match(seq_hex, '[0-9A-Fa-f]+') THEN CAST('0x' || seq_hex AS BIGINT) END AS seq
  FROM plate_events)
SELECT event_id, device_id, seq,
  seq - lag(seq) OVER (ORDER BY device_id ASC NULLS FIRST, seq DESC NULLS LAST) AS gap
FROM p""", ["plate_events"])
def lag_global_gap(spark, base):
    p = D.plate_events(spark, base).select("event_id", "device_id", hex_to_long("seq_hex").alias("seq"))
    return W.sequence_gaps(p, "device_id", "seq", descending=True)


@q("lag_device_gap", """
WITH p AS (
  SELECT event_id, device_id,
    CASE WHEN regexp_full_match(seq_hex, '[0-9A-Fa-f]+') THEN CAST('0x' || seq_hex AS BIGINT) END AS seq
  FROM plate_events)
SELECT event_id, device_id, seq,
  seq - lag(seq) OVER (PARTITION BY device_id ORDER BY seq DESC NULLS LAST) AS gap
FROM p""", ["plate_events"])
def lag_device_gap(spark, base):
    # the per-camera gap (the evident intent): the first read of each camera has none
    p = D.plate_events(spark, base).select("event_id", "device_id", hex_to_long("seq_hex").alias("seq"))
    return W.sequence_gaps(p, "device_id", "seq", descending=True, reset=True)


_STATUS_SQL = """
SELECT case_uri, event_id, ts, strftime(CAST(timezone('Pacific/Auckland', ts AT TIME ZONE 'UTC') AS DATE), '%Y-%m-%d') AS day,
  coalesce(json_extract_string(data, '$.tags.correspondence'), json_extract_string(data, '$.value')) AS status
FROM case_events
WHERE type IN ('StatusChanged', 'CorrespondenceAdded')
  AND CAST(timezone('Pacific/Auckland', ts AT TIME ZONE 'UTC') AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"""


def _status_rows(spark, base):
    e = D.case_events(spark, base)
    e = e.where(F.col("type").isin("StatusChanged", "CorrespondenceAdded")
                & between_local_days("ts", NZ, "20240105", "20240125"))
    return e.select("case_uri", "event_id", "ts", day_text(local_date("ts", NZ)).alias("day"),
                    F.coalesce(json_text("data", "$.tags.correspondence"), json_text("data", "$.value"))
                    .alias("status"))


@q("lag_status_change", f"""
WITH s AS ({_STATUS_SQL}),
o AS (SELECT *, lag(status) OVER (PARTITION BY case_uri ORDER BY ts, event_id) AS prev_status FROM s)
SELECT day,
  sum(CASE WHEN status = 'Open' AND prev_status IS DISTINCT FROM 'Open' THEN 1 ELSE 0 END) AS opened,
  sum(CASE WHEN status = 'Resolved' AND prev_status IS DISTINCT FROM 'Resolved' THEN 1 ELSE 0 END) AS resolved
FROM o GROUP BY day""", ["case_events"])
def lag_status_change(spark, base):
    from kerbside.plans.backlog import status_transitions
    return status_transitions(_status_rows(spark, base), "case_uri", "ts", "status", "day",
                              {"opened": "Open", "resolved": "Resolved"}, tiebreak="event_id")


@q("lead_next_state", """
WITH s AS (
  SELECT event_id, case_uri, ts, author, json_extract_string(data, '$.value') AS status
  FROM case_events WHERE type = 'StatusChanged'),
n AS (
  SELECT *, lead(status) OVER w AS next_status, lead(author) OVER w AS next_author, lead(ts) OVER w AS next_ts
  FROM s WINDOW w AS (PARTITION BY case_uri ORDER BY ts, event_id))
SELECT event_id, status, next_status, next_author, next_ts,
  date_diff('day', ts, next_ts) AS days_to_next, date_diff('hour', ts, next_ts) AS hours_to_next
FROM n""", ["case_events"])
def lead_next_state(spark, base):
    e = (D.case_events(spark, base).where(F.col("type") == "StatusChanged")
         .select("event_id", "case_uri", "ts", "author", json_text("data", "$.value").alias("status")))
    n = W.with_next(e.withColumn("next_ts0", F.col("ts")), "case_uri", "ts", ["status", "author", "next_ts0"],
                    tiebreak="event_id")
    n = n.withColumnRenamed("next_next_ts0", "next_ts")
    return n.select("event_id", "status", "next_status", "next_author", "next_ts",
                    boundaries("day", "ts", "next_ts").alias("days_to_next"),
                    boundaries("hour", "ts", "next_ts").alias("hours_to_next"))


@q("first_value_ignore_nulls", """
SELECT event_id, case_uri,
  first_value(author IGNORE NULLS) OVER (PARTITION BY case_uri ORDER BY ts, event_id
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS first_author
FROM case_events""", ["case_events"])
def first_value_ignore_nulls(spark, base):
    e = D.case_events(spark, base).select("event_id", "case_uri", "ts", "author")
    out = W.first_non_null_after(e, "case_uri", ["ts", "event_id"], "author", "first_author")
    return out.select("event_id", "case_uri", "first_author")


_DAILY_NET_SQL = """
SELECT CAST(timezone('Pacific/Auckland', ts AT TIME ZONE 'UTC') AS DATE) AS d,
  count_if(type = 'CaseCreated') AS opened,
  count_if(type = 'StatusChanged' AND json_extract_string(data, '$.value') = 'Closed') AS closed
FROM case_events GROUP BY d"""


def _daily_net(spark, base):
    e = D.case_events(spark, base)
    return (e.groupBy(local_date("ts", NZ).alias("d"))
             .agg(F.count_if(F.col("type") == "CaseCreated").alias("opened"),
                  F.count_if((F.col("type") == "StatusChanged") & (json_text("data", "$.value") == "Closed"))
                  .alias("closed"))
             .withColumn("net", F.col("opened") - F.col("closed")))


@q("running_sum_global", f"""
WITH d AS ({_DAILY_NET_SQL})
SELECT strftime(d, '%Y-%m-%d') AS day, opened, closed,
  sum(opened - closed) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open_balance
FROM d""", ["case_events"])
def running_sum_global(spark, base):
    d = _daily_net(spark, base)
    r = W.running_total(d, "d", "net", name="open_balance", bucket=F.trunc("d", "month"))
    return r.select(day_text("d").alias("day"), "opened", "closed", "open_balance")


@q("running_sum_partition", """
WITH h AS (
  SELECT split_part(ors_id, '#', 3) AS site, date_trunc('hour', arrival) AS hour, count(*) AS entries
  FROM visits GROUP BY ALL)
SELECT site, hour, entries,
  sum(entries) OVER (PARTITION BY site, CAST(hour AS DATE) ORDER BY hour
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS day_entries
FROM h""", ["visits"])
def running_sum_partition(spark, base):
    v = site_cols(D.visits(spark, base))
    h = v.groupBy("site", F.date_trunc("hour", "arrival").cast("timestamp_ntz").alias("hour")).agg(
        F.count(F.lit(1)).alias("entries"))
    h = h.withColumn("day", F.to_date("hour"))
    return W.running_total(h, "hour", "entries", name="day_entries", keys=["site", "day"]).drop("day")


@q("running_with_opening", f"""
WITH d AS ({_DAILY_NET_SQL}),
o AS (SELECT coalesce(sum(opened - closed), 0) AS opening FROM d WHERE d < DATE '2024-01-10')
SELECT strftime(d, '%Y-%m-%d') AS day, opened - closed AS net,
  sum(opened - closed) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + (SELECT opening FROM o) AS balance
FROM d WHERE d BETWEEN DATE '2024-01-10' AND DATE '2024-01-25'""", ["case_events"])
def running_with_opening(spark, base):
    import datetime as dt
    d = _daily_net(spark, base)
    start, end = dt.date(2024, 1, 10), dt.date(2024, 1, 25)
    opening = d.where(F.col("d") < F.lit(start)).agg(F.coalesce(F.sum("net"), F.lit(0)).alias("opening"))
    rng = d.where(F.col("d").between(F.lit(start), F.lit(end)))
    r = W.running_total(rng, "d", "net", name="balance", opening=opening)
    return r.select(day_text("d").alias("day"), "net", "balance")


@q("sum_over_partition", """
SELECT rev_id, out_plate,
  round(sum(CASE WHEN action <> 'deleted' THEN coalesce(round((epoch(departure) - epoch(arrival)) / 60.0, 1), 0) ELSE 0 END)
        OVER (PARTITION BY out_plate), 6) AS plate_minutes
FROM visits""", ["visits"])
def sum_over_partition(spark, base):
    from kerbside.functions.timefn import stay_minutes
    v = D.visits(spark, base)
    v = v.select("rev_id", "out_plate",
                 F.when(F.col("action") != "deleted", stay_minutes("arrival", "departure")).otherwise(0.0)
                 .alias("m"))
    return W.total_over(v, "out_plate", "m", "plate_minutes").select(
        "rev_id", "out_plate", r6("plate_minutes").alias("plate_minutes"))


_DAILY_RATE_SQL = """
SELECT org, region, site, CAST(timezone('Pacific/Auckland', start_time AT TIME ZONE 'UTC') AS DATE) AS d,
  sum(accepted) / nullif(sum(total), 0) AS rate, sum(total) AS footfall
FROM process_metrics GROUP BY ALL"""


def daily_rate(spark, base):
    p = D.process_metrics(spark, base)
    return (p.groupBy("org", "region", "site", local_date("start_time", NZ).alias("d"))
             .agg(F.try_divide(F.sum("accepted"), F.sum("total")).alias("rate"), F.sum("total").alias("footfall")))


@q("rolling_array", f"""
WITH d AS ({_DAILY_RATE_SQL}),
h AS (SELECT *, list(coalesce(rate, 0)) OVER (PARTITION BY site ORDER BY d, org, region
        ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS prev FROM d)
SELECT org, region, site, strftime(d, '%Y-%m-%d') AS day, round(rate, 6) AS rate,
  array_to_string(list_transform(prev, lambda x: CAST(CAST(x AS DECIMAL(12, 6)) AS VARCHAR)), ',') AS prev_rates
FROM h""", ["process_metrics"])
def rolling_array(spark, base):
    d = daily_rate(spark, base).withColumn("r0", F.coalesce("rate", F.lit(0.0)))
    h = W.rolling_values(d, "site", ["d", "org", "region"], "r0", 30, name="prev")
    txt = F.array_join(F.transform("prev", lambda x: x.cast("decimal(12,6)").cast("string")), ",")
    return h.select("org", "region", "site", day_text("d").alias("day"), r6("rate").alias("rate"),
                    txt.alias("prev_rates"))


@q("percentile_band", f"""
WITH d AS ({_DAILY_RATE_SQL})
SELECT org, region, site, strftime(d, '%Y-%m-%d') AS day, round(rate, 6) AS rate,
  round(quantile_cont(rate, 0.05) OVER (PARTITION BY site), 6) AS lower_band,
  round(quantile_cont(rate, 0.95) OVER (PARTITION BY site), 6) AS upper_band
FROM d""", ["process_metrics"])
def percentile_band(spark, base):
    d = daily_rate(spark, base)
    b = W.percentile_band(d, "site", "rate", 0.05, 0.95, names=("lo", "hi"))
    return b.select("org", "region", "site", day_text("d").alias("day"), r6("rate").alias("rate"),
                    r6("lo").alias("lower_band"), r6("hi").alias("upper_band"))
