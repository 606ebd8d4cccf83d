"""Registered queries for §2.8: the scalar-function vocabulary, one table
query per family (string, date/time, bucket, JSON, NULL/math)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.functions import timefn as T
from kerbside.functions import values as V
from kerbside.sources import derived as D
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


@q("fn_string", """
SELECT rev_id, nullif(split_part(ors_id, '#', 3), '') AS site, concat(out_plate, '@', nullif(split_part(ors_id, '#', 3), '')) AS plate_at,
  substr(out_plate, 2) AS plate_no, lower(ors_id) AS ors_lower, upper(out_make) AS make_upper, trim(in_make) AS in_make,
  replace(ors_id, '#', '/') AS ors_path, regexp_replace(ors_id, '[0-9]+', 'N', 'g') AS ors_shape,
  starts_with(ors_id, 'org1') AS org1, contains(lower(ors_id), lower('CLICK')) AS is_click,
  sha256(ors_id) AS ors_hash, length(out_plate) AS plate_len
FROM visits""", ["visits"])
def fn_string(spark, base):
    v = D.visits(spark, base)
    site = V.key_part("ors_id", 2)
    return v.select(
        "rev_id", site.alias("site"), F.concat("out_plate", F.lit("@"), site).alias("plate_at"),
        F.expr("substring(out_plate, 2)").alias("plate_no"), F.lower("ors_id").alias("ors_lower"),
        F.upper("out_make").alias("make_upper"), F.trim("in_make").alias("in_make"),
        F.replace("ors_id", F.lit("#"), F.lit("/")).alias("ors_path"),
        F.regexp_replace("ors_id", "[0-9]+", "N").alias("ors_shape"),
        F.col("ors_id").startswith("org1").alias("org1"), V.contains_ci("ors_id", "CLICK").alias("is_click"),
        F.sha2("ors_id", 256).alias("ors_hash"), F.length("out_plate").alias("plate_len"))


@q("fn_datetime", """
SELECT rev_id,
  strftime(CAST(arrival AS DATE), '%Y-%m-%d') AS utc_day,
  timezone('Europe/London', arrival AT TIME ZONE 'UTC') AS london_time,
  strftime(CAST(timezone('Pacific/Auckland', arrival AT TIME ZONE 'UTC') AS DATE), '%Y-%m-%d') AS nz_day,
  strftime(CAST(strptime(strftime(arrival, '%Y%m%d'), '%Y%m%d') AS DATE), '%Y-%m-%d') AS parsed_day,
  strftime(arrival, '%A') AS weekday, strftime(arrival, '%Y-%m') AS month_text,
  strftime(CAST(CAST(arrival AS DATE) + INTERVAL 1 MONTH AS DATE), '%Y-%m-%d') AS next_month_day,
  strftime(CAST(arrival AS DATE) - 7, '%Y-%m-%d') AS week_before,
  date_diff('hour', arrival, departure) AS hours_boundary, date_sub('minute', arrival, departure) AS minutes_elapsed,
  date_trunc('hour', arrival) AS hour_start, year(arrival) AS yr, month(arrival) AS mon, hour(arrival) AS hr,
  dayofweek(arrival) + 1 AS dow,
  (dayofyear(arrival) + 6 - dayofweek(arrival)) // 7 AS week_sun,
  (dayofyear(arrival) + 6 - (isodow(arrival) - 1)) // 7 AS week_mon,
  CAST(floor(epoch(arrival)) AS BIGINT) AS unix_s,
  strftime(arrival, '%H:%M') AS hhmm
FROM visits""", ["visits"])
def fn_datetime(spark, base):
    v = D.visits(spark, base)
    d = F.to_date("arrival")
    return v.select(
        "rev_id", day_text(d).alias("utc_day"), T.local_time("arrival", "Europe/London").alias("london_time"),
        day_text(T.local_date("arrival", "Pacific/Auckland")).alias("nz_day"),
        day_text(F.to_date(F.date_format("arrival", "yyyyMMdd"), "yyyyMMdd")).alias("parsed_day"),
        F.date_format("arrival", "EEEE").alias("weekday"), F.date_format("arrival", "yyyy-MM").alias("month_text"),
        day_text(F.add_months(d, 1)).alias("next_month_day"), day_text(F.date_sub(d, 7)).alias("week_before"),
        T.boundaries("hour", "arrival", "departure").alias("hours_boundary"),
        T.elapsed("minute", "arrival", "departure").alias("minutes_elapsed"),
        F.date_trunc("hour", "arrival").cast("timestamp_ntz").alias("hour_start"),
        F.year("arrival").alias("yr"), F.month("arrival").alias("mon"), F.hour("arrival").alias("hr"),
        F.dayofweek("arrival").alias("dow"), T.week_sunday(d).alias("week_sun"), T.week_monday(d).alias("week_mon"),
        F.unix_seconds(F.col("arrival").cast("timestamp")).alias("unix_s"), T.hhmm("arrival").alias("hhmm"))


@q("fn_bucket", """
SELECT rev_id,
  make_timestamp(CAST(floor(epoch(arrival) / 900) * 900 AS BIGINT) * 1000000) AS slot_15m,
  make_timestamp(CAST(floor(epoch(arrival) / 10800) * 10800 AS BIGINT) * 1000000) AS slot_3h,
  strftime(make_timestamp(CAST(floor(epoch(arrival) / 900) * 900 AS BIGINT) * 1000000), '%H:%M') AS slot_label,
  CAST(floor(epoch(arrival)) AS BIGINT) // 900 AS slot_no
FROM visits""", ["visits"])
def fn_bucket(spark, base):
    v = D.visits(spark, base)
    s15 = T.bucket_floor("arrival", 900)
    return v.select("rev_id", s15.alias("slot_15m"), T.bucket_floor("arrival", 10800).alias("slot_3h"),
                    T.hhmm(s15).alias("slot_label"),
                    F.expr("unix_seconds(CAST(arrival AS TIMESTAMP)) div 900").alias("slot_no"))


@q("fn_json", """
SELECT event_id, json_extract_string(json, '$.bays') AS bays_text, TRY_CAST(json_extract_string(json, '$.bays') AS INTEGER) AS bays,
  json_extract(json, '$.bays')::VARCHAR AS bays_raw, json_extract_string(json, '$.tags') AS tags,
  json_extract_string(json, '$.tags[0]') AS first_tag, CAST(json_extract_string(json, '$.lat') AS DOUBLE) AS lat,
  json_extract_string(json, '$.missing') AS missing
FROM site_log""", ["site_log"])
def fn_json(spark, base):
    g = D.site_log(spark, base)
    return g.select("event_id", V.json_text("json", "$.bays").alias("bays_text"),
                    V.json_text("json", "$.bays").try_cast("int").alias("bays"),
                    V.json_raw("json", "$.bays").alias("bays_raw"), V.json_text("json", "$.tags").alias("tags"),
                    V.json_text("json", "$.tags[0]").alias("first_tag"),
                    V.json_text("json", "$.lat").cast("double").alias("lat"),
                    V.json_text("json", "$.missing").alias("missing"))


@q("fn_null_math", """
SELECT v.rev_id,
  CASE WHEN v.arrival IS NULL OR v.departure IS NULL THEN NULL ELSE least(v.arrival, v.departure) END AS first_seen,
  CASE WHEN v.arrival IS NULL OR v.departure IS NULL THEN NULL ELSE greatest(v.arrival, v.updated, v.departure) END AS last_seen,
  coalesce(v.departure, v.updated) AS end_or_update, nullif(v.in_plate, v.out_plate) AS plate_changed,
  round(p.accepted / nullif(p.total, 0), 6) AS ratio, p.event_id // 7 AS week_no, floor(p.event_id / 7.0) AS week_floor,
  round(p.total / 3, 2) AS third, TRY_CAST(nullif(trim(v.in_make), '') AS INTEGER) AS make_no,
  CASE WHEN regexp_full_match(e.seq_hex, '[0-9A-Fa-f]+') THEN CAST('0x' || e.seq_hex AS BIGINT) END AS seq
FROM visits v JOIN process_metrics p ON v.rev_id = p.event_id JOIN plate_events e ON e.event_id = v.rev_id""",
   ["visits", "process_metrics", "plate_events"])
def fn_null_math(spark, base):
    v = D.visits(spark, base)
    p = D.process_metrics(spark, base).withColumnRenamed("event_id", "rev_id")
    e = D.plate_events(spark, base).select(F.col("event_id").alias("rev_id"), "seq_hex")
    j = v.join(p, "rev_id").join(e, "rev_id")
    return j.select(
        "rev_id", V.least_strict("arrival", "departure").alias("first_seen"),
        V.greatest_strict("arrival", "updated", "departure").alias("last_seen"),
        F.coalesce("departure", "updated").alias("end_or_update"),
        F.nullif("in_plate", "out_plate").alias("plate_changed"),
        F.round(V.safe_ratio("accepted", "total"), 6).alias("ratio"), F.expr("rev_id div 7").alias("week_no"),
        F.floor(F.col("rev_id") / 7.0).cast("double").alias("week_floor"),
        F.round(F.col("total") / 3, 2).alias("third"),
        V.blank_to_null("in_make").try_cast("int").alias("make_no"), V.hex_to_long("seq_hex").alias("seq"))
