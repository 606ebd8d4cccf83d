"""Registered queries for §2.4 (aggregations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.functions.timefn import local_date
from kerbside.functions.values import json_text, key_part, safe_ratio
from kerbside.operators import aggregates as A
from kerbside.sources import derived as D
from kerbside.sources.tables import scan
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


@q("agg_basic", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 6) AS sum_qty, count(*) AS n,
  min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, round(avg(l_extendedprice), 6) AS avg_price
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_basic(spark, base):
    li = scan(spark, base, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 6).alias("sum_qty"), F.count(F.lit(1)).alias("n"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
        F.round(F.avg("l_extendedprice"), 6).alias("avg_price"))


@q("agg_by_expression", """
SELECT split_part(ors_id, '#', 3) AS site, hour(arrival) AS hour_of_day, count(*) AS visits
FROM visits GROUP BY ALL""", ["visits"])
def agg_by_expression(spark, base):
    v = D.visits(spark, base)
    return v.groupBy(key_part("ors_id", 2).alias("site"), F.hour("arrival").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("visits"))


@q("agg_group_all", """
SELECT l_returnflag, year(l_shipdate) AS yr, count(*) AS n FROM lineitem GROUP BY ALL""")
def agg_group_all(spark, base):
    return spark.sql("SELECT l_returnflag, year(l_shipdate) AS yr, count(*) AS n FROM {li} GROUP BY ALL",
                     li=scan(spark, base, "lineitem"))


@q("agg_count_distinct", """
SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS events FROM events GROUP BY event_type""")
def agg_count_distinct(spark, base):
    e = scan(spark, base, "events")
    return e.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("events"))


@q("agg_count_if", """
SELECT split_part(ors_id, '#', 3) AS site, count_if(action = 'deleted') AS deleted,
  count_if(departure IS NULL) AS open_stays, count(*) AS n
FROM visits GROUP BY ALL""", ["visits"])
def agg_count_if(spark, base):
    v = D.visits(spark, base)
    return v.groupBy(key_part("ors_id", 2).alias("site")).agg(
        F.count_if(F.col("action") == "deleted").alias("deleted"),
        F.count_if(F.col("departure").isNull()).alias("open_stays"), F.count(F.lit(1)).alias("n"))


@q("agg_sum_if", """
SELECT ors_id, sum(CASE WHEN entry THEN 1 ELSE 0 END) AS entries, sum(CASE WHEN NOT entry THEN 1 ELSE 0 END) AS exits,
  sum(CASE WHEN lower(device_id) = 'Cam1' THEN 1 ELSE 0 END) AS never_matches
FROM plate_events GROUP BY ors_id""", ["plate_events"])
def agg_sum_if(spark, base):
    # lower-cased text compared with a mixed-case literal never matches;
    # kept to mirror the reference's behaviour (always 0)
    p = D.plate_events(spark, base)
    return p.groupBy("ors_id").agg(
        F.sum(F.when(F.col("entry"), 1).otherwise(0)).alias("entries"),
        F.sum(F.when(~F.col("entry"), 1).otherwise(0)).alias("exits"),
        F.sum(F.when(F.lower("device_id") == "Cam1", 1).otherwise(0)).alias("never_matches"))


@q("agg_distinct_if", """
WITH c AS (SELECT DISTINCT order_key, id, state, substate, case_ts FROM case_lines)
SELECT strftime(case_ts, '%Y-%m') AS month,
  count(DISTINCT CASE WHEN state = 'Closed' THEN id END) AS closed_cases,
  count(DISTINCT CASE WHEN substate = 'paid' THEN id END) AS paid_cases,
  count(DISTINCT id) AS cases
FROM c GROUP BY month""", ["case_lines"])
def agg_distinct_if(spark, base):
    c = D.cases(spark, base, with_breaches=False)
    return c.groupBy(F.date_format("case_ts", "yyyy-MM").alias("month")).agg(
        F.count_distinct(F.when(F.col("state") == "Closed", F.col("id"))).alias("closed_cases"),
        F.count_distinct(F.when(F.col("substate") == "paid", F.col("id"))).alias("paid_cases"),
        F.count_distinct("id").alias("cases"))


@q("agg_safe_ratio", """
SELECT org, site, sum(accepted) AS accepted, sum(total) AS total,
  round(sum(accepted) / nullif(sum(total), 0), 6) AS match_rate
FROM process_metrics GROUP BY org, site""", ["process_metrics"])
def agg_safe_ratio(spark, base):
    p = D.process_metrics(spark, base)
    return p.groupBy("org", "site").agg(
        F.sum("accepted").alias("accepted"), F.sum("total").alias("total"),
        F.round(safe_ratio(F.sum("accepted"), F.sum("total")), 6).alias("match_rate"))


@q("agg_array", """
SELECT out_plate, strftime(CAST(arrival AS DATE), '%Y-%m-%d') AS day,
  array_to_string(list_sort(list(DISTINCT split_part(ors_id, '#', 3))), ',') AS sites,
  array_to_string(list_sort(list(DISTINCT in_plate) FILTER (WHERE in_plate IS NOT NULL)), ',') AS in_plates,
  array_to_string(list_sort(list(CASE WHEN action = 'deleted' THEN CAST(rev_id AS VARCHAR) END)
                            FILTER (WHERE action = 'deleted')), ',') AS deleted_revs
FROM visits GROUP BY ALL""", ["visits"])
def agg_array(spark, base):
    # arrays per plate and day: lists stay bounded by a day's visits, and the
    # value lists are DISTINCT where the report wants the set
    v = D.visits(spark, base)
    return v.groupBy("out_plate", day_text(F.to_date("arrival")).alias("day")).agg(
        A.collect_sorted_text(key_part("ors_id", 2), distinct=True).alias("sites"),
        A.collect_sorted_text("in_plate", distinct=True).alias("in_plates"),
        A.collect_sorted_text(F.when(F.col("action") == "deleted", F.col("rev_id").cast("string")))
        .alias("deleted_revs"))


@q("agg_array_concat", """
WITH s AS (SELECT CAST(timezone('Pacific/Auckland', ts AT TIME ZONE 'UTC') AS DATE) AS d,
                  json_extract_string(data, '$.value') AS status,
                  list(DISTINCT author) FILTER (WHERE author IS NOT NULL) AS authors
           FROM case_events WHERE type = 'StatusChanged' GROUP BY ALL)
SELECT strftime(d, '%Y-%m-%d') AS day, array_to_string(list_sort(flatten(list(authors))), ',') AS authors
FROM s GROUP BY d""", ["case_events"])
def agg_array_concat(spark, base):
    e = D.case_events(spark, base).where(F.col("type") == "StatusChanged")
    s = e.groupBy(local_date("ts", NZ).alias("d"), json_text("data", "$.value").alias("status")).agg(
        F.collect_set("author").alias("authors"))  # one distinct list per status; names repeat across statuses
    return s.groupBy("d").agg(F.array_join(F.sort_array(F.flatten(F.collect_list("authors"))), ",").alias("authors")) \
            .select(day_text("d").alias("day"), "authors")


@q("agg_distinct_rows", """
SELECT DISTINCT out_plate, split_part(ors_id, '#', 3) AS site FROM visits""", ["visits"])
def agg_distinct_rows(spark, base):
    return D.visits(spark, base).select("out_plate", key_part("ors_id", 2).alias("site")).distinct()


@q("agg_pivot_manual", """
SELECT strftime(ts, '%Y-%m-%d') AS day,
  count_if(json_extract_string(data, '$.label') = 'Linked') AS "Linked",
  count_if(json_extract_string(data, '$.label') = 'Resolved') AS "Resolved",
  count_if(json_extract_string(data, '$.label') = 'Unresolved') AS "Unresolved"
FROM correspondence GROUP BY day""", ["correspondence"])
def agg_pivot_manual(spark, base):
    c = D.correspondence(spark, base).select(day_text(F.to_date("ts")).alias("day"),
                                             json_text("data", "$.label").alias("label"))
    return A.pivot_counts(c, ["day"], "label", ["Linked", "Resolved", "Unresolved"])


@q("agg_two_stage", """
WITH d AS (SELECT CAST(ts AS DATE) AS d, json_extract_string(data, '$.label') AS label, count(DISTINCT uri) AS items
           FROM correspondence GROUP BY ALL)
SELECT strftime(d, '%Y-%m-%d') AS day, sum(CASE WHEN label = 'Resolved' THEN items ELSE 0 END) AS resolved,
  sum(CASE WHEN label = 'Unresolved' THEN items ELSE 0 END) AS unresolved, sum(items) AS items
FROM d GROUP BY d""", ["correspondence"])
def agg_two_stage(spark, base):
    c = D.correspondence(spark, base)
    d = c.groupBy(F.to_date("ts").alias("d"), json_text("data", "$.label").alias("label")).agg(
        F.count_distinct("uri").alias("items"))
    return d.groupBy("d").agg(
        F.sum(F.when(F.col("label") == "Resolved", F.col("items")).otherwise(0)).alias("resolved"),
        F.sum(F.when(F.col("label") == "Unresolved", F.col("items")).otherwise(0)).alias("unresolved"),
        F.sum("items").alias("items")).select(day_text("d").alias("day"), "resolved", "unresolved", "items")


@q("agg_group_then_max_rn", """
WITH r AS (SELECT out_plate, split_part(ors_id, '#', 3) AS site, CAST(arrival AS DATE) AS d,
                  row_number() OVER (PARTITION BY out_plate ORDER BY arrival DESC, rev_id DESC) AS rn FROM visits)
SELECT DISTINCT out_plate, site, strftime(d, '%Y-%m-%d') AS day, rn FROM r""", ["visits"])
def agg_group_then_max_rn(spark, base):
    # GROUP BY every column including rn with MAX(rn): only duplicate removal
    from kerbside.operators.windows import rank_rows
    v = D.visits(spark, base).select("out_plate", key_part("ors_id", 2).alias("site"), "arrival", "rev_id")
    r = rank_rows(v, "out_plate", ["arrival", "rev_id"])
    return r.select("out_plate", "site", day_text(F.to_date("arrival")).alias("day"), "rn").dropDuplicates()


@q("agg_consolidate_segments", """
SELECT transaction_id, plate, min(start_time) AS start_time, max(end_time) AS end_time,
  sum(duration_seconds) AS duration_seconds, round(sum(amount), 6) AS amount, round(max(total_amount), 6) AS total_amount
FROM payments GROUP BY transaction_id, plate""", ["payments"])
def agg_consolidate_segments(spark, base):
    p = D.payments(spark, base)
    c = A.consolidate(p, ["transaction_id", "plate"], "start_time", "end_time", "duration_seconds", "amount", "sum",
                      extra={"total_amount": F.max("total_amount")})
    return c.select("transaction_id", "plate", "start_time", "end_time", "duration_seconds",
                    r6("amount").alias("amount"), r6("total_amount").alias("total_amount"))
