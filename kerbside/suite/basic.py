"""Registered queries for §2.1 (scans, sinks), §2.2 (projections, filters),
§2.6 (sorts, top-k) and §2.7 (set operations)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions.timefn import between_local_days, local_time
from kerbside.functions.values import blank_to_null, key_part, recode, split_key
from kerbside.operators import windows as W
from kerbside.sources import derived as D
from kerbside.sources import sinks, versions
from kerbside.sources.tables import literal_table, run_sql, scan, scan_glob, union_orgs
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


# ------------------------------------------------------------------ §2.1

@q("scan_table", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders""")
def scan_table(spark, base):
    o = scan(spark, base, "orders")
    return o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@q("scan_wildcard", """
SELECT 'lineitem' AS shard, l_returnflag, count(*) AS n, round(sum(l_quantity), 6) AS qty
FROM lineitem GROUP BY l_returnflag""")
def scan_wildcard(spark, base):
    li = scan_glob(spark, base, "lineitem", shard_col="shard")
    return (li.groupBy("shard", "l_returnflag")
              .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 6).alias("qty")))


@q("scan_org_union", """
SELECT o_orderstatus AS org, o_orderkey, o_custkey, o_orderdate FROM orders""")
def scan_org_union(spark, base):
    o = scan(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    named = ("F", "O", "P")
    shards = {s: o.where(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in named}
    # rows of any other organisation, or of none, keep their own
    rest = o.where(F.col("o_orderstatus").isNull() | ~F.col("o_orderstatus").isin(*named)).withColumnRenamed("o_orderstatus", "org")
    return union_orgs(shards.values(), shards.keys(), org_col="org").unionByName(rest)


@q("param_query", """
SELECT split_part(ors_id, '#', 3) AS site, count(*) AS n, count(departure) AS departed FROM visits
WHERE arrival >= TIMESTAMP '2024-01-08 00:00:00' AND arrival < TIMESTAMP '2024-01-15 00:00:00'
  AND split_part(ors_id, '#', 1) = 'org3'
GROUP BY split_part(ors_id, '#', 3)""", ["visits"])
def param_query(spark, base):
    # a dashboard query: report window and organisation are bound parameters
    sql = ("SELECT split_part(ors_id, '#', 3) AS site, count(*) AS n, count(departure) AS departed FROM {v} "
           "WHERE arrival >= :start AND arrival < :end AND split_part(ors_id, '#', 1) = :org "
           "GROUP BY split_part(ors_id, '#', 3)")
    return run_sql(spark, sql, {"v": D.visits(spark, base)},
                   start=dt.datetime(2024, 1, 8), end=dt.datetime(2024, 1, 15), org="org3")


PERMIT_SCHEMA = T.StructType([
    T.StructField("org", T.StringType()), T.StructField("region", T.StringType()),
    T.StructField("site", T.StringType()), T.StructField("plate", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()), T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("permit_id", T.StringType()), T.StructField("amount", T.DoubleType()),
    T.StructField("duration", T.DoubleType()), T.StructField("source", T.StringType()),
])

_PERMIT_ROWS_SQL = """
SELECT org, region, site, plate, start_time, end_time, CAST(permit_id AS VARCHAR) AS permit_id, amount,
  CAST(NULL AS DOUBLE) AS duration, CAST(NULL AS VARCHAR) AS source FROM permits"""


@q("replace_table", _PERMIT_ROWS_SQL, ["permits"])
def replace_table(spark, base):
    path = sinks.scratch_table_path(spark, "permits")
    versions.publish(D.permits(spark, base), path, PERMIT_SCHEMA, cluster_by=["region", "site", "start_time"], comment="permits",
                     columns={"plate": "vehicle registration", "amount": "price paid"})
    return versions.read_current(spark, path)


@q("insert_select", _PERMIT_ROWS_SQL + """
UNION ALL
SELECT org, region, site, plate, start_time, end_time, CAST(transaction_id AS VARCHAR) AS permit_id, amount,
  CAST(duration_seconds / 60 AS DOUBLE) AS duration, source FROM payments""", ["permits", "payments"])
def insert_select(spark, base):
    path = sinks.scratch_table_path(spark, "permits_payments")
    versions.publish(D.permits(spark, base), path, PERMIT_SCHEMA, cluster_by=["region", "site"])
    pay = D.payments(spark, base)
    # columns in a different order and names mapped: appended by name
    pay = pay.select("source", (F.col("duration_seconds") / 60).alias("duration"), "amount",
                     F.col("transaction_id").alias("permit_id"), "end_time", "start_time", "plate", "site",
                     "region", "org")
    versions.add_rows(pay, path)
    return versions.read_current(spark, path)


@q("ctas_clustered", """
SELECT region, site, count(*) AS permits, max(start_time) AS last_start FROM permits GROUP BY ALL""", ["permits"])
def ctas_clustered(spark, base):
    path = sinks.scratch_table_path(spark, "permit_summary")
    agg = D.permits(spark, base).groupBy("region", "site").agg(
        F.count(F.lit(1)).alias("permits"), F.max("start_time").alias("last_start"))
    versions.publish(agg, path, cluster_by=["region", "site"])
    return versions.read_current(spark, path)


# ------------------------------------------------------------------ §2.2

@q("project_alias", """
SELECT l_orderkey AS order_key, l_linenumber AS line,
  l_extendedprice * (1 - l_discount) AS revenue, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
  upper(l_returnflag) || l_linestatus AS flags
FROM lineitem""")
def project_alias(spark, base):
    li = scan(spark, base, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"),
                     F.concat(F.upper("l_returnflag"), F.col("l_linestatus")).alias("flags"))


@q("project_star_except", """
SELECT * EXCLUDE (o_totalprice, o_orderpriority) REPLACE (lower(o_orderstatus) AS o_orderstatus) FROM orders""")
def project_star_except(spark, base):
    o = scan(spark, base, "orders")
    return o.drop("o_totalprice", "o_orderpriority").withColumn("o_orderstatus", F.lower("o_orderstatus"))


@q("project_typed_null", """
SELECT plate, start_time, end_time, amount, CAST(NULL AS DOUBLE) AS duration, CAST(NULL AS VARCHAR) AS source,
  'permit' AS kind FROM permits""", ["permits"])
def project_typed_null(spark, base):
    p = D.permits(spark, base)
    return p.select("plate", "start_time", "end_time", "amount", F.lit(None).cast("double").alias("duration"),
                    F.lit(None).cast("string").alias("source"), F.lit("permit").alias("kind"))


@q("project_nested", """
SELECT DISTINCT order_key, plate, vehicle_state, site_ref, site_name FROM case_lines""", ["case_lines"])
def project_nested(spark, base):
    c = D.cases(spark, base, with_breaches=False)
    return c.select("order_key", F.col("vehicle.plate").alias("plate"), F.col("vehicle.state").alias("vehicle_state"),
                    F.col("groups")[0]["group_ref"].alias("site_ref"), F.col("groups")[0]["name"].alias("site_name"))


@q("filter_local_date", """
SELECT v.rev_id, v.ors_id, z.timezone, timezone(z.timezone, v.arrival AT TIME ZONE 'UTC') AS local_arrival
FROM visits v JOIN org_timezone z ON split_part(v.ors_id, '#', 1) = z.org
WHERE CAST(timezone(z.timezone, v.arrival AT TIME ZONE 'UTC') AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
   ["visits", "org_timezone"])
def filter_local_date(spark, base):
    v = D.visits(spark, base).withColumn("org", key_part("ors_id", 0))
    z = D.org_timezone(spark)
    j = v.join(z, "org")
    j = j.where(between_local_days("arrival", F.col("timezone"), "20240110", "20240112"))
    return j.select("rev_id", "ors_id", "timezone", local_time("arrival", F.col("timezone")).alias("local_arrival"))


@q("filter_between_in_like", """
SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part
WHERE p_size BETWEEN 5 AND 25 AND p_type IN ('ECONOMY', 'SMALL') AND p_name LIKE '%bolt%'
  AND NOT starts_with(p_brand, 'Brand#1')""")
def filter_between_in_like(spark, base):
    p = scan(spark, base, "part")
    return (p.where(F.col("p_size").between(5, 25) & F.col("p_type").isin("ECONOMY", "SMALL")
                    & F.col("p_name").like("%bolt%") & ~F.col("p_brand").startswith("Brand#1"))
             .select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))


@q("filter_null_tests", """
SELECT rev_id, in_plate, departure, nullif(trim(in_make), '') AS in_make FROM visits
WHERE in_plate IS NOT NULL AND (departure IS NULL OR nullif(trim(in_make), '') IS NULL)""", ["visits"])
def filter_null_tests(spark, base):
    v = D.visits(spark, base).withColumn("in_make", blank_to_null("in_make"))
    return (v.where(F.col("in_plate").isNotNull() & (F.col("departure").isNull() | F.col("in_make").isNull()))
             .select("rev_id", "in_plate", "departure", "in_make"))


@q("filter_three_valued", """
WITH c AS (SELECT DISTINCT order_key, state, substate FROM case_lines)
SELECT state,
  count_if(NOT (state = 'Closed' AND substate = 'paid')) AS not_both,
  count_if(state <> 'Closed' AND substate <> 'paid') AS neither,
  count(*) AS n
FROM c GROUP BY state""", ["case_lines"])
def filter_three_valued(spark, base):
    c = D.cases(spark, base, with_breaches=False).select("state", "substate")
    return c.groupBy("state").agg(
        F.count_if(~((F.col("state") == "Closed") & (F.col("substate") == "paid"))).alias("not_both"),
        F.count_if((F.col("state") != "Closed") & (F.col("substate") != "paid")).alias("neither"),
        F.count(F.lit(1)).alias("n"))


@q("filter_interval_overlap", """
SELECT permit_id, plate, start_time, end_time FROM permits
WHERE start_time <= TIMESTAMP '2000-03-31 23:59:59' AND end_time >= TIMESTAMP '2000-01-01 00:00:00'""", ["permits"])
def filter_interval_overlap(spark, base):
    p = D.permits(spark, base)
    lo, hi = dt.datetime(2000, 1, 1), dt.datetime(2000, 3, 31, 23, 59, 59)
    return (p.where((F.col("start_time") <= F.lit(hi).cast("timestamp_ntz"))
                    & (F.col("end_time") >= F.lit(lo).cast("timestamp_ntz")))
             .select("permit_id", "plate", "start_time", "end_time"))


@q("filter_case_predicate", """
SELECT f.visit_key, f.site_key, strftime(f.entry_date, '%Y-%m-%d') AS entry_day,
  strftime(c.transition_date, '%Y-%m-%d') AS transition_day
FROM fact_visit f LEFT JOIN cutover c ON f.site_key = c.site_key
WHERE CASE WHEN c.transition_date IS NULL THEN f.entry_date < DATE '1998-01-01'
           WHEN f.entry_date >= c.transition_date THEN TRUE END""", ["fact_visit", "cutover"])
def filter_case_predicate(spark, base):
    f = D.fact_visit(spark, base).select("visit_key", "site_key", "entry_date")
    c = D.cutover(spark, base)
    j = f.join(c, "site_key", "left")
    pred = (F.when(F.col("transition_date").isNull(), F.col("entry_date") < F.lit(dt.date(1998, 1, 1)))
             .when(F.col("entry_date") >= F.col("transition_date"), F.lit(True)))
    return j.where(pred).select("visit_key", "site_key", day_text("entry_date").alias("entry_day"),
                                day_text("transition_date").alias("transition_day"))


@q("filter_null_safe_change", """
WITH s AS (SELECT event_id, case_uri, ts, json_extract_string(data, '$.value') AS status FROM case_events),
l AS (SELECT *, lag(status) OVER (PARTITION BY case_uri ORDER BY ts, event_id) AS prev_status FROM s)
SELECT event_id, status, prev_status FROM l WHERE status IS DISTINCT FROM prev_status""", ["case_events"])
def filter_null_safe_change(spark, base):
    from kerbside.functions.values import json_text
    e = D.case_events(spark, base).select("event_id", "case_uri", "ts", json_text("data", "$.value").alias("status"))
    lagged = W.with_previous(e, "case_uri", "ts", ["status"], tiebreak="event_id")
    return (lagged.where(~F.col("status").eqNullSafe(F.col("prev_status")))
                  .select("event_id", "status", "prev_status"))


STATUS_LABELS = {"Active": ["active"], "Pending": ["created", "pending"], "Inactive": ["inactive", "deleted"]}


@q("recode_status", """
SELECT event_id, status,
  CASE WHEN lower(coalesce(status, 'active')) IN ('active') THEN 'Active'
       WHEN lower(coalesce(status, 'active')) IN ('created', 'pending') THEN 'Pending'
       WHEN lower(coalesce(status, 'active')) IN ('inactive', 'deleted') THEN 'Inactive'
       ELSE coalesce(status, 'active') END AS status_label
FROM site_status""", ["site_status"])
def recode_status(spark, base):
    s = D.site_status(spark, base)
    return s.select("event_id", "status",
                    recode(F.coalesce("status", F.lit("active")), STATUS_LABELS).alias("status_label"))


@q("tz_of_org", """
SELECT v.rev_id, split_part(v.ors_id, '#', 1) AS org, z.timezone,
  timezone(z.timezone, v.arrival AT TIME ZONE 'UTC') AS local_arrival
FROM visits v LEFT JOIN org_timezone z ON split_part(v.ors_id, '#', 1) = z.org""", ["visits", "org_timezone"])
def tz_of_org(spark, base):
    from kerbside.functions.values import with_timezone
    v = D.visits(spark, base).withColumn("org", key_part("ors_id", 0))
    v = with_timezone(v, "org", D.org_timezone(spark))
    return v.select("rev_id", "org", "timezone", local_time("arrival", F.col("timezone")).alias("local_arrival"))


@q("split_composite_key", """
SELECT rev_id, nullif(split_part(ors_id, '#', 1), '') AS org, nullif(split_part(ors_id, '#', 2), '') AS region,
  nullif(split_part(ors_id, '#', 3), '') AS site, nullif(split_part(ors_id, '#', 4), '') AS lane
FROM visits""", ["visits"])
def split_composite_key(spark, base):
    v = D.visits(spark, base).select("rev_id", "ors_id")
    return split_key(v, "ors_id", ["org", "region", "site", "lane"]).drop("ors_id")


# ------------------------------------------------------------------ §2.6

@q("sort_result", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 6) AS qty FROM lineitem
GROUP BY ALL ORDER BY l_returnflag ASC NULLS FIRST, qty DESC NULLS LAST""")
def sort_result(spark, base):
    li = scan(spark, base, "lineitem")
    agg = li.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"),
                                                          F.round(F.sum("l_quantity"), 6).alias("qty"))
    return agg.orderBy(F.col("l_returnflag").asc_nulls_first(), F.col("qty").desc_nulls_last())


@q("sort_inside_cte", """
SELECT site, count(*) AS n FROM (SELECT split_part(ors_id, '#', 3) AS site FROM visits) GROUP BY site""", ["visits"])
def sort_inside_cte(spark, base):
    # the ORDER BY inside the sub-query has no meaning; Catalyst drops it
    v = D.visits(spark, base).select(key_part("ors_id", 2).alias("site"), "arrival").orderBy("arrival")
    return v.groupBy("site").agg(F.count(F.lit(1)).alias("n"))


@q("topk", """
SELECT DISTINCT breach_id, "time" FROM ledger ORDER BY "time" DESC, breach_id DESC LIMIT 1000""", ["ledger"])
def topk(spark, base):
    lg = D.ledger(spark, base).select("breach_id", "time").distinct()
    return lg.orderBy(F.col("time").desc(), F.col("breach_id").desc()).limit(1000)


# ------------------------------------------------------------------ §2.7

@q("union_all_positional", """
SELECT ors_id AS organization, out_plate AS plate, arrival AS seen FROM visits
UNION ALL
SELECT ors_id, device_id, ts FROM plate_events""", ["visits", "plate_events"])
def union_all_positional(spark, base):
    a = D.visits(spark, base).select(F.col("ors_id").alias("organization"), F.col("out_plate").alias("plate"),
                                     F.col("arrival").alias("seen"))
    b = D.plate_events(spark, base).select("ors_id", "device_id", "ts")
    return a.union(b)


@q("union_all_aligned", """
SELECT plate, start_time, end_time, amount, CAST(NULL AS BIGINT) AS duration_seconds, kind AS source FROM permits
UNION ALL
SELECT plate, start_time, end_time, amount, duration_seconds, source FROM payments""", ["permits", "payments"])
def union_all_aligned(spark, base):
    p = D.permits(spark, base).select("plate", "start_time", "end_time", "amount", F.col("kind").alias("source"))
    y = D.payments(spark, base).select("source", "duration_seconds", "amount", "end_time", "start_time", "plate")
    return p.unionByName(y, allowMissingColumns=True)


# Weekday labels, BigQuery/Spark DAYOFWEEK numbering (1 = Sunday).
WEEKDAYS = [(1, "Sunday"), (2, "Monday"), (3, "Tuesday"), (4, "Wednesday"), (5, "Thursday"),
            (6, "Friday"), (7, "Saturday")]


@q("union_literal_rows", """
WITH labels AS (SELECT * FROM (VALUES (1, 'Sunday'), (2, 'Monday'), (3, 'Tuesday'), (4, 'Wednesday'),
                                      (5, 'Thursday'), (6, 'Friday'), (7, 'Saturday')) t(dow, label))
SELECT l.dow, l.label, count(e.event_id) AS events
FROM labels l LEFT JOIN events e ON dayofweek(e.ts) + 1 = l.dow GROUP BY ALL""")
def union_literal_rows(spark, base):
    labels = literal_table(spark, WEEKDAYS, ["dow", "label"])
    counts = scan(spark, base, "events").groupBy(F.dayofweek("ts").alias("dow")).agg(
        F.count(F.lit(1)).alias("events"))
    return (labels.join(counts, "dow", "left")
                  .select("dow", "label", F.coalesce("events", F.lit(0)).alias("events")))
