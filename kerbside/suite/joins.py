"""Registered queries for §2.3 (joins, semi/anti, unnest, interval joins)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kerbside.functions.values import key_part
from kerbside.operators import joins as J
from kerbside.operators import sweep as S
from kerbside.operators import windows as W
from kerbside.sources import derived as D
from kerbside.sources.tables import scan
from kerbside.suite.common import day_text, r6
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


@q("join_inner", """
SELECT o_orderkey, o_orderdate, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner(spark, base):
    o = scan(spark, base, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    c = scan(spark, base, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_orderdate", "c_name", "c_mktsegment")


@q("join_left", """
WITH d AS (SELECT ors_id, count(*) AS reads, count(received_ts) AS received,
                  avg(epoch(received_ts) - epoch(ts)) AS avg_delay_s
           FROM plate_events GROUP BY ors_id)
SELECT s.ors_id, d.reads, d.received, round(d.avg_delay_s, 6) AS avg_delay_s
FROM (SELECT DISTINCT ors_id FROM visits) s LEFT JOIN d ON s.ors_id = d.ors_id""", ["visits", "plate_events"])
def join_left(spark, base):
    p = D.plate_events(spark, base)
    d = p.groupBy("ors_id").agg(
        F.count(F.lit(1)).alias("reads"), F.count("received_ts").alias("received"),
        F.avg(F.unix_micros(F.col("received_ts").cast("timestamp")) / 1e6
              - F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("avg_delay_s"))
    s = D.visits(spark, base).select("ors_id").distinct()
    return s.join(d, "ors_id", "left").select("ors_id", "reads", "received", r6("avg_delay_s").alias("avg_delay_s"))


@q("join_star", """
SELECT f.visit_key, s.site_name, s.country, s.region_name, v.make, de.day_name AS entry_day, dx.year AS exit_year
FROM fact_visit f
LEFT JOIN dim_site s ON f.site_key = s.site_key
LEFT JOIN dim_vehicle v ON f.vehicle_key = v.vehicle_key
LEFT JOIN dim_date de ON f.entry_date = de.date
LEFT JOIN dim_date dx ON f.exit_date = dx.date""", ["fact_visit", "dim_site", "dim_vehicle", "dim_date"])
def join_star(spark, base):
    f = D.fact_visit(spark, base)
    dd = D.dim_date(spark, base)
    de = dd.select(F.col("date").alias("entry_date"), F.col("day_name").alias("entry_day"))
    dx = dd.select(F.col("date").alias("exit_date"), F.col("year").alias("exit_year"))
    s = J.star_join(f, [(D.dim_site(spark, base), "site_key", "site_key"),
                        (D.dim_vehicle(spark, base), "vehicle_key", "vehicle_key"),
                        (de, "entry_date", "entry_date"), (dx, "exit_date", "exit_date")])
    return s.select("visit_key", "site_name", "country", "region_name", "make", "entry_day", "exit_year")


@q("join_full_outer", """
WITH v AS (SELECT site_key, count(*) AS visits FROM fact_visit GROUP BY site_key)
SELECT coalesce(v.site_key, c.site_key) AS site_key, v.visits, strftime(c.transition_date, '%Y-%m-%d') AS transition_day
FROM v FULL JOIN cutover c ON v.site_key = c.site_key""", ["fact_visit", "cutover"])
def join_full_outer(spark, base):
    # visits per site, full-joined to the cut-over dates (sites on either side only)
    v = D.fact_visit(spark, base).groupBy("site_key").agg(F.count(F.lit(1)).alias("visits"))
    c = D.cutover(spark, base)
    return v.join(c, "site_key", "full").select("site_key", "visits",
                                                day_text("transition_date").alias("transition_day"))


@q("join_right_outer", """
WITH b AS (SELECT site_key, count(*) AS breaches FROM fact_visit GROUP BY site_key)
SELECT s.site_key, s.site_name, coalesce(b.breaches, 0) AS breaches
FROM b RIGHT JOIN dim_site s ON b.site_key = s.site_key""", ["fact_visit", "dim_site"])
def join_right_outer(spark, base):
    b = D.fact_visit(spark, base).groupBy("site_key").agg(F.count(F.lit(1)).alias("breaches"))
    s = D.dim_site(spark, base)
    return (b.join(s, "site_key", "right")
             .select("site_key", "site_name", F.coalesce("breaches", F.lit(0)).alias("breaches")))


@q("join_cross_grid", """
WITH sites AS (SELECT DISTINCT site_key FROM cutover),
months AS (SELECT unnest(generate_series(date_trunc('month', min(l_shipdate)), date_trunc('month', max(l_shipdate)),
                                         INTERVAL 1 MONTH)) AS m FROM lineitem),
v AS (SELECT site_key, date_trunc('month', entry_time) AS m, count(*) AS visits FROM fact_visit GROUP BY ALL)
SELECT s.site_key, strftime(g.m, '%Y-%m') AS month, coalesce(v.visits, 0) AS visits
FROM sites s, months g LEFT JOIN v ON v.site_key = s.site_key AND v.m = g.m""",
   ["cutover", "fact_visit"])
def join_cross_grid(spark, base):
    from kerbside.operators.grids import entity_grid
    li = scan(spark, base, "lineitem")
    lo = li.agg(F.date_trunc("month", F.min("l_shipdate"))).scalar()
    hi = li.agg(F.date_trunc("month", F.max("l_shipdate"))).scalar()
    sites = D.cutover(spark, base).select("site_key").distinct()
    grid = entity_grid(sites, lo, hi, "1 month", "m")
    v = (D.fact_visit(spark, base).groupBy("site_key", F.date_trunc("month", "entry_time").alias("m"))
         .agg(F.count(F.lit(1)).alias("visits")))
    return (grid.join(v, ["site_key", "m"], "left")
                .select("site_key", F.date_format("m", "yyyy-MM").alias("month"),
                        F.coalesce("visits", F.lit(0)).alias("visits")))


@q("join_built_key", """
WITH v AS (SELECT ors_id, count(*) AS visits FROM visits GROUP BY ors_id),
p AS (SELECT concat(org, '#', region, '#', site) AS k, sum(total) AS total FROM process_metrics GROUP BY k)
SELECT v.ors_id, v.visits, p.total FROM v JOIN p ON v.ors_id = p.k""", ["visits", "process_metrics"])
def join_built_key(spark, base):
    # join on the parts, not on a concatenated string
    v = (D.visits(spark, base).groupBy("ors_id").agg(F.count(F.lit(1)).alias("visits"))
         .select("*", key_part("ors_id", 0).alias("org"), key_part("ors_id", 1).alias("region"),
                 key_part("ors_id", 2).alias("site")))
    p = D.process_metrics(spark, base).groupBy("org", "region", "site").agg(F.sum("total").alias("total"))
    return v.join(p, ["org", "region", "site"]).select("ors_id", "visits", "total")


@q("semi_latest_tuple", """
SELECT event_id, key, "timestamp", name FROM site_log
WHERE (key, "timestamp") IN (SELECT key, max("timestamp") FROM site_log WHERE type = 'site' GROUP BY key)""",
   ["site_log"])
def semi_latest_tuple(spark, base):
    g = D.site_log(spark, base)
    return W.latest_ties(g, "key", "timestamp", inner=F.col("type") == "site").select(
        "event_id", "key", "timestamp", "name")


@q("anti_not_in", """
SELECT order_key, id FROM (SELECT DISTINCT order_key, id FROM case_lines)
WHERE id NOT IN (SELECT id FROM case_lines WHERE canceled_reason IS NOT NULL)""", ["case_lines"])
def anti_not_in(spark, base):
    c = D.cases(spark, base, with_breaches=False)
    excluded = c.where(F.col("canceled_reason").isNotNull()).select("id")
    return J.anti_null_aware(c.select("order_key", "id"), excluded, "id")


@q("anti_not_in_with_null", """
SELECT order_key, substate FROM (SELECT DISTINCT order_key, substate FROM case_lines)
WHERE substate NOT IN (SELECT substate FROM case_lines WHERE rev = 0)""", ["case_lines"])
def anti_not_in_with_null(spark, base):
    # the list holds a NULL sub-state, so NOT IN keeps no row at all
    c = D.cases(spark, base, with_breaches=False)
    return J.anti_null_aware(c.select("order_key", "substate"), c.where(F.col("rev") == 0), "substate")


@q("anti_left_is_null", """
SELECT strftime(d.date, '%Y-%m-%d') AS day FROM dim_date d LEFT JOIN fact_visit f ON f.entry_date = d.date
WHERE f.visit_key IS NULL""", ["dim_date", "fact_visit"])
def anti_left_is_null(spark, base):
    d = D.dim_date(spark, base)
    f = D.fact_visit(spark, base).select(F.col("entry_date").alias("date"))
    return d.join(f, "date", "left_anti").select(day_text("date").alias("day"))


@q("semi_correlated_outer_pred", """
WITH b AS (SELECT id, rev, ticket_id FROM case_lines)
SELECT id, rev, ticket_id FROM b
WHERE rev = (SELECT max(c.rev) FROM case_lines c
             WHERE c.id = b.id AND c.case_ts >= TIMESTAMP '1996-01-01 00:00:00' AND b.ticket_id >= 50000)""",
   ["case_lines"])
def semi_correlated_outer_pred(spark, base):
    c = D.cases(spark, base)
    rows = J.explode_keep(c, "breaches", "b").select("id", "rev", "case_ts", F.col("b.ticket_id").alias("ticket_id"))
    # the outer-row predicate inside the sub-query moves to the outer filter
    inner = F.col("case_ts") >= F.lit(dt.datetime(1996, 1, 1)).cast("timestamp_ntz")
    heads = D.cases(spark, base, with_breaches=False).select("id", "rev", "case_ts")
    latest = W.latest_ties(heads, "id", "rev", inner=inner).select("id", "rev").distinct()
    return (rows.where(F.col("ticket_id") >= 50000)
                .join(latest, ["id", "rev"], "left_semi").select("id", "rev", "ticket_id"))


@q("interval_join", """
SELECT v.visit_order, v.visit_line, v.plate, v.arrival, p.permit_id
FROM permit_visits v LEFT JOIN permits p
  ON v.plate = p.plate AND v.arrival BETWEEN p.start_time AND coalesce(p.end_time, TIMESTAMP '2099-12-31 00:00:00')""",
   ["permit_visits", "permits"])
def interval_join(spark, base):
    v = D.permit_visits(spark, base).select("visit_order", "visit_line", "plate", "arrival")
    p = D.permits(spark, base).select("plate", "permit_id", "start_time", "end_time")
    j = S.interval_pairs(v, p, ["plate"], "arrival", "start_time", "end_time", how="left")
    return j.select("visit_order", "visit_line", "plate", "arrival", "permit_id")


@q("interval_join_either", """
SELECT p.permit_id, count(v.arrival) AS entries
FROM permits p LEFT JOIN permit_visits v ON p.plate = v.plate AND p.site = v.site
  AND (v.arrival BETWEEN p.start_time AND p.end_time OR v.departure BETWEEN p.start_time AND p.end_time)
GROUP BY p.permit_id""", ["permits", "permit_visits"])
def interval_join_either(spark, base):
    p = D.permits(spark, base).select("permit_id", "plate", "site", "start_time", "end_time")
    v = D.permit_visits(spark, base).select("plate", "site", "arrival", "departure")
    c = S.count_either(p, v, ["plate", "site"], "arrival", "departure", "start_time", "end_time", "entries")
    return c.groupBy("permit_id").agg(F.sum("entries").alias("entries"))


@q("asof_previous_correlated", """
WITH h AS (SELECT rev_id, out_plate, date_trunc('hour', arrival) AS ts_h FROM visits)
SELECT rev_id, out_plate, ts_h,
  (SELECT max(h2.ts_h) FROM h h2 WHERE h2.out_plate = h.out_plate AND h2.ts_h < h.ts_h) AS prev_ts
FROM h""", ["visits"])
def asof_previous_correlated(spark, base):
    h = D.visits(spark, base).select("rev_id", "out_plate",
                                     F.date_trunc("hour", "arrival").cast("timestamp_ntz").alias("ts_h"))
    return W.previous_strictly_earlier(h, "out_plate", "ts_h", "prev_ts").select("rev_id", "out_plate", "ts_h",
                                                                                "prev_ts")


@q("scalar_subquery", """
SELECT site, round(sum(debit), 6) AS debit, round(sum(debit) / (SELECT sum(debit) FROM ledger), 6) AS share
FROM ledger GROUP BY site""", ["ledger"])
def scalar_subquery(spark, base):
    lg = D.ledger(spark, base)
    total = lg.agg(F.sum("debit")).scalar()
    return lg.groupBy("site").agg(F.round(F.sum("debit"), 6).alias("debit"),
                                  F.round(F.sum("debit") / total, 6).alias("share"))


@q("unnest_left", """
SELECT order_key, ticket_id, issuing_time FROM case_lines""", ["case_lines"])
def unnest_left(spark, base):
    c = D.cases(spark, base)
    return J.explode_keep(c, "breaches", "b").select("order_key", F.col("b.ticket_id").alias("ticket_id"),
                                                     F.col("b.issuing_time").alias("issuing_time"))


@q("unnest_inner", """
SELECT order_key, ticket_id, 'base' AS source, base_fee AS amount FROM case_lines WHERE ticket_id IS NOT NULL
UNION ALL
SELECT order_key, ticket_id, 'late' AS source, late_fee AS amount FROM case_lines WHERE ticket_id IS NOT NULL""",
   ["case_lines"])
def unnest_inner(spark, base):
    c = D.cases(spark, base)
    b = J.explode_drop(c, "breaches", "b")
    f = J.explode_drop(b, "b.fees", "f")
    return f.select("order_key", F.col("b.ticket_id").alias("ticket_id"), F.col("f.source").alias("source"),
                    F.col("f.amount").alias("amount"))


@q("unnest_product", """
SELECT order_key, ticket_id, site_ref FROM case_lines WHERE ticket_id IS NOT NULL""", ["case_lines"])
def unnest_product(spark, base):
    # the reference fans out breaches x groups and keeps row_number() = 1;
    # only the site group is read, so filter the array instead of exploding it
    c = D.cases(spark, base)
    site = F.filter("groups", lambda g: g["type"] == "site")[0]["group_ref"]
    b = J.explode_drop(c.select("order_key", "breaches", site.alias("site_ref")), "breaches", "b")
    return b.select("order_key", F.col("b.ticket_id").alias("ticket_id"), "site_ref")


@q("nested_subquery_sum", """
SELECT order_key, ticket_id,
  round(sum(base_fee + late_fee) OVER (PARTITION BY order_key), 6) AS case_fees,
  round(sum(paid_amount) OVER (PARTITION BY order_key), 6) AS case_receipts
FROM case_lines""", ["case_lines"])
def nested_subquery_sum(spark, base):
    c = D.cases(spark, base).select("order_key", "breaches",
                                    J.sum_nested("breaches", "fees", "amount").alias("case_fees"),
                                    J.sum_nested("breaches", "transactions", "amount").alias("case_receipts"))
    return J.explode_keep(c, "breaches", "b").select(
        "order_key", F.col("b.ticket_id").alias("ticket_id"), r6("case_fees").alias("case_fees"),
        r6("case_receipts").alias("case_receipts"))


@q("rejoin_aggregate", """
WITH v AS (SELECT plate, strftime(arrival, '%Y-%m') AS month, count(*) AS visits FROM permit_visits GROUP BY ALL),
p AS (SELECT plate, strftime(start_time, '%Y-%m') AS month, count(*) AS permits FROM permits GROUP BY ALL)
SELECT p.plate, p.month, p.permits, v.visits FROM p LEFT JOIN v ON p.plate = v.plate AND p.month = v.month""",
   ["permit_visits", "permits"])
def rejoin_aggregate(spark, base):
    v = (D.permit_visits(spark, base).groupBy("plate", F.date_format("arrival", "yyyy-MM").alias("month"))
         .agg(F.count(F.lit(1)).alias("visits")))
    p = (D.permits(spark, base).groupBy("plate", F.date_format("start_time", "yyyy-MM").alias("month"))
         .agg(F.count(F.lit(1)).alias("permits")))
    return p.join(v, ["plate", "month"], "left").select("plate", "month", "permits", "visits")
