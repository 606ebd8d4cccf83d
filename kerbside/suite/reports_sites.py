"""Registered queries for the site reports of §2.11."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kerbside.functions.timefn import between_local_days
from kerbside.functions.values import key_part
from kerbside.operators import joins as J
from kerbside.operators import windows as W
from kerbside.plans import sites as PS
from kerbside.plans.visits import latest_visits
from kerbside.sources import derived as D
from kerbside.suite.common import day_text, r6
from kerbside.suite.oracle_inputs import with_inputs

QUERIES: dict = {}
ORACLE: dict = {}
UK = "Europe/London"


def q(name, sql=None, inputs=()):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_inputs(sql, *inputs) if inputs else sql.strip()
        return fn
    return deco


def dround(expr: str, n: int) -> str:
    """DuckDB twin of Spark's HALF_UP rounding of a double (via its decimal text)."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38, 10)), {n}) AS DOUBLE)"


_CUR_SITES = """cur AS (SELECT * FROM site_log WHERE (key, "timestamp") IN
    (SELECT key, max("timestamp") FROM site_log WHERE type = 'site' GROUP BY key) AND action_type <> 'GroupDeleted')"""


@q("site_registry", f"""
WITH {_CUR_SITES}
SELECT key, organization, parent, name, trim(tag) AS tag, TRY_CAST(json_extract_string(json, '$.bays') AS INTEGER) AS bays,
  concat_ws(',', json_extract_string(json, '$.lat'), json_extract_string(json, '$.lon')) AS location
FROM cur, unnest(string_split(regexp_replace(json_extract_string(json, '$.tags'), '[\\[\\]"]', '', 'g'), ',')) AS t(tag)""",
   ["site_log"])
def site_registry(spark, base):
    return PS.site_registry(D.site_log(spark, base))


@q("site_status_current", """
WITH l AS (SELECT * FROM site_status QUALIFY row_number() OVER (PARTITION BY org, region, site ORDER BY created DESC, event_id DESC) = 1)
SELECT org, region, site, CASE WHEN coalesce(status, 'Active') = 'Created' THEN 'Pending' ELSE coalesce(status, 'Active') END AS status,
  created AS since
FROM l""", ["site_status"])
def site_status_current(spark, base):
    s = PS.site_status(D.site_status(spark, base), ["org", "region", "site"], "created", tiebreak="event_id")
    return s.select("org", "region", "site", "status", F.col("created").alias("since"))


@q("match_rate", f"""
WITH pm AS (SELECT org, region, site, CAST(timezone('{UK}', start_time AT TIME ZONE 'UTC') AS DATE) AS day,
                   sum(accepted) AS accepted, sum(total) AS total
            FROM process_metrics WHERE CAST(timezone('{UK}', start_time AT TIME ZONE 'UTC') AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
            GROUP BY ALL),
rm AS (SELECT ors_id, CAST(timezone('{UK}', ts AT TIME ZONE 'UTC') AS DATE) AS day, sum(CAST(entry AS INTEGER)) AS entries,
              sum(CASE WHEN NOT entry THEN 1 ELSE 0 END) AS exits
       FROM plate_events WHERE CAST(timezone('{UK}', ts AT TIME ZONE 'UTC') AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
       GROUP BY ALL)
SELECT rm.ors_id, strftime(rm.day, '%Y-%m-%d') AS day, entries, exits,
  {dround('accepted / total', 2)} AS process_rate,
  {dround('least(exits / ((entries + exits) / 2), entries / ((entries + exits) / 2))', 2)} AS raw_rate,
  total AS footfall, s.name AS site_name
FROM pm JOIN rm ON pm.day = rm.day AND rm.ors_id = concat(pm.org, '#', pm.region, '#', pm.site)
JOIN sites s ON s.organization = pm.org AND s.parent = pm.region AND s.group_id = pm.site
WHERE total <> 0""", ["process_metrics", "plate_events", "group_log", "sites"])
def match_rate(spark, base):
    pm = PS.process_rates(D.process_metrics(spark, base), UK, "20240105", "20240125")
    p = D.plate_events(spark, base).select("*", key_part("ors_id", 0).alias("org"), key_part("ors_id", 1).alias("region"),
                                           key_part("ors_id", 2).alias("site"))
    # the read side is keyed by its composite id; join on the parts, not a built string
    rm = PS.raw_flows(p, ["ors_id", "org", "region", "site"], UK, "20240105", "20240125")
    j = pm.where(F.col("total") != 0).join(rm, ["org", "region", "site", "day"])
    from kerbside.plans.dimension import PARTS, site_dimension, with_site
    j = with_site(j, site_dimension(D.group_log(spark, base)), dict(zip(PARTS, (F.col(c) for c in ("org", "region", "site")))), how="inner")
    return j.select("ors_id", day_text("day").alias("day"), "entries", "exits",
                    F.round(F.col("accepted") / F.col("total"), 2).alias("process_rate"),
                    F.round(PS.raw_match_rate(F.col("entries"), F.col("exits")), 2).alias("raw_rate"),
                    F.col("total").alias("footfall"), "site_name")


_RATE_SQL = """
WITH d AS (SELECT org, region, site, CAST(timezone('Pacific/Auckland', start_time AT TIME ZONE 'UTC') AS DATE) AS d,
                  sum(accepted) / nullif(sum(total), 0) AS rate, sum(total) AS footfall
           FROM process_metrics GROUP BY ALL),
h AS (SELECT *, list(coalesce(rate, 0)) OVER (PARTITION BY site ORDER BY d, org, region
        ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS prev FROM d),
b AS (SELECT *, quantile_cont(rate, 0.05) OVER (PARTITION BY site) AS lo,
             quantile_cont(rate, 0.95) OVER (PARTITION BY site) AS hi FROM h)
SELECT org, region, site, strftime(d, '%Y-%m-%d') AS day, round(rate, 6) AS rate, footfall,
  array_to_string(list_transform(prev, lambda x: CAST(CAST(x AS DECIMAL(12, 6)) AS VARCHAR)), ',') AS prev_rates,
  round(lo, 6) AS lower_band, round(hi, 6) AS upper_band, (rate < lo OR rate > hi) AS is_anomaly
FROM b"""


@q("rate_anomaly", _RATE_SQL, ["process_metrics"])
def rate_anomaly(spark, base):
    return _anomaly(PS.rate_anomalies(D.process_metrics(spark, base), "Pacific/Auckland"))


@q("rate_anomaly_period", _RATE_SQL.replace("FROM process_metrics GROUP BY", """FROM process_metrics
           WHERE org = 'org3' AND CAST(timezone('Pacific/Auckland', start_time AT TIME ZONE 'UTC') AS DATE)
             BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY"""), ["process_metrics"])
def rate_anomaly_period(spark, base):
    """One organisation and period, as the report's parameters select."""
    return _anomaly(PS.rate_anomalies(D.process_metrics(spark, base), "Pacific/Auckland", "20240105", "20240125", "org3"))


def _anomaly(a):
    txt = F.array_join(F.transform("prev", lambda x: x.cast("decimal(12,6)").cast("string")), ",")
    return a.select("org", "region", "site", day_text("d").alias("day"), r6("rate").alias("rate"), "footfall", txt.alias("prev_rates"),
                    r6("lower_band").alias("lower_band"), r6("upper_band").alias("upper_band"), "is_anomaly")


@q("delivery_delay", f"""
WITH d AS (SELECT ors_id, count(*) AS events, min(date_diff('minute', ts, received_ts)) AS min_delay,
                  avg(date_diff('minute', ts, received_ts)) AS avg_delay, max(date_diff('minute', ts, received_ts)) AS max_delay
           FROM plate_events WHERE CAST(timezone('{UK}', ts AT TIME ZONE 'UTC') AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-09'
             AND received_ts IS NOT NULL GROUP BY ors_id)
SELECT s.ors_id, d.events, d.min_delay, round(d.avg_delay, 6) AS avg_delay, d.max_delay
FROM (SELECT DISTINCT ors_id FROM visits) s LEFT JOIN d ON d.ors_id = s.ors_id""",
   ["plate_events", "visits"])
def delivery_delay(spark, base):
    # every site; sites without reads in the two report days keep NULL measures
    p = D.plate_events(spark, base).where(between_local_days("ts", UK, "20240108", "20240109"))
    d = PS.delivery_delays(p, "ors_id", "ts", "received_ts")
    s = D.visits(spark, base).select("ors_id").distinct()
    return s.join(d, "ors_id", "left").select("ors_id", "events", "min_delay", r6("avg_delay").alias("avg_delay"),
                                              "max_delay")


@q("camera_gaps", """
WITH p AS (SELECT device_id, CASE WHEN regexp_full_match(seq_hex, '[0-9A-Fa-f]+') THEN CAST('0x' || seq_hex AS BIGINT) END AS seq
           FROM plate_events),
g AS (SELECT device_id, seq - lag(seq) OVER (ORDER BY device_id ASC NULLS FIRST, seq DESC NULLS LAST) AS gap FROM p),
c AS (SELECT device_id, count(*) AS images, sum(CASE WHEN gap < -1 THEN -gap - 1 ELSE 0 END) AS missing_images
      FROM g GROUP BY device_id),
s AS (SELECT device_id, ors_id FROM plate_events QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT c.device_id, s.ors_id, c.images, c.missing_images FROM c LEFT JOIN s ON c.device_id = s.device_id""",
   ["plate_events"])
def camera_gaps(spark, base):
    p = D.plate_events(spark, base)
    c = PS.camera_gaps(p, "device_id", "seq_hex")
    s = W.latest_by_key(p.select("device_id", "ts", "event_id", "ors_id"), "device_id", "ts", tiebreak="event_id")
    return c.join(s.select("device_id", "ors_id"), "device_id", "left").select("device_id", "ors_id", "images",
                                                                              "missing_images")


@q("camera_gap_rows", f"""
WITH dev AS (SELECT device_id, name AS camera_name, unnest(group_keys) AS ref FROM device_log WHERE (device_id, "timestamp") IN
               (SELECT device_id, max("timestamp") FROM device_log WHERE device_type = 'mav-camera' GROUP BY device_id) AND action_type <> 'DeviceDeleted'),
p AS (SELECT event_id, device_id, CASE WHEN regexp_full_match(seq_hex, '[0-9A-Fa-f]+') THEN CAST('0x' || seq_hex AS BIGINT) END AS seq,
             CAST(timezone('{UK}', ts AT TIME ZONE 'UTC') AS DATE) AS day FROM plate_events
      WHERE CAST(timezone('{UK}', ts AT TIME ZONE 'UTC') AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'),
g AS (SELECT *, seq - lag(seq) OVER (ORDER BY device_id ASC NULLS FIRST, seq DESC NULLS LAST) AS difference FROM p)
SELECT event_id, g.device_id, camera_name, s.name AS site_name, seq, strftime(day, '%Y-%m-%d') AS day, difference
FROM g JOIN dev ON dev.device_id = g.device_id JOIN sites s ON dev.ref = concat_ws('#', s.organization, s.parent, s.group_id)""",
   ["plate_events", "device_log", "group_log", "sites"])
def camera_gap_rows(spark, base):
    from kerbside.plans.dimension import site_dimension
    g = PS.image_gaps(D.plate_events(spark, base), PS.current_devices(D.device_log(spark, base)), site_dimension(D.group_log(spark, base)),
                      "20240105", "20240125", UK)
    return g.withColumn("day", day_text("day"))


@q("weekday_grid", """
WITH b AS (SELECT site, CAST(timezone('Europe/London', "time" AT TIME ZONE 'UTC') AS DATE) AS day, breach_id FROM ledger),
l AS (SELECT site, breach_id,
        CASE WHEN day BETWEEN DATE '1998-06-17' AND DATE '1998-06-23' THEN strftime(day, '%A')
             WHEN day BETWEEN DATE '1998-06-09' AND DATE '1998-06-17' THEN 'Last ' || strftime(day, '%A') END AS label
      FROM b WHERE day BETWEEN DATE '1998-06-11' AND DATE '1998-06-30'),
c AS (SELECT site, label, count(DISTINCT breach_id) AS breaches FROM l WHERE label IS NOT NULL GROUP BY ALL),
d AS (SELECT unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']) AS w),
g AS (SELECT s.site, p.p || d.w AS label
      FROM (SELECT DISTINCT site FROM c) s CROSS JOIN d CROSS JOIN (SELECT unnest(['', 'Last ']) AS p) p)
SELECT g.site, g.label, coalesce(c.breaches, 0) AS breaches
FROM g LEFT JOIN c ON g.site = c.site AND g.label = c.label""", ["ledger"])
def weekday_grid(spark, base):
    return PS.weekday_compare(D.ledger(spark, base), "site", "time", "breach_id", "19980624", "19980630", UK)


_CASE_SITE = "list_filter(groups, lambda g: g.type = 'site')[1].group_ref"


@q("sites_breach_summary", """
WITH l AS (SELECT * FROM case_lines WHERE case_ts >= TIMESTAMP '1998-01-01 00:00:00' AND case_ts < TIMESTAMP '1998-02-01 00:00:00'),
lr AS (SELECT * FROM l WHERE (id, rev) IN (SELECT id, max(rev) FROM l GROUP BY id)),
c AS (SELECT site_ref, CAST(issuing_time AS DATE) AS day, count(DISTINCT ticket_id) AS breaches,
             array_to_string(list_sort(list(DISTINCT CAST(ticket_id AS VARCHAR))), ',') AS tickets
      FROM lr WHERE ticket_id IS NOT NULL GROUP BY ALL),
st AS (SELECT * FROM park_status QUALIFY row_number() OVER (PARTITION BY org, region, site ORDER BY created DESC, event_id DESC) = 1),
s AS (SELECT concat_ws('#', sites.organization, sites.parent, sites.group_id) AS site_ref, sites.name AS site_name,
             CASE WHEN st.status IS NULL THEN 'Active' WHEN st.status = 'Created' THEN 'Pending' ELSE st.status END AS site_status
      FROM sites LEFT JOIN st ON st.org = sites.organization AND st.region = sites.parent AND st.site = sites.group_id)
SELECT s.site_ref, s.site_name, s.site_status, strftime(c.day, '%Y-%m-%d') AS day, coalesce(c.breaches, 0) AS breaches, c.tickets
FROM c RIGHT JOIN s ON c.site_ref = s.site_ref""", ["case_lines", "park_status", "group_log", "sites"])
def sites_breach_summary(spark, base):
    from kerbside.operators.aggregates import collect_sorted_text
    from kerbside.plans.dimension import PARTS, site_dimension
    c = D.cases(spark, base)
    site = F.filter("groups", lambda g: g["type"] == "site")[0]["group_ref"]
    c = c.withColumn("site_ref", site)
    heads = D.cases(spark, base, with_breaches=False)
    rng = (F.col("case_ts") >= F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")) & \
          (F.col("case_ts") < F.lit(dt.datetime(1998, 2, 1)).cast("timestamp_ntz"))
    # the date filter runs before the newest-revision test (as the report does); the
    # max revision comes from the documents without their nested arrays
    cur = W.latest_ties(c.where(rng), "id", "rev", source=heads.where(rng))
    # every registered site with its name and status, with or without a breach
    st = PS.site_status(D.park_status(spark, base), ["org", "region", "site"], "created", tiebreak="event_id") \
        .select(*[F.col(k).alias(p) for k, p in zip(("org", "region", "site"), PARTS)], "status")
    sites = site_dimension(D.group_log(spark, base)).join(st, list(PARTS), "left").select(
        F.concat_ws("#", *PARTS).alias("site_ref"), F.col("name").alias("site_name"), F.coalesce("status", F.lit("Active")).alias("site_status"))
    b = J.explode_drop(cur, "breaches", "b").select("site_ref", F.to_date("b.issuing_time").alias("day"),
                                                    F.col("b.ticket_id").alias("ticket_id"))
    counts = b.groupBy("site_ref", "day").agg(F.count_distinct("ticket_id").alias("breaches"),
                                              collect_sorted_text(F.col("ticket_id").cast("string"), distinct=True)
                                              .alias("tickets"))
    return counts.join(sites, "site_ref", "right").select(
        "site_ref", "site_name", "site_status", day_text("day").alias("day"), F.coalesce("breaches", F.lit(0)).alias("breaches"), "tickets")


@q("sites_without_breach", """
WITH b AS (SELECT DISTINCT s.name AS site, CAST(timezone(c.timezone, off AT TIME ZONE 'UTC') AS DATE) AS day
           FROM (SELECT site_ref, timezone, unnest(offences) AS off FROM case_lines WHERE ticket_id IS NOT NULL) c
           JOIN sites s ON c.site_ref = concat_ws('#', s.organization, s.parent, s.group_id)),
g AS (SELECT name AS site, unnest(generate_series(DATE '1998-01-01', DATE '1998-03-31', INTERVAL 1 DAY))::DATE AS day
      FROM (SELECT DISTINCT name FROM sites))
SELECT g.site, strftime(g.day, '%Y-%m-%d') AS day FROM g LEFT JOIN b ON g.site = b.site AND g.day = b.day WHERE b.site IS NULL""",
   ["case_lines", "group_log", "sites"])
def sites_without_breach(spark, base):
    """Sites are those of the registry, by name, so one that never had a breach appears with every day."""
    from kerbside.functions.timefn import local_date
    from kerbside.plans.dimension import key_parts, site_dimension, with_site
    sites = site_dimension(D.group_log(spark, base))
    # a day to each side of the range for the zones
    near = F.col("off").between(F.lit(dt.datetime(1997, 12, 30)).cast("timestamp_ntz"), F.lit(dt.datetime(1998, 4, 2)).cast("timestamp_ntz"))
    c = D.cases(spark, base).where(F.exists(F.coalesce("breaches", F.array()), lambda b: b["ticket_id"].isNotNull()))
    off = c.select("timezone", F.filter("groups", lambda g: g["type"] == "site")[0]["group_ref"].alias("group_ref"), F.explode("offenses").alias("o")) \
        .select("group_ref", "timezone", F.col("o.offense_time").alias("off")).where(near)
    hit = with_site(off, sites, key_parts("group_ref"), how="inner") \
        .select(F.col("site_name").alias("site"), local_date("off", F.col("timezone")).alias("day"))
    out = PS.sites_without(hit, sites.select(F.col("name").alias("site")), "site", "day", "19980101", "19980331")
    return out.select("site", day_text("day").alias("day"))


@q("site_metrics", f"""
WITH pm AS (SELECT org, region, site, CAST(timezone('{UK}', start_time AT TIME ZONE 'UTC') AS DATE) AS day,
                   sum(accepted) / nullif(sum(total), 0) AS match_rate, sum(total) AS footfall
            FROM process_metrics WHERE CAST(timezone('{UK}', start_time AT TIME ZONE 'UTC') AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'
            GROUP BY ALL),
rf AS (SELECT ors_id, CAST(timezone('{UK}', ts AT TIME ZONE 'UTC') AS DATE) AS day, round(count(entry) / 2, 2) AS raw_footfall
       FROM plate_events GROUP BY ALL),
lv AS (SELECT * FROM visits WHERE action <> 'deleted' AND CAST(timezone('{UK}', arrival AT TIME ZONE 'UTC') AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'
       QUALIFY row_number() OVER (PARTITION BY visit_id ORDER BY updated DESC, rev_id DESC) = 1),
vs AS (SELECT ors_id, CAST(timezone('{UK}', arrival AT TIME ZONE 'UTC') AS DATE) AS day, count(*) AS visits,
              round(avg(coalesce(round(date_diff('second', arrival, departure) / 60, 1), 0)), 6) AS avg_stay
       FROM lv GROUP BY ALL),
f AS (SELECT * FROM notice_facts WHERE breach_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY case_id, breach_id ORDER BY fact_ts DESC, event_id DESC) = 1),
n AS (SELECT org, region, site, CAST(timezone('{UK}', offense_time AT TIME ZONE 'UTC') AS DATE) AS day, count(*) AS pcn_count,
  sum(CASE WHEN lower(substate) IN ('nip', 'svc-cancel', 'breachError') THEN 0 ELSE value END) AS potential_revenue,
  sum(CASE WHEN lower(substate) = 'defaulted' AND state = 'Closed' THEN 0 ELSE receipts END) AS realised_revenue,
  count(*) FILTER (WHERE lower(substate) IN ('breach-paid-direct', 'bankpayment', 'paid-online', 'paid_online', 'paidonline') AND state = 'Closed') AS paid_count,
  count(*) FILTER (WHERE substate IN ('nip', 'svc-cancel', 'breachError', 'lprError', 'noownershipdetails', 'updatedownershipdetails')) AS cancelled_count,
  count(*) FILTER (WHERE contains(lower(substate), 'appeal') AND state = 'Closed') AS appeals_count,
  count(*) FILTER (WHERE lower(substate) = 'defaulted' AND state = 'Closed') AS debt_count,
  sum(CASE WHEN lower(substate) = 'defaulted' AND state = 'Closed' THEN receipts ELSE 0 END) AS debt_receipts
  FROM f GROUP BY ALL),
st AS (SELECT * FROM park_status QUALIFY row_number() OVER (PARTITION BY org, region, site ORDER BY created DESC, event_id DESC) = 1)
SELECT s.organization AS org, s.parent AS region, s.group_id AS site, s.name, strftime(pm.day, '%Y-%m-%d') AS day,
  round(pm.match_rate, 6) AS match_rate, CAST(pm.footfall AS BIGINT) AS footfall, rf.raw_footfall, coalesce(vs.visits, 0) AS visits, vs.avg_stay,
  CASE WHEN st.status IS NULL THEN 'Active' WHEN st.status = 'Created' THEN 'Pending' ELSE st.status END AS site_status,
  strftime(CAST(timezone('{UK}', st.created AT TIME ZONE 'UTC') AS DATE), '%Y-%m-%d') AS status_day,
  coalesce(n.pcn_count, 0) AS pcn_count, coalesce(n.potential_revenue, 0) AS potential_revenue, coalesce(n.realised_revenue, 0) AS realised_revenue,
  coalesce(n.paid_count, 0) AS paid_count, coalesce(n.cancelled_count, 0) AS cancelled_count, coalesce(n.appeals_count, 0) AS appeals_count,
  coalesce(n.debt_count, 0) AS debt_count, coalesce(n.debt_receipts, 0) AS debt_receipts
FROM sites s LEFT JOIN st ON st.org = s.organization AND st.region = s.parent AND st.site = s.group_id
LEFT JOIN pm ON pm.org = s.organization AND pm.region = s.parent AND pm.site = s.group_id
LEFT JOIN rf ON rf.ors_id = concat_ws('#', pm.org, pm.region, pm.site) AND rf.day = pm.day
LEFT JOIN vs ON vs.ors_id = concat_ws('#', pm.org, pm.region, pm.site) AND vs.day = pm.day
LEFT JOIN n ON n.org = pm.org AND n.region = pm.region AND n.site = pm.site AND n.day = pm.day""",
   ["visits", "process_metrics", "plate_events", "notice_facts", "park_status", "group_log", "sites"])
def site_metrics(spark, base):
    """Per registered site and processing day: twelve measures and two of the visits, from one tagged union."""
    from kerbside.functions.timefn import stay_minutes
    from kerbside.plans.dimension import site_dimension
    from kerbside.plans.metrics import KEYS, site_metrics as metrics

    def keyed(df):
        return df.select("*", *[key_part("ors_id", i).alias(k) for i, k in enumerate(KEYS)])

    # the period stands below the ranking of visit revisions
    v = latest_visits(D.visits(spark, base).where(between_local_days("arrival", UK, "20240110", "20240116")))
    m = metrics(site_dimension(D.group_log(spark, base)), D.park_status(spark, base), D.process_metrics(spark, base),
                keyed(D.plate_events(spark, base)), keyed(v).withColumn("stay_minutes", stay_minutes("arrival", "departure")),
                D.notice_facts(spark, base), "20240110", "20240116", UK)
    return m.withColumns({"day": day_text("day"), "status_day": day_text("status_day"), "match_rate": r6("match_rate"), "avg_stay": r6("avg_stay")})


_HITS = """hits AS (SELECT p.c_custkey, e.n_nationkey FROM points p JOIN poly_edges e ON (e.y1 > p.lat) <> (e.y2 > p.lat)
    WHERE p.lon < (e.x2 - e.x1) * (p.lat - e.y1) / (e.y2 - e.y1) + e.x1
    GROUP BY ALL HAVING count(*) % 2 = 1)"""


@q("spatial_join", f"""
WITH {_HITS}
SELECT p.c_custkey, h.n_nationkey FROM points p LEFT JOIN hits h ON p.c_custkey = h.c_custkey""",
   ["polygons", "points", "poly_edges"])
def spatial_join(spark, base):
    from kerbside.operators.geo import points_in_areas
    return points_in_areas(D.points(spark, base), D.polygons(spark, base), "c_custkey", "n_nationkey")


_SPHERE = """e AS (SELECT n_nationkey, x1 + 175 AS x1, y1 - 5 AS y1, x2 + 175 AS x2, y2 - 5 AS y2 FROM poly_edges),
v AS (SELECT *, cos(radians(y1)) * cos(radians(x1)) AS a0, cos(radians(y1)) * sin(radians(x1)) AS a1, sin(radians(y1)) AS a2,
             cos(radians(y2)) * cos(radians(x2)) AS b0, cos(radians(y2)) * sin(radians(x2)) AS b1, sin(radians(y2)) AS b2 FROM e),
m AS (SELECT *, a1 * b2 - a2 * b1 AS n0, a2 * b0 - a0 * b2 AS n1, a0 * b1 - a1 * b0 AS n2, a0 * b0 + a1 * b1 + a2 * b2 AS d FROM v),
w AS (SELECT *, atan2(sqrt(n0 * n0 + n1 * n1 + n2 * n2), d) / sqrt(n0 * n0 + n1 * n1 + n2 * n2) AS w FROM m),
c AS (SELECT n_nationkey, sum(n0 * w) AS c0, sum(n1 * w) AS c1, sum(n2 * w) AS c2 FROM w GROUP BY n_nationkey),
inside AS (SELECT s.organization, s.parent, s.group_id, e.n_nationkey FROM places s JOIN e ON (e.x1 <= s.lon) <> (e.x2 <= s.lon)
  WHERE degrees(atan((tan(radians(e.y1)) * sin(radians(e.x2 - s.lon)) + tan(radians(e.y2)) * sin(radians(s.lon - e.x1))) / sin(radians(e.x2 - e.x1)))) > s.lat
  GROUP BY ALL HAVING count(*) % 2 = 1)"""


@q("site_map", f"""
WITH places AS (SELECT DISTINCT organization, parent, group_id, name, lon, lat FROM group_log
  WHERE (key, "timestamp") IN (SELECT key, max("timestamp") FROM group_log WHERE type = 'site' GROUP BY key) AND action_type <> 'GroupDeleted'),
{_SPHERE},
st AS (SELECT * FROM park_status QUALIFY row_number() OVER (PARTITION BY org, region, site ORDER BY created DESC, event_id DESC) = 1)
SELECT p.n_name AS area, round(degrees(atan2(c1, c0)), 6) AS centroid_lon, round(degrees(atan2(c2, sqrt(c0 * c0 + c1 * c1))), 6) AS centroid_lat,
  s.organization, s.parent, s.group_id, s.name AS site_name, round(s.lon, 6) AS lon, round(s.lat, 6) AS lat,
  CASE WHEN st.status IN ('Created', 'Stopped') THEN st.status ELSE 'Active' END AS site_status
FROM polygons p JOIN c ON p.n_nationkey = c.n_nationkey LEFT JOIN inside i ON i.n_nationkey = p.n_nationkey
LEFT JOIN places s ON s.organization = i.organization AND s.parent = i.parent AND s.group_id = i.group_id
LEFT JOIN st ON st.org = s.organization AND st.region = s.parent AND st.site = s.group_id""",
   ["group_log", "park_status", "polygons", "poly_edges"])
def site_map(spark, base):
    """One row per area and site inside it (areas without one stay): spherical centroid, name, place, status."""
    from kerbside.operators.geo import points_on_sphere, sphere_centroids, wkt_rings
    from kerbside.plans.dimension import PARTS, site_dimension
    areas = D.area_texts(spark, base).select("n_nationkey", F.col("n_name").alias("area"), wkt_rings("geometry").alias("rings"))
    sites = site_dimension(D.group_log(spark, base), extra=("lon", "lat")).withColumn("place", F.struct(*PARTS, "name"))
    hits = points_on_sphere(sites, areas, "place", "n_nationkey", how="inner").join(sites, "place")
    st = W.latest_by_key(D.park_status(spark, base), ["org", "region", "site"], "created", tiebreak="event_id") \
        .select(*[F.col(c).alias(p) for c, p in zip(("org", "region", "site"), PARTS)], "status")
    m = areas.select("n_nationkey", "area").join(sphere_centroids(areas, "n_nationkey"), "n_nationkey") \
        .join(hits.join(st, list(PARTS), "left"), "n_nationkey", "left")
    known = F.when(F.col("status").isin("Created", "Stopped"), F.col("status")).otherwise("Active")
    return m.select("area", r6("centroid_lon").alias("centroid_lon"), r6("centroid_lat").alias("centroid_lat"), *PARTS, F.col("name").alias("site_name"),
                    r6("lon").alias("lon"), r6("lat").alias("lat"), known.alias("site_status"))


@q("site_map_counts", f"""
WITH {_HITS},
cen AS (SELECT n_nationkey, sum((x1 + x2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)) AS cx,
               sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)) AS cy FROM poly_edges GROUP BY n_nationkey)
SELECT pg.n_name AS name, round(cen.cx, 6) AS centroid_lon, round(cen.cy, 6) AS centroid_lat, count(h.c_custkey) AS sites,
  array_to_string(list_sort(list(DISTINCT p.c_mktsegment) FILTER (WHERE p.c_mktsegment IS NOT NULL)), ',') AS segments
FROM polygons pg JOIN cen ON pg.n_nationkey = cen.n_nationkey LEFT JOIN hits h ON h.n_nationkey = pg.n_nationkey
LEFT JOIN points p ON p.c_custkey = h.c_custkey
GROUP BY pg.n_name, cen.cx, cen.cy""", ["polygons", "points", "poly_edges"])
def site_map_counts(spark, base):
    """Sites and segments counted per polygon, in the plane."""
    from kerbside.operators.aggregates import collect_sorted_text
    from kerbside.operators.spatial import points_in_polygons, polygon_centroids
    polys = D.polygons(spark, base)
    pts = D.points(spark, base)
    hits = points_in_polygons(pts, polys, "c_custkey", "n_nationkey", how="inner")
    hits = hits.join(pts.select("c_custkey", "c_mktsegment"), "c_custkey")
    cen = polygon_centroids(polys, "n_nationkey")
    m = polys.select("n_nationkey", F.col("n_name").alias("name")).join(cen, "n_nationkey").join(hits, "n_nationkey", "left")
    return m.groupBy("name", "centroid_lon", "centroid_lat").agg(
        F.count("c_custkey").alias("sites"), collect_sorted_text("c_mktsegment", distinct=True).alias("segments")) \
        .select("name", r6("centroid_lon").alias("centroid_lon"), r6("centroid_lat").alias("centroid_lat"), "sites",
                "segments")


@q("sites_breach_states", """
WITH f AS (SELECT n.*, CAST(timezone(z.timezone, offense_time AT TIME ZONE 'UTC') AS DATE) AS day, concat_ws('#', n.org, region, site) AS site_ref
           FROM notice_facts n LEFT JOIN org_timezone z ON z.org = n.org),
l AS (SELECT * FROM f WHERE day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'
      QUALIFY row_number() OVER (PARTITION BY breach_id ORDER BY fact_ts DESC, event_id DESC) = 1),
c AS (SELECT site_ref, day, state, count(DISTINCT breach_id) AS breaches,
             array_to_string(list_sort(list(DISTINCT CAST(breach_id AS VARCHAR)) FILTER (WHERE breach_id IS NOT NULL)), ',') AS breach_ids
      FROM l WHERE NOT (state = 'Closed' AND substate = 'breachError') AND NOT (state = 'Closed' AND substate = 'nip') GROUP BY ALL),
st AS (SELECT * FROM park_status QUALIFY row_number() OVER (PARTITION BY org, region, site ORDER BY created DESC, event_id DESC) = 1),
s AS (SELECT concat_ws('#', sites.organization, sites.parent, sites.group_id) AS site_ref, sites.name AS site_name, upper(sites.name) AS site_code,
             CASE WHEN st.event_id IS NULL THEN NULL WHEN st.status IS NULL THEN 'Active' WHEN st.status = 'Created' THEN 'Pending'
                  ELSE st.status END AS site_status
      FROM sites LEFT JOIN st ON st.org = sites.organization AND st.region = sites.parent AND st.site = sites.group_id)
SELECT s.site_ref, site_name, site_code, site_status, state, strftime(day, '%Y-%m-%d') AS day, coalesce(breaches, 0) AS breaches, breach_ids
FROM c RIGHT JOIN s ON c.site_ref = s.site_ref""", ["notice_facts", "org_timezone", "park_status", "group_log", "sites"])
def sites_breach_states(spark, base):
    """Breach counts and ids by site, local offence day and state, with site code and status; every site appears."""
    from kerbside.functions.values import json_text
    from kerbside.plans.dimension import PARTS, site_dimension
    log = D.group_log(spark, base).withColumn("json", F.expr("concat('{\"metadata\": {\"siteCode\": \"', upper(name), '\"}}')"))
    st = PS.site_status(D.park_status(spark, base), ["org", "region", "site"], "created", tiebreak="event_id") \
        .select(*[F.col(k).alias(p) for k, p in zip(("org", "region", "site"), PARTS)], F.col("status").alias("site_status"))
    sites = site_dimension(log, extra=("json",)).join(st, list(PARTS), "left").select(
        F.concat_ws("#", *PARTS).alias("site_ref"), F.col("name").alias("site_name"), json_text("json", "$.metadata.siteCode").alias("site_code"), "site_status")
    out = PS.breach_states(D.notice_facts(spark, base), sites, D.org_timezone(spark), "20240108", "20240114")
    return out.withColumn("day", day_text("day"))
