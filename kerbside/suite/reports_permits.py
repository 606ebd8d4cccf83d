"""Registered queries for the permit and payment reports of §2.11."""

from __future__ import annotations

import datetime as dt

from kerbside.plans import permits as PP
from kerbside.sources import derived as D
from kerbside.suite.common import r6
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


@q("permit_payment_union", """
WITH pay AS (SELECT * FROM payments
             QUALIFY row_number() OVER (PARTITION BY plate, start_time, end_time ORDER BY request_time, transaction_id, segment) = 1)
SELECT start_time, coalesce(end_time, TIMESTAMP '2099-01-01 00:00:00') AS end_time, region, site, plate, amount, request_time,
  CAST(permit_id AS VARCHAR) AS permit_id, CAST(NULL AS BIGINT) AS transaction_id, CAST(NULL AS VARCHAR) AS source,
  CAST(NULL AS DOUBLE) AS duration, 'exemption' AS record_type, concat(region, site) AS group_key
FROM permits WHERE kind = 'exemption'
UNION ALL
SELECT start_time, end_time, region, site, plate, amount, request_time, CAST(permit_id AS VARCHAR), NULL, NULL, NULL,
  'permit', concat(region, site) FROM permits WHERE kind = 'permit'
UNION ALL
SELECT start_time, end_time, region, site, plate, amount, request_time, NULL, transaction_id, source, duration_seconds / 60,
  'payment', concat(region, site) FROM pay""", ["permits", "payments"])
def permit_payment_union(spark, base):
    return PP.permits_and_payments(D.permits(spark, base), D.payments(spark, base))


@q("permit_payment_consolidated", """
WITH whole AS (SELECT org, region, site, plate, request_time, transaction_id, source, min(start_time) AS start_time, max(end_time) AS end_time,
                      sum(amount) AS amount, sum(duration_seconds / 60) AS duration
               FROM payments WHERE CAST(start_time AS DATE) >= DATE '1993-01-01' GROUP BY ALL),
pay AS (SELECT * FROM whole QUALIFY row_number() OVER (PARTITION BY plate, start_time, end_time
                                                      ORDER BY request_time DESC, transaction_id DESC, region DESC, site DESC, source DESC) = 1)
SELECT start_time, CASE WHEN kind = 'exemption' THEN coalesce(end_time, TIMESTAMP '2099-01-01 00:00:00') ELSE end_time END AS end_time, region, site, plate,
  round(amount, 6) AS amount, request_time, CAST(permit_id AS VARCHAR) AS permit_id, CAST(NULL AS BIGINT) AS transaction_id, CAST(NULL AS VARCHAR) AS source,
  CAST(NULL AS DOUBLE) AS duration, kind AS record_type, concat(region, site) AS group_key
FROM permits WHERE kind IN ('exemption', 'permit')
UNION ALL
SELECT start_time, end_time, region, site, plate, round(amount, 6), request_time, NULL, transaction_id, source, round(duration, 6), 'payment', concat(region, site)
FROM pay""", ["permits", "payments"])
def permit_payment_consolidated(spark, base):
    u = PP.permits_and_consolidated_payments(D.permits(spark, base), D.payments(spark, base), "19930101")
    return u.withColumns({"amount": r6("amount"), "duration": r6("duration")})


_S, _E = dt.date(1997, 1, 1), dt.date(1997, 12, 31)
_TZ = "Pacific/Auckland"


@q("compliance_report", f"""
WITH loc AS (SELECT 'org3' AS org, 'r3' AS region, 'S13' AS site),
p AS (SELECT kind AS record_type, plate, start_time, end_time, request_time, amount, NULL::DOUBLE AS total_amount,
             NULL::BIGINT AS transaction_id, CAST(permit_id AS VARCHAR) AS permit_id, permit_source AS source, NULL::DOUBLE AS duration
      FROM permits SEMI JOIN loc USING (org, region, site)
      WHERE CAST(start_time AS DATE) BETWEEN DATE '{_S}' - 1 AND DATE '{_E}' + 1 AND permit_source NOT LIKE 'org3#r3#S13#%'),
whole AS (SELECT plate, transaction_id, request_time, source AS full_source, split_part(source, '#', 1) AS source,
                 min(start_time) AS start_time, max(end_time) AS end_time, max(amount) AS amount,
                 max(total_amount) AS total_amount, sum(duration_seconds) / 60 AS duration
          FROM payments SEMI JOIN loc USING (org, region, site)
          WHERE CAST(start_time AS DATE) BETWEEN DATE '{_S}' - INTERVAL 1 YEAR AND DATE '{_E}' + INTERVAL 1 YEAR
          GROUP BY ALL HAVING CAST(min(start_time) AS DATE) BETWEEN DATE '{_S}' AND DATE '{_E}'),
paid AS (SELECT 'payment' AS record_type, plate, start_time, end_time, request_time, amount, total_amount, transaction_id,
                NULL::VARCHAR AS permit_id, source, duration FROM whole w
         WHERE NOT EXISTS (SELECT 1 FROM whole n WHERE (n.plate, n.start_time, n.end_time, n.source) = (w.plate, w.start_time, w.end_time, w.source)
                           AND (n.request_time, n.transaction_id) > (w.request_time, w.transaction_id))),
u AS (SELECT * FROM p UNION ALL SELECT * FROM paid),
l AS (SELECT *, timezone('{_TZ}', start_time AT TIME ZONE 'UTC') AS start_local, timezone('{_TZ}', end_time AT TIME ZONE 'UTC') AS end_local,
             timezone('{_TZ}', request_time AT TIME ZONE 'UTC') AS request_local FROM u),
ok AS (SELECT * FROM l WHERE CAST(end_local AS DATE) >= DATE '{_S}' AND CAST(start_local AS DATE) <= DATE '{_E}')
SELECT record_type, plate, start_local, end_local, request_local, round(amount, 6) AS amount, round(total_amount, 6) AS total_amount,
       transaction_id, permit_id, source, duration
FROM ok WHERE record_type <> 'payment' OR NOT EXISTS (
  SELECT 1 FROM ok n WHERE n.record_type = 'payment' AND (n.plate, n.start_time, n.source) = (ok.plate, ok.start_time, ok.source)
  AND (n.end_time, n.transaction_id) > (ok.end_time, ok.transaction_id))""",
   ["permits", "payments"])
def compliance_report(spark, base):
    c = PP.compliance(D.permits(spark, base), D.payments(spark, base), "org3", "r3", "S13", _S, _E, _TZ)
    return c.withColumns({"amount": r6("amount"), "total_amount": r6("total_amount")})


TIERS = {12.5: 7, 40.0: 30, 100.0: 90}
_UK = "Europe/London"


@q("permit_entry_counts", f"""
WITH bought AS (
  SELECT plate, timezone('{_UK}', start_time AT TIME ZONE 'UTC') AS valid_from, min({{'a': amount, 's': site}}) AS cheapest
  FROM permits
  WHERE amount IN (12.5, 40.0, 100.0) AND CAST(start_time AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'
  GROUP BY plate, valid_from),
spans AS (
  SELECT plate, cheapest.s AS site, cheapest.a AS amount, valid_from,
         valid_from + to_days(CASE cheapest.a WHEN 12.5 THEN 7 WHEN 40.0 THEN 30 ELSE 90 END) AS valid_to FROM bought),
stays AS (
  SELECT DISTINCT site, plate, timezone('{_UK}', arrival AT TIME ZONE 'UTC') AS came,
         timezone('{_UK}', departure AT TIME ZONE 'UTC') AS went FROM permit_visits),
used AS (
  SELECT s.*, (SELECT count(t.came) FROM stays t WHERE t.site = s.site AND t.plate = s.plate
               AND (t.came BETWEEN s.valid_from AND s.valid_to OR t.went BETWEEN s.valid_from AND s.valid_to)) AS entries,
         count(*) OVER (PARTITION BY plate, strftime(valid_from, '%Y-%m')) AS of_month FROM spans s)
SELECT plate, strftime(valid_from, '%Y-%m') AS permit_month, site, amount, CAST(sum(entries) AS BIGINT) AS entry_count,
       max(of_month) AS purchase_count
FROM used GROUP BY ALL""", ["permits", "permit_visits"])
def permit_entry_counts(spark, base):
    return PP.permit_usage(D.permits(spark, base), D.permit_visits(spark, base), TIERS, _UK, "19960101", "19971231")
