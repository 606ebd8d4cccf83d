"""DuckDB twins of ``kerbside.sources.derived`` (same rows, written in SQL).

``with_inputs(sql, names)`` prefixes a query with the named inputs as
common table expressions; a query that starts with its own ``WITH`` is
spliced after them.
"""

from __future__ import annotations

import re

_EV = "(SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"
_ST = "CASE k % 4 WHEN 0 THEN 'Open' WHEN 1 THEN 'Pending' WHEN 2 THEN 'Resolved' ELSE 'Closed' END"

INPUTS: dict[str, str] = {
    "visits": f"""
SELECT event_id // 2 AS visit_id, event_id AS rev_id,
  concat('org', user_id % 7, '#r', k % 5, '#', event_type) AS ors_id,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('P', user_id) END AS in_plate,
  concat('P', user_id) AS out_plate,
  ts AS arrival,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts + to_seconds(CAST(round(value * 60) AS BIGINT)) END AS departure,
  ts + to_seconds(k) AS updated,
  CASE WHEN event_id % 23 = 0 THEN 'deleted' ELSE 'upsert' END AS action,
  CASE WHEN event_id % 5 = 0 THEN '  ' ELSE concat('make', user_id % 9) END AS in_make,
  concat('make', user_id % 6) AS out_make,
  CASE WHEN k % 4 = 0 THEN NULL ELSE concat('c', k % 6) END AS in_colour,
  CASE WHEN k % 3 = 0 THEN ' ' ELSE concat('c', k % 5) END AS out_colour
FROM {_EV}""",
    "org_timezone": """
SELECT * FROM (VALUES ('org0', 'Europe/London'), ('org1', 'Europe/Copenhagen'),
  ('org2', 'Europe/Berlin'), ('org3', 'Pacific/Auckland'), ('org4', 'America/New_York'),
  ('org5', 'Australia/Sydney'), ('org9', 'Asia/Tokyo')) t(org, timezone)""",
    "site_log": f"""
SELECT event_id, concat('site', user_id % 40) AS key, ts AS "timestamp",
  CASE WHEN k % 10 = 0 THEN 'zone' ELSE 'site' END AS type,
  CASE event_type WHEN 'error' THEN 'GroupDeleted' WHEN 'signup' THEN 'GroupCreated' ELSE 'GroupUpdated' END AS action_type,
  concat('r', user_id % 5) AS parent, concat('org', user_id % 7) AS organization,
  concat('Site ', user_id % 40, ' v', k % 3) AS name,
  concat('{{"bays": "', CASE WHEN k % 9 = 0 THEN 'x' ELSE CAST(k % 50 AS VARCHAR) END,
    '", "tags": ["t', k % 4, '", "t', k % 3 + 4, '"], "lat": 51.',
    lpad(CAST(user_id % 40 AS VARCHAR), 2, '0'), ', "lon": -0.', lpad(CAST(k AS VARCHAR), 3, '0'), '}}') AS json
FROM {_EV}""",
    "site_status": """
SELECT event_id, concat('org', user_id % 7) AS org, concat('r', user_id % 5) AS region,
  concat('site', user_id % 40) AS site,
  CASE event_type WHEN 'view' THEN 'Active' WHEN 'click' THEN 'Created' WHEN 'error' THEN 'Inactive'
    WHEN 'purchase' THEN 'active' END AS status,
  ts AS created
FROM events""",
    "plate_events": f"""
SELECT event_id, ts,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts + to_seconds(CAST(round(value) AS BIGINT)) END AS received_ts,
  event_id % 2 = 0 AS entry,
  concat('org', user_id % 7, '#r', k % 5, '#', event_type) AS ors_id,
  concat('cam', user_id % 12) AS device_id,
  CASE WHEN event_id % 19 = 0 THEN 'zz' ELSE hex(event_id) END AS seq_hex
FROM {_EV}""",
    "process_metrics": f"""
SELECT event_id, concat('org', user_id % 7) AS org, concat('r', user_id % 5) AS region,
  event_type AS site, ts AS start_time,
  least(k % 4, event_id % 4) AS accepted, k % 4 - least(k % 4, event_id % 4) AS rejected, k % 4 AS total
FROM {_EV}""",
    "case_events": f"""
SELECT event_id, concat('case/', user_id) AS case_uri, ts,
  CASE event_type WHEN 'signup' THEN 'CaseCreated' WHEN 'view' THEN 'StatusChanged'
    WHEN 'purchase' THEN 'StatusChanged' WHEN 'click' THEN 'NoteAdded' ELSE 'CorrespondenceAdded' END AS type,
  CASE WHEN event_type IN ('view', 'purchase') THEN concat('{{"value": "', {_ST}, '"}}')
       WHEN event_type = 'error' THEN concat('{{"tags": {{"correspondence": "', {_ST}, '"}}}}')
       ELSE '{{}}' END AS data,
  CASE WHEN k % 7 = 0 THEN NULL ELSE concat('agent', k % 6) END AS author
FROM {_EV}""",
    "correspondence": f"""
SELECT event_id, concat('corr/', user_id % 60) AS uri, ts,
  concat('{{"label": "', CASE WHEN k % 5 = 0 THEN 'Linked' WHEN k % 2 = 0 THEN 'Resolved' ELSE 'Unresolved' END, '"',
    CASE WHEN k % 7 = 0 THEN '' WHEN k % 5 = 0 THEN ', "mailUpdate": {{"labels": {{"Linked": "true"}}}}'
         WHEN k % 2 = 0 THEN ', "mailUpdate": {{"labels": {{"Resolved": "true", "Unresolved": "false"}}}}'
         WHEN k % 3 = 0 THEN ', "mailUpdate": {{"labels": {{"Unresolved": "true"}}}}'
         ELSE ', "mailUpdate": {{"labels": {{"Resolved": "false", "Unresolved": "true"}}}}' END, '}}') AS data,
  concat('{{"name": "user', k % 8, '"}}') AS user_json
FROM {_EV}""",
    "permits": """
SELECT o_orderkey AS permit_id, concat('org', o_custkey % 7) AS org, concat('r', o_custkey % 5) AS region,
  concat('S', o_custkey % 20) AS site, concat('P', o_custkey) AS plate, o_orderdate AS start_time,
  CASE o_orderpriority WHEN '1-URGENT' THEN o_orderdate + INTERVAL 7 DAY
    WHEN '2-HIGH' THEN o_orderdate + INTERVAL 30 DAY WHEN '3-MEDIUM' THEN o_orderdate + INTERVAL 90 DAY
    WHEN '4-NOT SPECIFIED' THEN NULL ELSE TIMESTAMP '2099-06-30 00:00:00' END AS end_time,
  o_orderdate - to_seconds(o_orderkey % 600) AS request_time,
  o_orderdate + to_seconds(o_orderkey % 7200) AS response_time,
  CASE o_orderpriority WHEN '1-URGENT' THEN 12.5::DOUBLE WHEN '2-HIGH' THEN 40.0::DOUBLE
    WHEN '3-MEDIUM' THEN 100.0::DOUBLE WHEN '4-NOT SPECIFIED' THEN 0.0::DOUBLE ELSE 5.0::DOUBLE END AS amount,
  CASE WHEN o_orderstatus = 'P' THEN 'exemption' ELSE 'permit' END AS kind,
  CASE o_orderkey % 5 WHEN 0 THEN concat('org', o_custkey % 7, '#r', o_custkey % 5, '#S', o_custkey % 20, '#cam')
    WHEN 1 THEN 'console' WHEN 2 THEN 'app' WHEN 3 THEN 'import' END AS permit_source
FROM orders""",
    "exemptions": f"""
SELECT event_id AS permit_id, concat('org', user_id % 7) AS org, concat('r', k % 5) AS region, event_type AS site,
  concat('P', user_id) AS plate, ts - INTERVAL 24 HOUR AS start_time,
  CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN TIMESTAMP '2099-06-30 00:00:00' ELSE ts + INTERVAL 120 HOUR END AS end_time,
  CASE WHEN event_id % 2 = 0 THEN ts + to_seconds(k - 86500) END AS response_time
FROM {_EV} WHERE event_id % 29 = 0""",
    "permit_visits": """
SELECT l_orderkey AS visit_order, l_linenumber AS visit_line, concat('P', o_custkey) AS plate,
  concat('S', o_custkey % 20) AS site,
  l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) AS arrival,
  l_shipdate + to_hours(l_linenumber + CAST(l_quantity AS BIGINT)) AS departure
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "payments": """
SELECT l_orderkey AS transaction_id, l_linenumber AS segment, concat('org', l_suppkey % 7) AS org,
  concat('r', l_suppkey % 5) AS region, concat('S', l_suppkey % 20) AS site,
  concat('P', l_partkey % 300) AS plate,
  l_shipdate + to_days((l_linenumber - 1) * 7) AS start_time,
  l_shipdate + to_days(l_linenumber * 7) AS end_time,
  CAST(l_quantity AS BIGINT) * 60 AS duration_seconds,
  l_extendedprice / 100 AS amount, l_extendedprice / 10 AS total_amount,
  l_shipdate - to_minutes(CAST(l_linenumber AS BIGINT)) AS request_time,
  concat('app#', l_returnflag) AS source
FROM lineitem""",
    "ledger": """
SELECT l_orderkey AS breach_id, l_linenumber AS line_no, concat('S', l_suppkey % 20) AS site,
  l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) AS "time",
  CASE l_returnflag WHEN 'R' THEN 'Payment' WHEN 'A' THEN 'Refund' ELSE 'Fee' END AS transaction_type,
  CASE l_linestatus WHEN 'F' THEN 'Base fee' ELSE 'Late fee' END AS description,
  l_extendedprice / 50 AS debit, l_extendedprice * l_discount / 5 AS credit
FROM lineitem""",
    # flat form of ``cases``: one row per (order, line) -- orders without
    # lines keep one row with NULL line columns
    "case_lines": """
SELECT o_orderkey // 3 AS id, o_orderkey % 3 AS rev, o_orderkey AS order_key,
  concat('case/', o_orderkey // 3) AS uri,
  CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' ELSE 'closed' END AS state,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'paid' WHEN '2-HIGH' THEN 'cancelled'
    WHEN '3-MEDIUM' THEN 'appealed' WHEN '5-LOW' THEN 'issued' END AS substate,
  concat('s', o_custkey % 3) AS sub_state_1, concat('s', o_custkey % 4 + 3) AS sub_state_2,
  CASE o_custkey % 3 WHEN 0 THEN 'Europe/Copenhagen' WHEN 1 THEN 'Europe/Berlin' ELSE 'Europe/London' END AS timezone,
  o_orderdate + to_minutes(o_orderkey % 1440) AS fact_ts, o_orderdate AS case_ts,
  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'duplicate' END AS canceled_reason,
  concat('org', o_custkey % 7) AS organization,
  concat('org', o_custkey % 7, '#r', o_custkey % 5, '#S', o_custkey % 20) AS site_ref,
  concat('Site ', o_custkey % 20) AS site_name,
  concat('P', o_custkey) AS plate,
  CASE o_custkey % 5 WHEN 0 THEN 'DK' WHEN 1 THEN 'DE' WHEN 2 THEN 'GB' WHEN 3 THEN 'SE' END AS vehicle_state,
  o_orderdate AS arrival, o_orderdate + to_minutes(o_orderkey % 300) AS departure,
  (l_orderkey // 3) * 100 + l_linenumber AS ticket_id, l_shipdate AS issuing_time,
  l_extendedprice / 1000 AS base_fee, l_tax * 100 AS late_fee,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_extendedprice * (1 - l_discount) / 10 END AS paid_amount,
  l_returnflag, l_linestatus AS line_status, l_linenumber,
  CASE WHEN o_orderkey % 11 = 0 THEN [] WHEN o_orderkey % 4 = 0
    THEN [o_orderdate + to_hours(o_orderkey % 2000), o_orderdate + INTERVAL 35 DAY]
    ELSE [o_orderdate + to_hours(o_orderkey % 2000)] END AS offences
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
    "fact_visit": """
SELECT l_orderkey * 10 + l_linenumber AS visit_key, l_suppkey AS site_key, l_partkey AS vehicle_key,
  l_shipdate + to_minutes(l_orderkey % 1440) AS entry_time,
  l_shipdate + to_minutes(l_orderkey % 1440 + CAST(l_quantity AS BIGINT) * 7) AS exit_time,
  CAST(l_shipdate AS DATE) AS entry_date,
  CAST(l_shipdate + to_minutes(l_orderkey % 1440 + CAST(l_quantity AS BIGINT) * 7) AS DATE) AS exit_date,
  l_returnflag AS vehicle_indicator
FROM lineitem""",
    "dim_site": """
SELECT s_suppkey AS site_key, s_name AS site_name, n_name AS country, r_name AS region_name
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "dim_vehicle": """
SELECT p_partkey AS vehicle_key, concat('P', p_partkey) AS plate, p_brand AS make, p_type AS body FROM part""",
    "dim_date": """
SELECT CAST(d AS DATE) AS date, year(d) AS year, month(d) AS month, dayname(d) AS day_name
FROM (SELECT unnest(generate_series(CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE), INTERVAL 1 DAY)) AS d
      FROM lineitem)""",
    "cutover": """
SELECT s_suppkey AS site_key, DATE '1997-01-01' + CAST(s_suppkey * 37 % 1500 AS INTEGER) AS transition_date
FROM supplier WHERE s_suppkey % 4 <> 0""",
}

INPUTS["vehicle_visits"] = INPUTS["visits"].replace("\nFROM ", """,
  CASE WHEN event_id % 6 = 0 THEN '' ELSE concat('mod', user_id % 11) END AS in_model,
  CASE WHEN k % 5 = 0 THEN NULL ELSE concat('mod', user_id % 8) END AS out_model,
  CASE WHEN k % 3 = 0 THEN 2000 + k % 24 END AS in_year, CASE WHEN k % 2 = 0 THEN 2001 + k % 20 END AS out_year,
  CASE WHEN k % 7 = 0 THEN '  ' ELSE concat('fuel', k % 4) END AS in_fuel,
  CASE WHEN k % 2 = 0 THEN NULL ELSE concat('fuel', k % 3) END AS out_fuel,
  CASE WHEN k % 6 = 0 THEN NULL ELSE 90 + k % 60 END AS in_co2,
  CASE WHEN k % 4 = 1 THEN NULL ELSE 900 + k END AS in_weight, 1000 + k AS out_weight
FROM """, 1)
INPUTS["group_log"] = f"""
SELECT *, concat_ws('#', organization, parent, group_id) AS key FROM (
  SELECT concat('org', user_id % 7) AS organization, concat('r', user_id % 5) AS parent, event_type AS group_id, ts AS "timestamp",
    CASE WHEN k % 10 = 0 THEN 'zone' ELSE 'site' END AS type,
    CASE WHEN event_id % 7 = 0 THEN 'GroupDeleted' ELSE 'GroupUpdated' END AS action_type,
    concat('Park ', event_type, ' ', user_id % 5, ' v', event_id % 3) AS name,
    CAST(((user_id % 7) * 13 + (user_id % 5) * 29 + length(event_type) * 7) % 100 AS DOUBLE) / 10 + 175.03 AS lon,
    CAST(((user_id % 7) * 31 + (user_id % 5) * 17 + length(event_type) * 11) % 100 AS DOUBLE) / 10 - 4.99 AS lat
  FROM {_EV}
  UNION ALL
  SELECT concat('org', o_custkey % 7), concat('r', o_custkey % 5), concat('S', o_custkey % 20),
    o_orderdate + to_seconds(o_orderkey % 86400), CASE WHEN o_orderkey % 10 = 0 THEN 'zone' ELSE 'site' END,
    CASE WHEN o_orderkey % 9 = 0 THEN 'GroupDeleted' ELSE 'GroupUpdated' END, concat('Site ', o_custkey % 20, ' v', o_orderkey % 3),
    CAST(((o_custkey % 7) * 13 + (o_custkey % 5) * 29 + (o_custkey % 20) * 7) % 100 AS DOUBLE) / 10 + 175.03,
    CAST(((o_custkey % 7) * 31 + (o_custkey % 5) * 17 + (o_custkey % 20) * 11) % 100 AS DOUBLE) / 10 - 4.99
  FROM orders)"""
# the site dimension: current sites by key parts (needs group_log before it)
INPUTS["sites"] = """
SELECT DISTINCT organization, parent, group_id, name FROM group_log
WHERE (key, "timestamp") IN (SELECT key, max("timestamp") FROM group_log WHERE type = 'site' GROUP BY key)
  AND action_type <> 'GroupDeleted'"""
INPUTS["device_log"] = f"""
SELECT concat('cam', user_id % 12) AS device_id, ts AS "timestamp", CASE WHEN k % 6 = 0 THEN 'relay' ELSE 'mav-camera' END AS device_type,
  CASE WHEN event_id % 8 = 0 THEN 'DeviceDeleted' ELSE 'DeviceUpdated' END AS action_type,
  concat('Camera ', user_id % 12, ' v', event_id % 3) AS name,
  CASE WHEN k % 2 = 0 THEN [concat('org', user_id % 7, '#r', user_id % 5, '#', event_type), 'org0#r0#view']
       ELSE [concat('org', user_id % 7, '#r', user_id % 5, '#', event_type)] END AS group_keys
FROM {_EV}"""
INPUTS["park_status"] = f"""
SELECT event_id, concat('org', user_id % 7) AS org, concat('r', user_id % 5) AS region, event_type AS site,
  CASE k % 5 WHEN 0 THEN 'Active' WHEN 1 THEN 'Created' WHEN 2 THEN 'Stopped' WHEN 3 THEN 'Inactive' END AS status, ts AS created
FROM {_EV}"""
INPUTS["notice_facts"] = f"""
SELECT event_id, event_id // 4 AS case_id, CASE WHEN event_id % 41 <> 0 THEN event_id // 2 END AS breach_id,
  concat('org', user_id % 7) AS org, concat('r', user_id % 5) AS region, event_type AS site, ts + to_seconds(k) AS fact_ts,
  ts AS offense_time, CASE WHEN k % 5 = 0 THEN 'Open' ELSE 'Closed' END AS state,
  CASE k % 9 WHEN 0 THEN 'nip' WHEN 1 THEN 'defaulted' WHEN 2 THEN 'Paid-Online' WHEN 3 THEN 'Appeal-pending'
    WHEN 4 THEN 'lprError' WHEN 5 THEN 'bankpayment' WHEN 6 THEN 'breachError' WHEN 7 THEN 'issued' END AS substate,
  CAST(20 + k AS DOUBLE) AS value, CASE WHEN k % 4 <> 0 THEN CAST(k AS DOUBLE) / 2 END AS receipts
FROM {_EV}"""


def with_inputs(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named derived inputs as CTEs."""
    ctes = ",\n".join(f"{n} AS ({INPUTS[n]})" for n in names)
    body = sql.strip()
    m = re.match(r"(?is)^with\s+", body)
    if m:
        return f"WITH {ctes},\n{body[m.end():]}"
    return f"WITH {ctes}\n{body}"


def _polygon_sql() -> str:
    from kerbside.sources.derived import POLYGON_TEMPLATES
    whens = []
    for s, tmpl in POLYGON_TEMPLATES.items():
        rings = ", ".join("[" + ", ".join(f"{{'lon': 2 * i + {float(dx)}, 'lat': 2 * j + {float(dy)}}}"
                                          for dx, dy in ring) + "]" for ring in tmpl)
        whens.append(f"WHEN {s} THEN [{rings}]")
    return (f"SELECT n_nationkey, n_name, CASE (n_nationkey + n_nationkey // 5) % 5 {' '.join(whens)} END AS rings "
            "FROM (SELECT *, CAST(n_nationkey % 5 AS DOUBLE) AS i, CAST(n_nationkey // 5 AS DOUBLE) AS j FROM nation)")


INPUTS["polygons"] = _polygon_sql()
INPUTS["points"] = """
SELECT c_custkey, c_mktsegment, CAST(c_custkey % 100 AS DOUBLE) / 10 AS lon, CAST(c_custkey * 7 % 100 AS DOUBLE) / 10 AS lat
FROM customer"""
INPUTS["poly_edges"] = """
SELECT n_nationkey, ring[k + 1].lon AS x1, ring[k + 1].lat AS y1,
  ring[(k + 1) % len(ring) + 1].lon AS x2, ring[(k + 1) % len(ring) + 1].lat AS y2
FROM (SELECT n_nationkey, ring, unnest(range(len(ring))) AS k
      FROM (SELECT n_nationkey, unnest(rings) AS ring FROM polygons))"""
