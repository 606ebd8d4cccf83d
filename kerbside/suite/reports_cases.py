"""Registered queries for the notice, ledger and backlog reports of §2.11."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.functions.timefn import between_local_days, local_date
from kerbside.functions.values import json_text, key_part
from kerbside.operators import joins as J
from kerbside.operators import windows as W
from kerbside.plans import backlog as PB
from kerbside.plans import cases as PC
from kerbside.plans.visits import latest_visits
from kerbside.sources import derived as D
from kerbside.suite.common import day_text, r6
from kerbside.suite.oracle_inputs import with_inputs

QUERIES: dict = {}
ORACLE: dict = {}
NZ = "Pacific/Auckland"
EXCL_SUB = ["appealed", "s6"]
EXCL_REASON = ["duplicate"]


def q(name, sql=None, inputs=()):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_inputs(sql, *inputs) if inputs else sql.strip()
        return fn
    return deco


def _label_case(expr: str) -> str:
    whens = " ".join(f"WHEN lower({expr}) IN ({', '.join(repr(v) for v in vs)}) THEN '{k}'"
                     for k, vs in PC.SUBSTATE_LABELS.items())
    return f"CASE {whens} ELSE {expr} END"


def _in(vals) -> str:
    return ", ".join(repr(v) for v in vals)


_LOCAL_FACT = "timezone(timezone, fact_ts AT TIME ZONE 'UTC')"
_EXCLUDED = f"""ex AS (SELECT DISTINCT id FROM case_lines WHERE lower(substate) IN ({_in(EXCL_SUB)})
    OR lower(sub_state_1) IN ({_in(EXCL_SUB)}) OR lower(sub_state_2) IN ({_in(EXCL_SUB)})
    OR lower(canceled_reason) IN ({_in(EXCL_REASON)}))"""
_NEWEST = """cur AS (SELECT * FROM case_lines WHERE (id, rev) IN (SELECT id, max(rev) FROM case_lines GROUP BY id))"""


@q("case_status_current", f"""
WITH {_EXCLUDED},
c AS (SELECT * FROM case_lines WHERE CAST({_LOCAL_FACT} AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
      AND id NOT IN (SELECT id FROM ex)),
r AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY id, ticket_id ORDER BY fact_ts DESC, rev DESC, base_fee DESC) = 1),
n AS (SELECT group_id, name FROM group_log QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY "timestamp" DESC, name DESC) = 1)
SELECT id, rev, state, lower(state) AS state_lower, date_trunc('second', {_LOCAL_FACT}) AS update_time, site_ref,
  ticket_id, {_label_case('coalesce(substate, sub_state_1)')} AS status,
  CASE WHEN ticket_id IS NOT NULL THEN 'parking' END AS offense_type, round(base_fee, 6) AS fee, n.name AS site_name
FROM r JOIN n ON n.group_id = split_part(site_ref, '#', 3) WHERE coalesce(substate, sub_state_1) IS NOT NULL""", ["case_lines", "group_log"])
def case_status_current(spark, base):
    from kerbside.plans.dimension import newest_names
    c = PC.case_status(D.cases(spark, base), "19970101", "19971231", EXCL_SUB, EXCL_REASON,
                       case_heads=D.cases(spark, base, with_breaches=False), names=newest_names(D.group_log(spark, base)))
    return c.withColumn("fee", r6("fee"))


@q("case_financials", f"""
WITH case_total AS (SELECT order_key, sum(base_fee + late_fee) AS fees, sum(paid_amount) AS receipts FROM case_lines GROUP BY order_key),
newest AS (SELECT id, ticket_id, max({{'t': fact_ts, 'r': rev}}) AS m FROM case_lines WHERE ticket_id IS NOT NULL GROUP BY ALL)
SELECT DISTINCT l.id, l.ticket_id, round(t.fees, 6) AS fees, round(t.receipts, 6) AS receipts, {_LOCAL_FACT} AS fact_local,
  date_trunc('second', timezone(timezone, case_ts AT TIME ZONE 'UTC')) AS case_local,
  timezone(timezone, arrival AT TIME ZONE 'UTC') AS arrival_local, timezone(timezone, departure AT TIME ZONE 'UTC') AS departure_local,
  s.name AS site_name
FROM case_lines l JOIN sites s ON l.site_ref = concat_ws('#', s.organization, s.parent, s.group_id) JOIN newest n ON n.id = l.id AND n.ticket_id = l.ticket_id AND n.m.r = l.rev AND n.m.t = l.fact_ts
JOIN case_total t ON t.order_key = l.order_key
WHERE CAST(timezone(timezone, case_ts AT TIME ZONE 'UTC') AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'""", ["case_lines", "group_log", "sites"])
def case_financials(spark, base):
    from kerbside.plans.dimension import site_dimension
    f = PC.case_financials(D.cases(spark, base), "19980101", "19981231", site_dimension(D.group_log(spark, base)))
    return f.withColumns({"fees": r6("fees"), "receipts": r6("receipts")})


_DK = "Europe/Copenhagen"


@q("monthly_kpi", f"""
WITH o AS (SELECT * EXCLUDE (offences), unnest(offences) AS off FROM case_lines),
r AS (SELECT o.*, s.parent, s.name AS site, strftime(timezone('{_DK}', off AT TIME ZONE 'UTC'), '%Y-%m') AS month
      FROM o JOIN sites s ON o.site_ref = concat_ws('#', s.organization, s.parent, s.group_id)
      WHERE CAST(off AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'),
m AS (SELECT parent, site AS site_name, month, count(DISTINCT ticket_id) AS notices,
             count(DISTINCT ticket_id) FILTER (WHERE lower(substate) = 'paid' AND state = 'Closed') AS paid,
             count(ticket_id) FILTER (WHERE substate = 'cancelled') AS cancelled
      FROM r GROUP BY ALL)
SELECT *, lag(notices) OVER w AS prev_notices, lag(paid) OVER w AS prev_paid, lag(cancelled) OVER w AS prev_cancelled
FROM m WINDOW w AS (PARTITION BY site_name ORDER BY month, parent)""", ["case_lines", "group_log", "sites"])
def monthly_kpi(spark, base):
    from kerbside.plans.dimension import site_dimension
    return PC.monthly_offence_kpi(D.cases(spark, base), site_dimension(D.group_log(spark, base)), "19960101", "19971231", _DK,
                                  paid=["paid"], cancelled=["cancelled"])


@q("monthly_kpi_case_time", f"""
WITH b AS (SELECT *, timezone('{_DK}', case_ts AT TIME ZONE 'UTC') AS seen FROM case_lines
           WHERE CAST(case_ts AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'),
m AS (SELECT site_ref, site_name, strftime(seen, '%Y-%m') AS month, count(DISTINCT ticket_id) AS notices,
             count(DISTINCT ticket_id) FILTER (WHERE lower(substate) = 'paid' AND state = 'Closed') AS paid,
             count(ticket_id) FILTER (WHERE substate = 'cancelled') AS cancelled
      FROM b GROUP BY ALL)
SELECT *, lag(notices) OVER w AS prev_notices, lag(paid) OVER w AS prev_paid, lag(cancelled) OVER w AS prev_cancelled
FROM m WINDOW w AS (PARTITION BY site_ref, site_name ORDER BY month)""", ["case_lines"])
def monthly_kpi_case_time(spark, base):
    """The same by case time and per (site reference, name)."""
    return PC.monthly_kpi(D.cases(spark, base), "19960101", "19971231", _DK, paid=["paid"], cancelled=["cancelled"])


@q("foreign_notices", """
WITH near AS (SELECT id, max(rev) AS rev FROM case_lines
              WHERE CAST(timezone('Europe/Berlin', case_ts AT TIME ZONE 'UTC') AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'
              GROUP BY id),
t AS (SELECT order_key, sum(base_fee + late_fee) AS value, sum(paid_amount) AS receipts FROM case_lines GROUP BY order_key)
SELECT c.id, c.rev, c.state, c.substate, date_trunc('second', timezone(c.timezone, c.case_ts AT TIME ZONE 'UTC')) AS case_local,
  date_trunc('second', timezone(c.timezone, c.issuing_time AT TIME ZONE 'UTC')) AS issuing_local, c.vehicle_state, c.organization,
  round(t.value, 6) AS value, round(t.receipts, 6) AS receipts, count(*) AS foreign_rows
FROM case_lines c JOIN near n ON c.id = n.id AND c.rev = n.rev JOIN t ON t.order_key = c.order_key
WHERE c.state <> 'closed' AND c.substate NOT IN ('breachError', 'nip') AND c.vehicle_state <> 'DK'
GROUP BY ALL""", ["case_lines"])
def foreign_notices(spark, base):
    f = PC.foreign_notices(D.cases(spark, base), ["DK"], "19960101", "19971231", "Europe/Berlin",
                           heads=D.cases(spark, base, with_breaches=False))
    return f.withColumns({"value": r6("value"), "receipts": r6("receipts")})


@q("stay_case_overview", f"""
WITH lv AS (SELECT * FROM visits WHERE visit_id NOT IN (SELECT visit_id FROM visits WHERE action = 'deleted')
            QUALIFY row_number() OVER (PARTITION BY visit_id ORDER BY updated DESC, rev_id DESC) = 1),
z AS (SELECT lv.visit_id, lv.ors_id, date_trunc('second', timezone(t.timezone, arrival AT TIME ZONE 'UTC')) AS came,
             date_trunc('second', timezone(t.timezone, departure AT TIME ZONE 'UTC')) AS went
      FROM lv LEFT JOIN org_timezone t ON t.org = split_part(ors_id, '#', 1)),
frames AS (SELECT CAST(visit_id AS VARCHAR) AS frame_id, nullif(split_part(ors_id, '#', 3), '') AS site_id, 'N/A' AS case_id, 'N/A' AS breach_id, 'N/A' AS state,
  'N/A' AS sub_state, CAST((came IS NOT NULL AND went IS NOT NULL) AS INTEGER) AS stay, CAST((came IS NOT NULL) AS INTEGER) AS arrivals,
  CAST((went IS NOT NULL) AS INTEGER) AS departures, CAST(coalesce(came, went) AS DATE) AS day,
  coalesce(round(date_diff('second', came, went) / 60, 1), 0) AS stay_minutes, CAST(hour(coalesce(came, went)) AS INTEGER) AS hour FROM z),
{_EXCLUDED},
fan AS (SELECT DISTINCT id, rev, state, case_ts, timezone, ticket_id, site_ref, unnest(CASE WHEN substate IS NULL THEN [sub_state_1, sub_state_2] ELSE [substate] END) AS sub
        FROM case_lines WHERE id NOT IN (SELECT id FROM ex)),
firsts AS (SELECT *, date_trunc('second', timezone(timezone, case_ts AT TIME ZONE 'UTC')) AS seen FROM fan
           QUALIFY row_number() OVER (PARTITION BY id, ticket_id, state, sub ORDER BY rev, site_ref) = 1),
states AS (SELECT 'N/A' AS frame_id, split_part(site_ref, '#', 3) AS site_id, CAST(id AS VARCHAR) AS case_id, CAST(ticket_id AS VARCHAR) AS breach_id, state,
  sub AS sub_state, 0 AS stay, 0 AS arrivals, 0 AS departures, CAST(seen AS DATE) AS day, CAST(0 AS DOUBLE) AS stay_minutes, CAST(hour(seen) AS INTEGER) AS hour
  FROM firsts WHERE CAST(seen AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'),
n AS (SELECT group_id, name FROM group_log QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY "timestamp" DESC, name DESC) = 1),
u AS (SELECT DISTINCT * FROM (SELECT * FROM frames WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND stay_minutes <= 10000
                              UNION ALL SELECT * FROM states))
SELECT u.* EXCLUDE (day), strftime(day, '%Y-%m-%d') AS day, strftime(day, '%A') AS weekday, n.name AS site_name FROM u JOIN n ON n.group_id = u.site_id""",
   ["visits", "org_timezone", "case_lines", "group_log"])
def stay_case_overview(spark, base):
    from kerbside.plans.dimension import newest_names
    heads = D.cases(spark, base, with_breaches=False)
    # one fixture, two spans of time: the frames lie in 2024, the cases in the nineties
    frames = PC.stay_frames(D.visits(spark, base), D.org_timezone(spark), "20240105", "20240125")
    states = PC.first_states(D.cases(spark, base), heads, "19970101", "19971231", EXCL_SUB, EXCL_REASON)
    return PC.stay_case_overview(frames, states, newest_names(D.group_log(spark, base))).withColumn("day", day_text("day"))


_PCN = f"""SELECT ticket_id, 'parking' AS offense_type, base_fee AS fee_amount, 'base' AS fee_source,
             timezone('{_DK}', fact_ts AT TIME ZONE 'UTC') AS updated, state, substate, organization, site_ref AS group_ref
      FROM case_lines WHERE state = 'Closed' AND ticket_id IS NOT NULL"""
_LINES = """SELECT site, (breach_id // 3) * 100 + line_no AS ticket_id, "time" AS line_time, debit, breach_id FROM ledger
            WHERE CAST("time" AS DATE) >= DATE '1995-01-01'"""
_ON_SITE = "JOIN sites s ON p.group_ref = concat_ws('#', s.organization, s.parent, s.group_id)"


@q("ledger_reconcile", f"""
WITH p AS ({_PCN} QUALIFY row_number() OVER (PARTITION BY organization, site_name, ticket_id
                                            ORDER BY fact_ts DESC, rev DESC, base_fee DESC, site_ref DESC) = 1),
l AS ({_LINES})
SELECT p.* EXCLUDE (fee_amount), round(p.fee_amount, 6) AS fee_amount, s.name AS site_name, l.line_time, round(coalesce(l.debit, 0), 6) AS debit
FROM p LEFT JOIN l ON p.ticket_id = l.ticket_id {_ON_SITE}""", ["case_lines", "ledger", "group_log", "sites"])
def ledger_reconcile(spark, base):
    return _reconciled(spark, base, False).withColumns({"fee_amount": r6("fee_amount"), "debit": r6("debit")})


@q("ledger_reconcile_latest", f"""
WITH p AS ({_PCN} QUALIFY row_number() OVER (PARTITION BY site_ref, ticket_id ORDER BY fact_ts DESC, rev DESC, base_fee DESC) = 1),
l AS ({_LINES} QUALIFY row_number() OVER (PARTITION BY site, ticket_id ORDER BY "time" DESC, breach_id DESC, debit DESC) = 1)
SELECT DISTINCT p.* EXCLUDE (fee_amount), round(p.fee_amount, 6) AS fee_amount, s.name AS site_name, l.line_time
FROM p JOIN l ON p.ticket_id = l.ticket_id {_ON_SITE}""", ["case_lines", "ledger", "group_log", "sites"])
def ledger_reconcile_latest(spark, base):
    return _reconciled(spark, base, True).withColumn("fee_amount", r6("fee_amount"))


def _reconciled(spark, base, newest_line_only):
    from kerbside.plans.dimension import site_dimension
    lines = D.ledger(spark, base).withColumn("ticket_id", F.expr("(breach_id div 3) * 100 + line_no"))
    return PC.reconcile(D.cases(spark, base), lines, site_dimension(D.group_log(spark, base)), _DK, "19950101", newest_line_only)


@q("ledger_receipts", f"""
SELECT breach_id, line_no, site, "time", transaction_type, description, 875.0::DOUBLE AS base_fee FROM ledger
WHERE debit >= 875 AND site = 'S7' AND CAST("time" AS DATE) >= DATE '1995-01-01'
  AND CAST(timezone('{_DK}', "time" AT TIME ZONE 'UTC') AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""", ["ledger"])
def ledger_receipts(spark, base):
    return PC.debit_receipts(D.ledger(spark, base), "S7", "19960101", "19971231", _DK, since="19950101")


@q("ledger_receipts_credit", f"""
WITH f AS (SELECT site, breach_id, min(struct_pack(t := "time", n := line_no, c := credit, d := debit, k := transaction_type, x := description)) AS m
           FROM ledger WHERE CAST("time" AS DATE) >= DATE '1995-01-01' GROUP BY ALL),
l AS (SELECT *, timezone('{_DK}', m.t AT TIME ZONE 'UTC') AS updated FROM f WHERE site = 'S7')
SELECT breach_id, m.n AS line_no, site, updated, m.k AS transaction_type, m.x AS description, round(m.c, 6) AS credit,
  CASE WHEN m.c < 875 THEN 0.0::DOUBLE ELSE 875.0::DOUBLE END AS amount
FROM l WHERE updated >= TIMESTAMP '1996-01-01 00:00:00' AND updated <= TIMESTAMP '1997-12-31 00:00:00' AND m.c <> 0""", ["ledger"])
def ledger_receipts_credit(spark, base):
    r = PC.credit_receipts(D.ledger(spark, base), "S7", "19960101", "19971231", _DK, since="19950101")
    return r.withColumn("credit", r6("credit"))


_STATUS_ALL = """
SELECT case_uri, event_id, ts, CAST(timezone('Pacific/Auckland', ts AT TIME ZONE 'UTC') AS DATE) AS d,
  coalesce(json_extract_string(data, '$.tags.correspondence'), json_extract_string(data, '$.value')) AS status
FROM case_events WHERE type IN ('StatusChanged', 'CorrespondenceAdded')"""


@q("status_backlog", f"""
WITH s AS ({_STATUS_ALL}),
o AS (SELECT *, lag(status) OVER (PARTITION BY case_uri ORDER BY ts, event_id) AS prev FROM s),
t AS (SELECT d, sum(CASE WHEN status = 'Open' AND prev IS DISTINCT FROM 'Open' THEN 1 ELSE 0 END) AS opened,
             sum(CASE WHEN status = 'Resolved' AND prev IS DISTINCT FROM 'Resolved' THEN 1 ELSE 0 END) AS resolved
      FROM o GROUP BY d),
b AS (SELECT *, sum(opened - resolved) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS backlog FROM t)
SELECT strftime(d, '%Y-%m-%d') AS day, opened, resolved, backlog FROM b
WHERE d BETWEEN DATE '2024-01-10' AND DATE '2024-01-25'""", ["case_events"])
def status_backlog(spark, base):
    e = D.case_events(spark, base).where(F.col("type").isin("StatusChanged", "CorrespondenceAdded"))
    s = e.select("case_uri", "event_id", "ts", local_date("ts", NZ).alias("d"),
                 F.coalesce(json_text("data", "$.tags.correspondence"), json_text("data", "$.value")).alias("status"))
    b = PB.backlog(s, "case_uri", "ts", "status", "d", "Open", "Resolved", "20240110", "20240125", tiebreak="event_id")
    return b.select(day_text("d").alias("day"), "opened", "resolved", "backlog")


@q("case_resolution_time", """
WITH s AS (SELECT event_id, case_uri, ts, author, json_extract_string(data, '$.value') AS status
           FROM case_events WHERE type = 'StatusChanged'),
n AS (SELECT *, lead(status) OVER w AS next_status, lead(author) OVER w AS next_author, lead(ts) OVER w AS next_ts
      FROM s WINDOW w AS (PARTITION BY case_uri ORDER BY ts, event_id)),
pairs AS (SELECT *, (SELECT arg_min(m.next_author, {'t': m.ts, 'e': m.event_id}) FROM n m WHERE m.case_uri = n.case_uri
                     AND m.next_author IS NOT NULL AND (m.ts, m.event_id) >= (n.ts, n.event_id)) AS resolver
          FROM n WHERE (status, next_status) IN (('Open', 'Resolved'), ('Resolved', 'Open')))
SELECT p.event_id, p.case_uri, p.status, p.ts AS updated, p.next_status, p.next_ts AS next_updated,
  date_diff('day', p.ts, p.next_ts) AS days_to_next, date_diff('hour', p.ts, p.next_ts) AS hours_to_next,
  CASE p.status WHEN 'Open' THEN p.resolver ELSE p.author END AS final_author, t.id AS case_id, t.ticket_id
FROM pairs p LEFT JOIN (SELECT DISTINCT uri, id, ticket_id FROM case_lines WHERE ticket_id IS NOT NULL) t ON p.case_uri = t.uri""",
   ["case_events", "case_lines"])
def case_resolution_time(spark, base):
    """Moves between open and resolved with their final author, one row per breach of the case."""
    e = (D.case_events(spark, base).where(F.col("type") == "StatusChanged")
         .select("event_id", "case_uri", "ts", "author", json_text("data", "$.value").alias("status")))
    r = PB.resolution_pairs(PB.resolution_times(e, "case_uri", "ts", "status", "author", tiebreak="event_id"),
                            "status", "author", "Open", "Resolved")
    c = D.cases(spark, base)
    t = c.select("uri", F.col("id").alias("case_id"), F.explode("breaches.ticket_id").alias("ticket_id")) \
         .where(F.col("ticket_id").isNotNull()).distinct()
    j = r.join(t, r.case_uri == t.uri, "left")
    return j.select("event_id", "case_uri", "status", F.col("ts").alias("updated"), "next_status",
                    F.col("next_ts").alias("next_updated"), "days_to_next", "hours_to_next", "final_author", "case_id",
                    "ticket_id")


@q("correspondence_transitions", f"""
WITH c AS (SELECT uri, ts, event_id, CAST(timezone('{NZ}', ts AT TIME ZONE 'UTC') AS DATE) AS d,
                  json_extract_string(user_json, '$.name') AS user_name,
                  json_extract_string(data, '$.mailUpdate.labels.Resolved') AS yes,
                  json_extract_string(data, '$.mailUpdate.labels.Unresolved') AS no
           FROM correspondence WHERE json_extract(data, '$.mailUpdate.labels') IS NOT NULL),
k AS (SELECT *, CASE WHEN no = 'true' AND yes IS DISTINCT FROM 'true' THEN 'Unresolved'
                     WHEN yes = 'true' AND no = 'false' THEN 'Resolved' WHEN no = 'true' THEN 'Unresolved' END AS kind
      FROM c WHERE d BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'),
f AS (SELECT uri, kind, min(struct_pack(d := d, t := ts, e := event_id, u := user_name)) AS m FROM k WHERE kind IS NOT NULL GROUP BY ALL)
SELECT strftime(m.d, '%Y-%m-%d') AS day, uri, m.u AS user_name, kind AS transition_type,
  CASE WHEN kind = 'Unresolved' THEN 1 ELSE 0 END AS unresolved_count, CASE WHEN kind = 'Resolved' THEN 1 ELSE 0 END AS resolved_count
FROM f""", ["correspondence"])
def correspondence_transitions(spark, base):
    c = D.correspondence(spark, base).where(between_local_days("ts", NZ, "20240105", "20240125"))
    t = PB.mail_transitions(c, "uri", "ts", "data", "user_json", NZ, tiebreak="event_id")
    return t.withColumn("day", day_text("day"))


_DAILY_STATUS = """
WITH s AS (SELECT case_uri, author, CAST(timezone('Pacific/Auckland', ts AT TIME ZONE 'UTC') AS DATE) AS d,
                  coalesce(json_extract_string(data, '$.tags.correspondence'), json_extract_string(data, '$.value')) AS status
           FROM case_events WHERE type IN ('StatusChanged', 'CorrespondenceAdded')),
dc AS (SELECT d, status, count(DISTINCT case_uri) AS items, list(DISTINCT author) FILTER (WHERE author IS NOT NULL) AS authors
       FROM s GROUP BY d, status),
pd AS (SELECT d, sum(CASE WHEN status = 'Open' THEN items ELSE 0 END) AS opened,
              sum(CASE WHEN status = 'Resolved' THEN items ELSE 0 END) AS resolved,
              flatten(list(authors)) AS authors FROM dc GROUP BY d)"""


def _status_days(spark, base):
    e = D.case_events(spark, base).where(F.col("type").isin("StatusChanged", "CorrespondenceAdded"))
    return e.select("case_uri", "author", local_date("ts", NZ).alias("d"),
                    F.coalesce(json_text("data", "$.tags.correspondence"), json_text("data", "$.value")).alias("status"))


@q("status_backlog_distinct", _DAILY_STATUS + """
SELECT strftime(d, '%Y-%m-%d') AS day, opened, resolved,
  sum(opened - resolved) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS backlog,
  array_to_string(list_sort(authors), ',') AS authors
FROM pd WHERE d BETWEEN DATE '2024-01-06' AND DATE '2024-01-25'""", ["case_events"])
def status_backlog_distinct(spark, base):
    b = PB.distinct_backlog(_status_days(spark, base), "case_uri", "d", "status", "Open", "Resolved",
                            "20240106", "20240125", author="author")
    return b.select(day_text("d").alias("day"), "opened", "resolved", "backlog",
                    F.when(F.size("authors") > 0, F.array_join(F.sort_array("authors"), ",")).alias("authors"))


@q("status_backlog_opening", _DAILY_STATUS + """,
op AS (SELECT coalesce(sum(opened - resolved), 0) AS opening FROM pd WHERE d BETWEEN DATE '2024-01-02' AND DATE '2024-01-09')
SELECT strftime(d, '%Y-%m-%d') AS day, opened, resolved,
  sum(opened - resolved) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + (SELECT opening FROM op) AS backlog
FROM pd WHERE d BETWEEN DATE '2024-01-10' AND DATE '2024-01-25'""", ["case_events"])
def status_backlog_opening(spark, base):
    b = PB.distinct_backlog(_status_days(spark, base), "case_uri", "d", "status", "Open", "Resolved",
                            "20240110", "20240125", opening_from="20240102")
    return b.select(day_text("d").alias("day"), "opened", "resolved", "backlog")
