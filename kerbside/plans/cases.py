"""Notice (case) reports over revisioned documents with nested breaches.

Nested arrays are read with ``explode`` only for the arrays a report
actually reads; totals over nested arrays are computed per row with
higher-order functions (no join, no fan-out).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.timefn import local_time
from kerbside.functions.values import key_part, recode
from kerbside.operators import joins as J
from kerbside.operators import windows as W
from kerbside.operators.ranges import spread, stored

# Sub-state spellings normalised to report labels (reference lists).
SUBSTATE_LABELS = {
    "BreachIssued": ["breach_issued", "breachissued", "breach-issued"],
    "ReminderIssued": ["reminder_issued", "reminderissued", "reminder-issued"],
    "NoInformationPresent": ["noinformatiopresent", "noinformationpresent"],
    "PaidOnline": ["paid", "paid_online"],
    "BreachPaidDirect": ["breach-paid-direct"],
    "AppealAccepted": ["appeal-accepted"],
    "NoDetail": ["nodetail"],
    "Defaulted": ["defaulted"],
    "SpecialCircumstance": ["special-circumstance"],
}


def site_group(groups: str = "groups", field: str = "group_ref") -> Column:
    """The 'site' entry of a groups array (first one), without exploding groups."""
    return F.get(F.filter(groups, lambda g: F.lower(g["type"]) == "site"), F.lit(0))[field]


def excluded_case_ids(cases: DataFrame, substates: Iterable[str], reasons: Iterable[str]) -> DataFrame:
    """Ids of cases with an excluded sub-state (scalar or in the list) or cancel reason."""
    subs = [s.lower() for s in substates]
    lst = F.transform(F.coalesce("sub_states", F.array()), lambda x: F.lower(x))
    hit = (F.lower("substate").isin(subs) | F.arrays_overlap(lst, F.array(*[F.lit(s) for s in subs]))
           | F.lower("canceled_reason").isin([r.lower() for r in reasons]))
    return cases.where(hit).select("id").distinct()


def case_status(cases: DataFrame, start, end, exclude_substates=(), exclude_reasons=(),
                labels: Mapping[str, list[str]] = SUBSTATE_LABELS, case_heads: DataFrame | None = None,
                names: DataFrame | None = None) -> DataFrame:
    """Newest revision per (case, breach) in a local-date window, with normalised status.

    * local day of the fact time (per-row zone) in [start, end], filtered
      before ranking;
    * cases whose id is in the exclusion list are dropped (NOT IN, NULL-aware);
    * sub-state: the scalar one, else the first of the list (the ranking keeps
      one row of the fan-out over fees and sub-states; here the first of
      each); rows without one are dropped after ranking, the rest recoded by
      ``labels`` (unlisted values kept);
    * offence type and amount of the breach's first fee;
    * ``names`` (group_id, site_name): only sites with a name stay.

    ``case_heads`` (the same cases without the nested breaches, if the
    source can give them cheaply) is used for the exclusion list so it does
    not re-run the nesting.
    """
    from kerbside.functions.timefn import between_local_days
    c = cases.where(between_local_days("fact_ts", F.col("timezone"), start, end))
    heads = cases if case_heads is None else case_heads
    c = J.anti_null_aware(c, excluded_case_ids(heads, exclude_substates, exclude_reasons), "id")
    # narrow the row before ranking: the ranking aggregate carries only scalars
    b = J.explode_keep(c.select("id", "rev", "state", "timezone", "fact_ts", site_group().alias("site_ref"),
                                F.coalesce(F.col("substate"), F.get("sub_states", F.lit(0))).alias("upd"), "breaches"),
                       "breaches", "b").select("id", "rev", "state", "timezone", "fact_ts", "site_ref", "upd",
                                               F.col("b.ticket_id").alias("ticket_id"), F.get("b.fees", F.lit(0))["type"].alias("offense_type"),
                                               F.get("b.fees", F.lit(0))["amount"].alias("fee"))
    cur = W.latest_by_key(b, ["id", "ticket_id"], "fact_ts", tiebreak=["rev", "fee"]).where(F.col("upd").isNotNull())
    extra = []
    if names is not None:
        cur = cur.withColumn("group_id", key_part("site_ref", 2)).join(names, "group_id")
        extra = ["offense_type", "fee", "site_name"]
    return cur.select(
        "id", "rev", "state", F.lower("state").alias("state_lower"),
        F.date_trunc("second", local_time("fact_ts", F.col("timezone"))).cast("timestamp_ntz").alias("update_time"),
        "site_ref", "ticket_id", recode("upd", labels).alias("status"), *extra)


def case_total(field: str) -> Column:
    """Sum of ``amount`` over a nested array of every breach of the case; NULL without any."""
    return J.sum_array(F.flatten(F.transform("breaches", lambda b: F.coalesce(b[field], F.array()))), "amount")


def case_financials(cases: DataFrame, start, end, sites: DataFrame | None = None) -> DataFrame:
    """Newest fact per (case, breach) with the whole case's fee and receipt totals and local times.
    With ``sites``, only cases at a current site, with its name.

    The totals run over every breach of the case revision, so they repeat on
    each of its breaches.  Ranking runs on the whole history; the case time's
    local day then selects the window.
    """
    from kerbside.functions.timefn import local_date, parse_day

    b = J.explode_drop(cases.withColumns({"__fees": case_total("fees"), "__paid": case_total("transactions")}), "breaches", "b").select(
        "id", "rev", "fact_ts", "case_ts", "timezone", "arrival", "departure", F.col("b.ticket_id").alias("ticket_id"),
        *([site_group().alias("site_ref")] if sites is not None else []), F.col("__fees").alias("fees"), F.col("__paid").alias("receipts")).where(F.col("ticket_id").isNotNull())
    cur = W.latest_by_key(b, ["id", "ticket_id"], "fact_ts", tiebreak=["rev", "fees", "receipts"])
    tz = F.col("timezone")
    cur = cur.where(local_date("case_ts", tz).between(F.lit(parse_day(start)), F.lit(parse_day(end))))
    extra = []
    if sites is not None:
        from kerbside.plans.dimension import key_parts, with_site
        cur, extra = with_site(cur, sites, key_parts("site_ref"), how="inner"), ["site_name"]
    return cur.select(*extra, "id", "ticket_id", "fees", "receipts", local_time("fact_ts", tz).alias("fact_local"),
                      F.date_trunc("second", local_time("case_ts", tz)).cast("timestamp_ntz").alias("case_local"),
                      local_time("arrival", tz).alias("arrival_local"),
                      local_time("departure", tz).alias("departure_local"))


def newest_revision(cases: DataFrame, inner: Column | None = None, heads: DataFrame | None = None) -> DataFrame:
    """Rows at each case id's highest revision (``(id, rev) IN (SELECT id, MAX(rev) ...)``).

    ``heads``: the same cases without nested arrays; the max revision is
    taken from it so the nested documents are read once.
    """
    return W.latest_ties(cases, "id", "rev", inner=inner, source=heads)


# Sub-states of the monthly report.
PAID_SUBSTATES = ("breach-paid-direct", "bankpayment", "paid-online", "paid_online", "paidonline")
CANCELLED_SUBSTATES = ("nip", "svc-cancel", "breachError", "lprError", "noownershipdetails", "updatedownershipdetails")


def monthly_kpi(cases: DataFrame, start, end, tz: str, paid: Iterable[str] = PAID_SUBSTATES,
                cancelled: Iterable[str] = CANCELLED_SUBSTATES) -> DataFrame:
    """Notices, paid and cancelled per site and local month, with the site's previous existing month.

    Every revision counts, as in the script; the period is on the UTC day.
    Notices and paid are distinct breaches (paid: sub-state in the list, any
    letter case, and state 'Closed'); cancelled counts exploded rows whose
    sub-state is in its list as written.  The lag is a window per site over
    its months.  Sites with one name under two parents are kept apart.
    """
    from kerbside.functions.timefn import day_range
    b = J.explode_keep(cases.where(day_range("case_ts", start, end)).select(
        "state", "substate", "case_ts", site_group().alias("site_ref"), site_group(field="name").alias("site_name"), "breaches"),
        "breaches", "b").where(F.col("site_ref").isNotNull())
    ticket = F.col("b.ticket_id")
    done = F.lower("substate").isin(list(paid)) & (F.col("state") == "Closed")
    m = b.groupBy("site_ref", "site_name", F.date_format(local_time("case_ts", tz), "yyyy-MM").alias("month")).agg(
        F.count_distinct(ticket).alias("notices"), F.count_distinct(F.when(done, ticket)).alias("paid"),
        F.count_if(ticket.isNotNull() & F.col("substate").isin(list(cancelled))).alias("cancelled"))
    return W.with_previous(m, ["site_ref", "site_name"], "month", ["notices", "paid", "cancelled"])


def foreign_notices(cases: DataFrame, home: Iterable[str], start, end, tz: str, heads: DataFrame | None = None) -> DataFrame:
    """Open notices whose vehicle is registered outside ``home``, with whole-case value and receipts.

    Newest revision of each case among those whose case day (local in
    ``tz``) lies in the period.  State 'closed', sub-states breachError and
    nip, and NULLs in any of the three tests drop the row (three-valued
    logic).  Equal rows are one; ``foreign_rows`` is how many it stands for.
    """
    from kerbside.functions.timefn import between_local_days
    cur = newest_revision(cases, inner=between_local_days("case_ts", tz, start, end), heads=heads)
    cur = cur.where((F.col("state") != "closed") & (F.col("substate") != "breachError") & (F.col("substate") != "nip")
                    & ~F.col("vehicle.state").isin(list(home)))
    local = lambda c: F.date_trunc("second", local_time(c, F.col("timezone"))).cast("timestamp_ntz")
    b = J.explode_keep(cur.withColumns({"value": case_total("fees"), "receipts": case_total("transactions")}), "breaches", "b")
    return b.groupBy("id", "rev", "state", "substate", local("case_ts").alias("case_local"),
                     local("b.issuing_time").alias("issuing_local"), F.col("vehicle.state").alias("vehicle_state"),
                     "organization", "value", "receipts").agg(F.count(F.lit(1)).alias("foreign_rows"))


def _clip(amount: str, cap: float) -> Column:
    return F.when(F.col(amount) >= cap, F.lit(cap)).otherwise(F.lit(0.0))


def debit_receipts(ledger: DataFrame, site: str, start, end, tz: str, since, cap: float = 875.0) -> DataFrame:
    """Every ledger line of a site on local days in the period, debit clipped to the base fee
    (>= cap → cap, else 0); zeros dropped.  ``since`` bounds the UTC day."""
    from kerbside.functions.timefn import between_local_days, parse_day
    lines = ledger.where((F.col("site") == site) & (F.to_date("time") >= F.lit(parse_day(since)))
                         & between_local_days("time", tz, start, end))
    return lines.select("breach_id", "line_no", "site", "time", "transaction_type", "description",
                        _clip("debit", cap).alias("base_fee")).where(F.col("base_fee") != 0)


def credit_receipts(ledger: DataFrame, site: str, start, end, tz: str, since, cap: float = 875.0) -> DataFrame:
    """First ledger line per (site, breach) from ``since`` (UTC day) on, if it has a credit and lies between
    the local midnights of ``start`` and ``end``; credit clipped to the base fee."""
    from kerbside.functions.timefn import parse_day
    first = W.earliest_by_key(ledger.where((F.col("site") == site) & (F.to_date("time") >= F.lit(parse_day(since)))),
                              ["site", "breach_id"], "time", tiebreak=["line_no", "credit", "debit"])
    at = local_time("time", tz)
    lo, hi = (F.lit(parse_day(d)).cast("timestamp_ntz") for d in (start, end))
    return first.where(at.between(lo, hi) & (F.col("credit") != 0)).select(
        "breach_id", "line_no", "site", at.alias("updated"), "transaction_type", "description", "credit",
        _clip("credit", cap).alias("amount"))


def reconcile(cases: DataFrame, ledger: DataFrame, sites: DataFrame, tz: str, since, newest_line_only: bool = False,
              late_types: Iterable[str] = ("late",), fee_source: str = "base") -> DataFrame:
    """Closed notices matched with the ledger, both sides by their newest version.

    * notices: fee rows of closed cases whose offence type is not in ``late_types`` and whose source is
      ``fee_source`` (filters before ranking); of these the newest fact per (group, ticket) -- per (organization,
      group name, ticket) for the form with every line -- the highest fee of equal facts;
    * ledger lines (``ticket_id``) from the UTC day ``since`` on: every line (left join), or, with
      ``newest_line_only``, the newest per (site, ticket) -- a ticket with lines on two sites keeps both, one
      without lines goes;
    * only groups that are current sites, with the site's name.
    """
    from kerbside.functions.timefn import parse_day
    from kerbside.plans.dimension import key_parts, with_site
    b = J.explode_drop(cases.where(F.col("state") == "Closed").select("rev", "state", "substate", "organization", "fact_ts", "groups", "breaches"),
                       "breaches", "b")
    f = b.select("*", F.explode("b.fees").alias("f")).where(~F.col("f.type").isin(list(late_types)) & (F.col("f.source") == fee_source))
    f = f.select("rev", "state", "substate", "organization", "fact_ts", F.col("b.ticket_id").alias("ticket_id"), F.col("f.type").alias("offense_type"),
                 F.col("f.amount").alias("fee_amount"), F.col("f.source").alias("fee_source"), F.explode("groups").alias("g")) \
        .select("*", F.col("g.group_ref").alias("group_ref"), F.col("g.name").alias("group_name")).drop("g")
    keys = ["group_ref", "ticket_id"] if newest_line_only else ["organization", "group_name", "ticket_id"]
    pcn = W.latest_by_key(f, keys, "fact_ts", tiebreak=["rev", "fee_amount", "group_ref"][:2 if newest_line_only else 3])
    pcn = stored(with_site(pcn, sites, key_parts("group_ref"), how="inner"), "notices")
    # a line without a ticket has no notice
    lines = ledger.where((F.to_date("time") >= F.lit(parse_day(since))) & F.col("ticket_id").isNotNull())
    # both sides are dealt by ticket once; ranking, join and distinct need no other exchange
    size = pcn.count() + lines.count()
    lines, pcn = (spread(x, size, "ticket_id") for x in (lines.select("site", "ticket_id", "time", "breach_id", "debit"), pcn))
    if newest_line_only:
        lines = W.latest_by_key(lines, ["site", "ticket_id"], "time",
                                tiebreak=["breach_id", "debit"])
    lines = lines.select(F.col("ticket_id").alias("__t"), F.col("time").alias("line_time"), F.coalesce("debit", F.lit(0.0)).alias("debit"))
    j = pcn.join(lines, pcn["ticket_id"] == lines["__t"], "inner" if newest_line_only else "left")
    out = j.select("ticket_id", "offense_type", "fee_amount", "fee_source", local_time("fact_ts", tz).alias("updated"), "state", "substate",
                   "organization", "group_ref", "site_name", "line_time", F.coalesce("debit", F.lit(0.0)).alias("debit"))
    return out.drop("debit").distinct() if newest_line_only else out


def monthly_offence_kpi(cases: DataFrame, sites: DataFrame, start, end, tz: str, paid: Iterable[str] = PAID_SUBSTATES,
                        cancelled: Iterable[str] = CANCELLED_SUBSTATES) -> DataFrame:
    """Notices, paid and cancelled per (parent, site name) and local month of the offence.

    Rows are (breach, site group, offence): the period is on the offence's UTC day, the month on its local
    day; only groups that are current sites count.  Notices and paid are distinct breaches; cancelled counts
    rows, so a breach with two offences counts twice.  The previous month is that of the site *name* (equal
    names under two parents follow each other by parent).
    """
    from kerbside.functions.timefn import day_range
    from kerbside.plans.dimension import key_parts, with_site
    site = F.filter("groups", lambda g: g["type"] == "site")
    b = J.explode_keep(cases.select("state", "substate", "breaches", "offenses", site.alias("sites")), "breaches", "b")
    o = b.select("state", "substate", "sites", F.col("b.ticket_id").alias("ticket"), F.explode("offenses").alias("o")) \
        .select("*", F.col("o.offense_time").alias("off")).where(day_range("off", start, end))
    r = o.select("state", "substate", "ticket", "off", F.explode("sites.group_ref").alias("group_ref"))
    r = with_site(r, sites, key_parts("group_ref"), how="inner") \
        .withColumn("parent", key_part("group_ref", 1))
    done = F.lower("substate").isin(list(paid)) & (F.col("state") == "Closed")
    m = r.groupBy("parent", "site_name", F.date_format(local_time("off", tz), "yyyy-MM").alias("month")).agg(
        F.count_distinct("ticket").alias("notices"), F.count_distinct(F.when(done, F.col("ticket"))).alias("paid"),
        F.count_if(F.col("ticket").isNotNull() & F.col("substate").isin(list(cancelled))).alias("cancelled"))
    return W.with_previous(m, "site_name", "month", ["notices", "paid", "cancelled"], tiebreak="parent", limit=None)


# Sub-states and cancel reasons that keep a case out of the overview.
TEST_SUBSTATES = ("sysops", "unprocessed", "tech-cancel")
TEST_REASONS = ("system admin task", "removed for system testing or maintenance", "cancelled for reload", "case needs to be reloaded")


def stay_frames(visits: DataFrame, zones: DataFrame, start, end, longest: float = 10_000) -> DataFrame:
    """Newest frame per visit with stay, counts, local day, hour and weekday.

    A visit with any deleted revision is out (NOT IN, NULL-aware).  The day is that of the arrival, else of the
    departure, in the organisation's zone; the stay is 0 unless both ends are there, and at most ``longest``
    minutes.
    """
    from kerbside.functions.timefn import elapsed, parse_day
    v = J.anti_null_aware(visits.where(F.col("updated").isNotNull()), visits.where(F.lower("action") == "deleted").select("visit_id"), "visit_id")
    v = W.latest_by_key(v.select("visit_id", "rev_id", "updated", "ors_id", "arrival", "departure"), "visit_id", "updated", tiebreak="rev_id")
    v = v.withColumn("org", key_part("ors_id", 0)).join(zones, "org", "left")
    for c in ("arrival", "departure"):
        v = v.withColumn(c, F.date_trunc("second", local_time(c, F.col("timezone"))).cast("timestamp_ntz"))
    both = F.col("arrival").isNotNull() & F.col("departure").isNotNull()
    at = F.coalesce("arrival", "departure")
    stay = F.when(both, F.round(elapsed("second", "arrival", "departure") / 60, 1)).otherwise(0.0)
    none = F.lit("N/A")
    out = v.select(F.col("visit_id").cast("string").alias("frame_id"), key_part("ors_id", 2).alias("site_id"), none.alias("case_id"), none.alias("breach_id"),
                   none.alias("state"), none.alias("sub_state"), F.when(both, 1).otherwise(0).alias("stay"),
                   F.when(F.col("arrival").isNotNull(), 1).otherwise(0).alias("arrivals"), F.when(F.col("departure").isNotNull(), 1).otherwise(0).alias("departures"),
                   F.to_date(at).alias("day"), stay.alias("stay_minutes"), F.hour(at).alias("hour"))
    return out.where(F.col("day").between(F.lit(parse_day(start)), F.lit(parse_day(end))) & (F.col("stay_minutes") <= longest))


def first_states(cases: DataFrame, heads: DataFrame, start, end, substates=TEST_SUBSTATES, reasons=TEST_REASONS) -> DataFrame:
    """The first revision of each (case, breach, state, sub-state) whose case day, in the case's zone, lies in the
    period, in the columns of :func:`stay_frames`.

    Rows fan out over breaches, sub-states (where the scalar one is NULL) and site groups; cases with an
    excluded sub-state or cancel reason are out (NOT IN, NULL-aware).
    """
    from kerbside.functions.timefn import between_local_days
    c = J.anti_null_aware(cases, excluded_case_ids(heads, substates, reasons), "id")
    subs = F.when(F.col("substate").isNotNull(), F.array("substate")).otherwise(F.col("sub_states"))
    c = c.select("id", "rev", "state", "case_ts", "timezone", subs.alias("subs"), F.filter("groups", lambda g: F.lower(g["type"]) == "site").alias("sites"),
                 F.transform("breaches", lambda b: b["ticket_id"]).alias("tickets"))
    r = c.select("*", F.explode_outer("tickets").alias("ticket")).select("*", F.explode_outer("subs").alias("sub")) \
        .select("*", F.explode("sites.group_ref").alias("ref"))
    # every group of a case is the same on each of its revisions' rows; the ranking is as the report's: without the group
    first = W.earliest_by_key(r.select("id", "ticket", "state", "sub", "rev", "case_ts", "timezone", "ref"), ["id", "ticket", "state", "sub"], "rev", tiebreak="ref")
    first = first.where(between_local_days("case_ts", F.col("timezone"), start, end))
    at, zero = F.date_trunc("second", local_time("case_ts", F.col("timezone"))), F.lit(0)
    return first.select(F.lit("N/A").alias("frame_id"), key_part("ref", 2).alias("site_id"), F.col("id").cast("string").alias("case_id"),
                        F.col("ticket").cast("string").alias("breach_id"), "state", F.col("sub").alias("sub_state"), zero.alias("stay"), zero.alias("arrivals"),
                        zero.alias("departures"), F.to_date(at).alias("day"), F.lit(0.0).alias("stay_minutes"), F.hour(at).alias("hour"))


def stay_case_overview(frames: DataFrame, states: DataFrame, names: DataFrame) -> DataFrame:
    """Frames and case states in one table with weekday and site name; sites without a name are out, equal rows are one."""
    return frames.unionByName(states).withColumn("weekday", F.date_format("day", "EEEE")).distinct() \
        .join(names.withColumnRenamed("group_id", "site_id"), "site_id")
