"""Visit reports: clean visits, repeat visitors, visit fact, cut-over, periods."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.timefn import elapsed, local_time, parse_day, stay_minutes
from kerbside.functions.values import blank_to_null, key_part
from kerbside.operators import joins as J
from kerbside.operators import windows as W

FAR_FUTURE = dt.datetime(9999, 12, 31)


def latest_visits(visits: DataFrame, keep_deleted: bool = False, earliest: bool = False) -> DataFrame:
    """One row per visit id: newest revision by update time (oldest with ``earliest``).

    ``keep_deleted=False`` drops revisions whose action is 'deleted' *before*
    ranking, as the visit-fact build does.
    """
    v = visits if keep_deleted else visits.where(F.col("action") != "deleted")
    if earliest:
        return W.earliest_by_key(v, "visit_id", "updated", tiebreak="rev_id")
    return W.latest_by_key(v, "visit_id", "updated", tiebreak="rev_id")


def with_stay(df: DataFrame, arrival: str = "arrival", departure: str = "departure",
              name: str = "stay_minutes", cap: float | None = None) -> DataFrame:
    """Stay in minutes (1 decimal, 0 when an end is missing); drop stays above ``cap``."""
    out = df.withColumn(name, stay_minutes(arrival, departure))
    return out.where(F.col(name) <= cap) if cap is not None else out


def repeat_visitors(visits: DataFrame, keys, plate: str, ts: str, start, end,
                    within: dt.timedelta = dt.timedelta(days=30), lookback: dt.timedelta | None = None,
                    tiebreak: str | None = None, by_day: bool = True) -> DataFrame:
    """Recency rank per (keys, plate) in [start, end]; +1 if the previous visit was recent.

    * previous visit: ``LAG(ts)`` per (plate, keys) over the report range
      widened by ``lookback`` (the reference loads one extra month so the
      lag has history), then trimmed to the range;
    * ``entry_count`` = recency rank (newest = 1), plus one when the
      previous visit is within ``within`` (compared on dates when
      ``by_day``, as DATE(prev) >= DATE(ts) - n days);
    * ``repeat_status`` = 'repeated' when entry_count > 1, else 'not'.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    s, e = parse_day(start), parse_day(end)
    lo = dt.datetime.combine(s, dt.time()) - (lookback or dt.timedelta(0))
    hi = dt.datetime.combine(e + dt.timedelta(days=1), dt.time())
    v = visits.where((F.col(ts) >= F.lit(lo).cast("timestamp_ntz")) & (F.col(ts) < F.lit(hi).cast("timestamp_ntz")))
    # same key order as the rank below, so both windows partition alike
    v = W.with_previous(v, keys + [plate], ts, [ts], prefix="prev_", tiebreak=tiebreak)
    v = v.where(F.col(ts) >= F.lit(dt.datetime.combine(s, dt.time())).cast("timestamp_ntz"))
    v = W.rank_rows(v, keys + [plate], [ts] + ([tiebreak] if tiebreak else []), name="rn")
    prev = F.col("prev_" + ts)
    if by_day:
        recent = F.to_date(prev) >= F.date_sub(F.to_date(ts), within.days)
    else:
        recent = prev >= F.col(ts) - F.make_dt_interval(secs=F.lit(within.total_seconds()))
    cnt = F.when(recent, F.col("rn") + 1).otherwise(F.col("rn"))
    return (v.withColumn("entry_count", cnt)
             .withColumn("repeat_status", F.when(F.col("entry_count") > 1, "repeated").otherwise("not")))


def vehicle_profile(visits: DataFrame, attrs: Mapping[str, tuple[str, str]], required, sites: DataFrame, start, end, tz: str,
                    keys=("ors_id", "in_plate", "out_plate")) -> DataFrame:
    """Newest visit per (site, plate in, plate out) that arrived on a UTC day in [start, end], with plate, local
    update time, vehicle attributes, stay and site name.

    Each attribute is the in-value, else the out-value, blanks as NULL (numbers as they are).  Only the
    ``required`` ones must be there: a vehicle without a colour stays, one without a model, make or fuel goes.
    The period stands before the ranking and the test after it, so a vehicle whose newest visit lacks a required
    attribute is dropped.  Equal rows are one.
    """
    from kerbside.functions.timefn import day_range, stay_minutes
    from kerbside.plans.dimension import key_parts, with_site
    types = dict(visits.dtypes)
    value = lambda c: blank_to_null(c) if types[c] == "string" else F.col(c)
    latest = W.latest_by_key(visits.where(day_range("arrival", start, end)), list(keys), "updated", tiebreak="rev_id")
    cols = [F.coalesce(value(i), value(o)).alias(n) for n, (i, o) in attrs.items()]
    out = latest.select("ors_id", F.coalesce(blank_to_null("in_plate"), blank_to_null("out_plate")).alias("plate_no"),
                        local_time("updated", tz).alias("update_time"), *cols, stay_minutes("arrival", "departure").alias("stay_minutes")).distinct()
    for n in required:
        out = out.where(F.col(n).isNotNull())
    return with_site(out, sites, key_parts("ors_id"))


def normalise_permits(permits: DataFrame) -> DataFrame:
    """Validity in whole seconds and a hash key of org, region, site and plate.

    Start = the response when it is later than the start (a NULL response
    leaves the start); open ends and ends in 2099 become 9999-12-31.  The key
    is NULL when one of its parts is, as ``CONCAT`` gives.
    """
    start, resp, end = (F.date_trunc("second", c).cast("timestamp_ntz") for c in ("start_time", "response_time", "end_time"))
    far = F.lit(FAR_FUTURE).cast("timestamp_ntz")
    return permits.select(
        "*",
        F.when(start < resp, resp).otherwise(start).alias("valid_from"),
        F.when(F.col("end_time").isNull() | (F.year("end_time") == 2099), far).otherwise(end).alias("valid_to"),
        F.sha2(F.concat("org", "region", "site", "plate"), 256).alias("permit_hash"))


def build_visit_fact(visits: DataFrame, permits: DataFrame, sites_tz: DataFrame, since=None, day: str | None = None) -> DataFrame:
    """De-duplicated visits (earliest update), whitelist flag, local times.

    ``since`` bounds the arrival *before* the earliest revision is picked, so
    it reaches the scan.  ``is_whitelisted``: some normalised permit of the
    same org#region#site and plate contains the entry time -- a left-semi
    join, so no (visit, permit) pairs are produced.  Stay minutes are the
    difference of the local wall-clock times, NULL for an open visit.
    ``sites_tz`` maps ``org`` → ``timezone``.  ``day`` names one more column,
    the UTC day of the arrival.
    """
    if since is not None:
        visits = visits.where(F.col("arrival") >= F.lit(since).cast("timestamp_ntz"))
    v = latest_visits(visits, earliest=True)
    v = v.select("visit_id", F.coalesce("in_plate", "out_plate").alias("plate"), "ors_id",
                 F.date_trunc("second", "arrival").cast("timestamp_ntz").alias("arrival"),
                 F.date_trunc("second", "departure").cast("timestamp_ntz").alias("departure"))
    p = normalise_permits(permits).select(F.concat("org", F.lit("#"), "region", F.lit("#"), "site").alias("ors_id"), "plate",
                                          "valid_from", "valid_to")
    inside = ((v.ors_id == p.ors_id) & (v.plate == p.plate) & v.arrival.between(p.valid_from, p.valid_to))
    hits = v.join(p, inside, "left_semi").select(F.col("visit_id").alias("__hit"), F.lit(True).alias("is_whitelisted"))
    out = v.join(hits, F.col("visit_id").eqNullSafe(F.col("__hit")), "left").drop("__hit")
    out = out.withColumn("is_whitelisted", F.coalesce("is_whitelisted", F.lit(False)))
    out = out.withColumn("org", key_part("ors_id", 0)).join(sites_tz, "org", "left")
    tz = F.col("timezone")
    out = out.select("visit_id", "plate", "org", key_part("ors_id", 2).alias("site"), "timezone",
                     local_time("arrival", tz).alias("entry_time"), local_time("departure", tz).alias("exit_time"),
                     "is_whitelisted", *([F.to_date("arrival").alias(day)] if day else []))
    return out.withColumn("stay_minutes", F.round(elapsed("second", "entry_time", "exit_time") / 60, 1))


def visit_fact_with_sites(visits: DataFrame, permits: DataFrame, sites: DataFrame, attrs: Mapping[str, tuple[str, str]], since=None) -> DataFrame:
    """The visit fact with site name and zone, vehicle attributes and local update time, one row per distinct visit.

    ``sites`` is the site dimension with zones, joined on organisation and group: a site of two parents gives
    two rows, a visit without a site keeps NULLs (its local times, too, as the zone comes from the site).
    ``attrs`` maps each output name to (in-column, out-column); a blank is a value.  Visits that agree in site,
    plate, attributes and times are one whatever their ids, as the script's DISTINCT runs without the id.
    """
    if since is not None:
        visits = visits.where(F.col("arrival") >= F.lit(since).cast("timestamp_ntz"))
    second = lambda c: F.date_trunc("second", c).cast("timestamp_ntz").alias(c)
    v = latest_visits(visits, earliest=True).select(
        "ors_id", F.coalesce("in_plate", "out_plate").alias("plate"), *[F.coalesce(i, o).alias(n) for n, (i, o) in attrs.items()],
        second("arrival"), second("departure"), second("updated")).distinct()
    p = normalise_permits(permits).select(F.concat("org", F.lit("#"), "region", F.lit("#"), "site").alias("ors_id"), "plate",
                                          "valid_from", "valid_to")
    # the flag is a property of (site, plate, arrival), so only these travel to the permits and back
    entry = ["ors_id", "plate", "arrival"]
    e = v.select(*entry).where(F.col("ors_id").isNotNull() & F.col("plate").isNotNull()).distinct()
    hits = e.join(p, (e.ors_id == p.ors_id) & (e.plate == p.plate) & e.arrival.between(p.valid_from, p.valid_to), "left_semi")
    v = v.join(hits.withColumn("__hit", F.lit(True)), entry, "left")
    s = sites.select("organization", "parent", "group_id", F.col("name").alias("site_name"), "timezone")
    v = v.withColumn("organization", key_part("ors_id", 0)).withColumn("group_id", key_part("ors_id", 2)).join(s, ["organization", "group_id"], "left")
    local = lambda c: local_time(c, F.col("timezone"))
    on_site = lambda c: F.when(F.col("site_name").isNotNull() | F.col("parent").isNotNull(), F.col(c)).alias(c)
    out = v.select(on_site("organization"), "parent", on_site("group_id"), "site_name", "timezone", "plate", *attrs, local("arrival").alias("entry_time"),
                   local("departure").alias("exit_time"), local("updated").alias("update_time"), F.lit(1).alias("visits"),
                   F.coalesce("__hit", F.lit(False)).alias("is_whitelisted"))
    return out.withColumn("stay_minutes", F.round(elapsed("second", "entry_time", "exit_time") / 60, 1))


def hourly_visits(visits: DataFrame, sites: DataFrame, start, end, names=None) -> DataFrame:
    """Visits that arrive on a local day in [start, end], each with its site, bay count, entry hour and whether it
    counts as in and as out of that hour.

    ``sites`` is the site dimension with zones and ``bays``, joined on organisation and group (inner); ``names``
    keeps only sites of these names.  The newest revision *of those in the period* counts.  ``stay_clock`` is the
    stay in whole minutes as a clock time on the first day of the period.  A visit counts as out in its entry
    hour only, and one without a plate on that side never.
    """
    from kerbside.functions.timefn import between_local_days
    s = sites.select("organization", "group_id", F.col("name").alias("site_name"), "bays", "timezone").distinct()
    if names is not None:
        s = s.where(F.col("site_name").isin(list(names)))
    # the coarse bound on the stored column reaches the scan, the exact test follows the join
    d0, d1 = (dt.datetime.combine(parse_day(x), dt.time()) for x in (start, end))
    bound = lambda x: F.lit(x).cast("timestamp_ntz")
    v = visits.where((F.col("arrival") >= bound(d0 - dt.timedelta(days=1))) & (F.col("arrival") < bound(d1 + dt.timedelta(days=2))))
    v = v.withColumn("organization", key_part("ors_id", 0)).withColumn("group_id", key_part("ors_id", 2)).join(s, ["organization", "group_id"])
    v = v.where(between_local_days("arrival", F.col("timezone"), start, end))
    v = W.latest_by_key(v, ["visit_id", "organization", "group_id", "site_name", "bays"], "updated", tiebreak="rev_id")
    local = lambda c: local_time(c, F.col("timezone"))
    v = v.select("organization", "group_id", "site_name", "bays", "in_plate", "out_plate", local("arrival").alias("arrival"),
                 local("departure").alias("departure"), "updated")
    hour = lambda c: F.date_trunc("hour", c).cast("timestamp_ntz")
    stay = F.floor(elapsed("second", "arrival", "departure") / 60)
    same = F.coalesce(hour("departure") == hour("arrival"), F.lit(False))
    return v.select(
        "*", hour("arrival").alias("hour"), (bound(d0) + F.make_dt_interval(mins=stay.cast("int"))).alias("stay_clock"),
        F.col("in_plate").isNotNull().cast("long").alias("vehicles_in"),
        (same & F.col("out_plate").isNotNull()).cast("long").alias("vehicles_out")).distinct()


def refresh_visit_fact(path: str, visits: DataFrame, added: DataFrame, permits: DataFrame, sites_tz: DataFrame, since=None) -> list[str]:
    """Bring the visit fact kept by day at ``path`` up to date after the revisions ``added`` (part of ``visits``):
    only days that they touch are rebuilt, from all revisions of the visits that have one on such a day.
    Returns the days rebuilt."""
    from kerbside.sources import versions as V
    spark = visits.sparkSession
    day = F.to_date("arrival")
    if since is not None:
        added = added.where(F.col("arrival") >= F.lit(since).cast("timestamp_ntz"))
    days = V.touched_days(visits, added, V.read_current(spark, path), "visit_id", day, "day")
    if not days:
        return []
    near = visits.where(day.isin(days)).select("visit_id").distinct()
    fact = build_visit_fact(visits.join(near, "visit_id", "left_semi"), permits, sites_tz, since=since, day="day")
    return V.publish_days(fact, path, "day", days)


def cutover_union(old: DataFrame, new: DataFrame, dates: DataFrame, key: str, day: str,
                  date_col: str = "transition_date") -> DataFrame:
    """Old source before each site's cut-over date, new source from it on.

    Sites without a date are dropped (the reference's CASE has no ELSE).
    The dates table (one row per site) is joined to both branches; the
    branches are aligned by name.
    """
    o = old.join(dates, key).where(F.col(day) < F.col(date_col)).withColumn("source", F.lit("old"))
    n = new.join(dates, key).where(F.col(day) >= F.col(date_col)).withColumn("source", F.lit("new"))
    return o.unionByName(n, allowMissingColumns=True)


def label_periods(df: DataFrame, day: str, periods: Mapping[str, tuple[dt.date, dt.date]],
                  name: str = "period") -> DataFrame:
    """One scan, one row per (row, period whose [start, end] holds the row's day).

    Replaces one scan of the fact per period: the period label then joins
    every window/aggregate key.  Ranges may overlap; a row can carry
    several labels.
    """
    labels = None
    for label, (s, e) in periods.items():
        hit = F.when(F.col(day).between(F.lit(s), F.lit(e)), F.lit(label))
        labels = F.array(hit) if labels is None else F.array_union(labels, F.array(hit))
    bounds_lo = min(s for s, _ in periods.values())
    bounds_hi = max(e for _, e in periods.values())
    pre = df.where(F.col(day).between(F.lit(bounds_lo), F.lit(bounds_hi)))
    return (pre.select("*", F.explode(labels).alias(name)).where(F.col(name).isNotNull()))


def period_report(fact: DataFrame, day: str, ts: str, periods: Mapping[str, tuple[dt.date, dt.date]],
                  site: str, vehicle: str, tiebreak: str, rank_scope: str = "period") -> DataFrame:
    """Visits, vehicles and repeat visits per (period, site) from one scan of the fact.

    ``rank_scope='period'`` ranks a vehicle's visits inside each period's
    base range (the label joins the window key); ``'history'`` ranks over
    the whole fact first and then labels, so a visit is a repeat if the
    vehicle came to the site before, in or out of the period.  Ranks are
    bounded windows (skew-safe).
    """
    if rank_scope == "history":
        ranked = W.rank_rows(fact, [site, vehicle], [ts, tiebreak])
        lab = label_periods(ranked, day, periods)
    else:
        lab = label_periods(fact, day, periods)
        lab = W.rank_rows(lab, ["period", site, vehicle], [ts, tiebreak])
    return lab.groupBy("period", site).agg(F.count(F.lit(1)).alias("visits"),
                                           F.count_distinct(vehicle).alias("vehicles"),
                                           F.count_if(F.col("rn") > 1).alias("repeat_visits"))


def period_visits(fact: DataFrame, day: str, ts: str, periods: Mapping[str, tuple[dt.date, dt.date]], site: str, vehicle: str,
                  tiebreak: str, within_days: int = 30) -> DataFrame:
    """Every visit of the periods with the vehicle's visit to the site before it and its entry count.

    Both look inside the period: the visit before is per (vehicle, site); the count is the visit's rank per
    vehicle, newest first over all sites, plus one if the visit before lies within ``within_days`` days.
    """
    lab = label_periods(fact, day, periods)
    lab = W.with_previous(lab, ["period", vehicle, site], ts, [ts], tiebreak=tiebreak)
    lab = W.rank_rows(lab, ["period", vehicle], [ts, tiebreak])
    prev = F.col("prev_" + ts)
    recent = F.coalesce(F.to_date(prev) >= F.date_sub(F.to_date(ts), within_days), F.lit(False))
    return lab.withColumn("entry_count", F.col("rn") + F.when(recent, 1).otherwise(0)).drop("rn")


def month_periods(month: dt.date) -> dict[str, tuple[dt.date, dt.date]]:
    """Current month, previous month, same month last year."""
    first = month.replace(day=1)

    def last_day(d: dt.date) -> dt.date:
        nxt = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        return nxt - dt.timedelta(days=1)

    prev = (first - dt.timedelta(days=1)).replace(day=1)
    ly = first.replace(year=first.year - 1)
    return {"current": (first, last_day(first)), "previous": (prev, last_day(prev)), "last_year": (ly, last_day(ly))}


def week_totals(df: DataFrame, key: str, day: Column | str, today: dt.date) -> DataFrame:
    """Visits in the week of ``today`` and the week before, per ``key`` (Sunday weeks)."""
    from kerbside.functions.timefn import week_sunday
    d = F.col(day) if isinstance(day, str) else day
    t = F.lit(today)
    cur = (week_sunday(d) == week_sunday(t)) & (F.year(d) == F.year(t))
    prv_t = F.date_sub(t, 7)
    prev = (week_sunday(d) == week_sunday(prv_t)) & (F.year(d) == F.year(prv_t))
    return df.groupBy(key).agg(F.sum(F.when(cur, 1).otherwise(0)).alias("current_week_visits"),
                               F.sum(F.when(prev, 1).otherwise(0)).alias("previous_week_visits"))
