"""Case backlog reports: status transitions, daily opened/closed, balances."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.timefn import local_date
from kerbside.functions.values import json_raw, json_text
from kerbside.operators import windows as W


def status_transitions(df: DataFrame, key: str, ts: str, status: str, day: str,
                       counted: Mapping[str, str], tiebreak=None) -> DataFrame:
    """Per day, how many items moved *into* each counted status.

    A row counts when its status is the target and the previous status of
    the same item (by time) is different, NULL-safe -- so an item's first
    event counts.  ``counted`` maps output column → status value.
    """
    lagged = W.with_previous(df, key, ts, [status], prefix="prev_", tiebreak=tiebreak)
    prev = F.col("prev_" + status)
    aggs = [F.sum(F.when((F.col(status) == v) & ~prev.eqNullSafe(F.lit(v)), 1).otherwise(0)).alias(name)
            for name, v in counted.items()]
    return lagged.groupBy(day).agg(*aggs)


def backlog(events: DataFrame, key: str, ts: str, status: str, day: str, opened: str, resolved: str,
            start=None, end=None, tiebreak=None) -> DataFrame:
    """Daily items moved into ``opened`` / ``resolved`` and the running unresolved balance.

    Transitions are found over the whole history (so the balance carries
    everything before ``start``); the balance is a running sum over the
    daily table -- one row per day, so a single small window -- and only
    then are the report days kept.  (A split running sum would read the
    event history twice to save sorting a few thousand day rows.)
    """
    from kerbside.functions.timefn import parse_day
    t = status_transitions(events, key, ts, status, day, {"opened": opened, "resolved": resolved},
                           tiebreak=tiebreak)
    t = t.withColumn("net", F.col("opened") - F.col("resolved"))
    r = W.running_total(t, day, "net", name="backlog")
    if start is not None:
        r = r.where(F.col(day).between(F.lit(parse_day(start)), F.lit(parse_day(end))))
    return r.drop("net")


def resolution_times(events: DataFrame, key: str, ts: str, status: str, author: str, tiebreak=None) -> DataFrame:
    """Each status change with the next one: status, author, time, days/hours to it, first resolver.

    One window spec (key, ts) serves every LEAD; the first non-NULL next
    author from the current row on is the first resolver.
    """
    from kerbside.functions.timefn import boundaries
    n = W.with_next(events.withColumn("__t", F.col(ts)), key, ts, [status, author, "__t"], tiebreak=tiebreak)
    n = n.withColumnRenamed("next___t", "next_ts").drop("__t")
    n = W.first_non_null_after(n, key, [ts] + ([tiebreak] if tiebreak else []), "next_" + author, "first_resolver")
    return n.select("*", boundaries("day", ts, "next_ts").alias("days_to_next"),
                    boundaries("hour", ts, "next_ts").alias("hours_to_next"))


def resolution_pairs(times: DataFrame, status: str, author: str, opened: str, resolved: str) -> DataFrame:
    """The rows of :func:`resolution_times` that move between ``opened`` and ``resolved``.

    ``final_author``: the first resolver for a row in ``opened``, else the row's own author.
    """
    now, nxt = F.col(status), F.col("next_" + status)
    pair = ((now == opened) & (nxt == resolved)) | ((now == resolved) & (nxt == opened))
    return times.where(pair).withColumn("final_author", F.when(now == opened, F.col("first_resolver")).otherwise(F.col(author)))


def first_transitions(df: DataFrame, key: str, label: str, ts: str, tiebreak=None) -> DataFrame:
    """First time each item reached each label (an item can count once per label)."""
    return W.earliest_by_key(df, [key, label], ts, tiebreak=tiebreak)


def mail_transitions(actions: DataFrame, key: str, ts: str, data: str, user: str, tz: str, tiebreak=None) -> DataFrame:
    """First move of each item into Unresolved and into Resolved, with day and user.

    Only actions that carry mail labels count.  Unresolved set is
    'Unresolved' (whatever Resolved says); Resolved set with Unresolved
    cleared is 'Resolved'; other label sets are left out.  Days are local in ``tz``.
    """
    yes, no = (json_text(data, f"$.mailUpdate.labels.{n}") for n in ("Resolved", "Unresolved"))
    kind = F.when(no == "true", "Unresolved").when((yes == "true") & (no == "false"), "Resolved")
    c = actions.where(json_raw(data, "$.mailUpdate.labels").isNotNull()).select(
        key, ts, *([tiebreak] if tiebreak else []), local_date(ts, tz).alias("day"),
        json_text(user, "$.name").alias("user_name"), kind.alias("transition_type")).where("transition_type IS NOT NULL")
    f = first_transitions(c, key, "transition_type", ts, tiebreak=tiebreak)
    hit = lambda v: F.when(F.col("transition_type") == v, 1).otherwise(0)
    return f.select("day", key, "user_name", "transition_type", hit("Unresolved").alias("unresolved_count"),
                    hit("Resolved").alias("resolved_count"))


def daily_status_counts(events: DataFrame, key: str, day: str, status: str, author: str | None = None) -> DataFrame:
    """Distinct items per (day, status), with the distinct authors of that day and status."""
    aggs = [F.count_distinct(key).alias("items")]
    if author:
        aggs.append(F.collect_set(author).alias("authors"))
    return events.groupBy(day, status).agg(*aggs)


def distinct_backlog(events: DataFrame, key: str, day: str, status: str, opened: str, resolved: str,
                     start, end, author: str | None = None, opening_from=None) -> DataFrame:
    """Daily distinct items per status and the running unresolved balance.

    * without ``opening_from``: the balance runs over the report days only
      (days before ``start`` do not count -- the filter runs before the
      running sum, as in the distinct-per-day report);
    * with ``opening_from``: the balance at the last day before ``start``,
      accumulated from ``opening_from`` on, is added (the opening-balance
      report): the running sum simply starts at ``opening_from`` and the
      earlier days are dropped afterwards.
    The daily table is built once, from one pass over the events; the
    running sum is one small window over its rows (one per day).  The
    author lists of a day's statuses are concatenated, so a name can repeat.
    """
    from kerbside.functions.timefn import parse_day
    s, e = parse_day(start), parse_day(end)
    first = parse_day(opening_from) if opening_from is not None else s
    d = daily_status_counts(events.where(F.col(day).between(F.lit(first), F.lit(e))), key, day, status, author)
    per_day = d.groupBy(day).agg(
        F.sum(F.when(F.col(status) == opened, F.col("items")).otherwise(0)).alias("opened"),
        F.sum(F.when(F.col(status) == resolved, F.col("items")).otherwise(0)).alias("resolved"),
        *([F.flatten(F.collect_list("authors")).alias("authors")] if author else []))
    per_day = per_day.withColumn("net", F.col("opened") - F.col("resolved"))
    out = W.running_total(per_day, day, "net", name="backlog")
    return out.where(F.col(day).between(F.lit(s), F.lit(e))).drop("net")
