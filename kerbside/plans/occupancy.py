"""Occupancy reports: slot grids, entry/exit flows, running occupancy,
hourly overlap, sensor status expansion, overnight splits.

Time convention: one explicit zone per call.  Grids are generated in local
wall-clock time and flows are bucketed in local wall-clock time too, so the
grid/flow join never mixes instants with wall times.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.timefn import between_local_days, bucket_floor, local_time, parse_day, utc_time
from kerbside.functions.values import greatest_strict, least_strict
from kerbside.operators.grids import entity_grid


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _ts(x) -> Column:
    return F.lit(x).cast("timestamp_ntz")


def slot_grid(entities: DataFrame, start, end, minutes: int = 15, name: str = "slot", tz=None) -> DataFrame:
    """Every entity x every ``minutes`` wall-clock slot from start 00:00 to end 23:59.

    With ``tz`` (a zone name or a column) only wall times that the zone has on
    those days are kept, as stepping instants and naming them locally gives:
    a 23-hour day has 92 quarter-hours; entities without a zone have none.
    """
    s, e = parse_day(start), parse_day(end)
    lo = dt.datetime.combine(s, dt.time())
    hi = dt.datetime.combine(e, dt.time(23, 59, 59))
    g = entity_grid(entities, _ts(lo), _ts(hi), f"{minutes} minutes", name)
    return g if tz is None else g.where(local_time(utc_time(name, tz), tz) == F.col(name))


def flow_counts(visits: DataFrame, site: str, plate: str, arrival: str, departure: str, tz: str,
                minutes: int = 15) -> DataFrame:
    """Entries and exits per (site, local slot), each counted once per plate.

    Every visit becomes an entry row and (when it has left) an exit row in
    one pass -- ``explode`` of a two-element array -- instead of two scans.
    """
    ev = visits.select(site, plate, F.explode(F.array(
        F.struct(F.lit("entry").alias("dir"), F.col(arrival).alias("t")),
        F.struct(F.lit("exit").alias("dir"), F.col(departure).alias("t")))).alias("e"))
    ev = ev.where(F.col("e.t").isNotNull()).select(
        site, plate, F.col("e.dir").alias("dir"), bucket_floor(local_time(F.col("e.t"), tz), minutes * 60).alias("slot"))
    ev = ev.distinct()
    return ev.groupBy(site, "slot").agg(F.count_if(F.col("dir") == "entry").alias("entries"),
                                        F.count_if(F.col("dir") == "exit").alias("exits"))


def zero_fill(grid: DataFrame, facts: DataFrame, on, cols) -> DataFrame:
    """Grid left-joined to facts; missing measures become 0."""
    out = grid.join(facts, on=list(on), how="left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return out


def opening_balance(visits: DataFrame, site: str, arrival: str, departure: str, tz: str, before_day,
                    minutes: int = 15) -> DataFrame:
    """Entries minus exits with a slot at or before ``before_day`` 23:45 (not per plate)."""
    cutoff = dt.datetime.combine(parse_day(before_day), dt.time(23, 60 - minutes))
    a = bucket_floor(local_time(arrival, tz), minutes * 60)
    d = bucket_floor(local_time(departure, tz), minutes * 60)
    return visits.groupBy(site).agg(
        (F.count_if(a <= _ts(cutoff)) - F.count_if(F.col(departure).isNotNull() & (d <= _ts(cutoff))))
        .alias("opening"))


def running_occupancy(visits: DataFrame, sites: DataFrame, site: str, plate: str, arrival: str, departure: str,
                      tz: str, start, end, reset_daily: bool = False, with_opening: bool = True,
                      minutes: int = 15) -> DataFrame:
    """Zero-filled net flow per slot, accumulated per site (or per site and day).

    Visits are read from the day before ``start`` (local) for the opening
    balance.  The running window is per site: its length is the number of
    slots in the report, independent of the data volume.
    """
    s, e = parse_day(start), parse_day(end)
    base = visits.where(between_local_days(arrival, tz, s - dt.timedelta(days=1), e))
    flows = flow_counts(base, site, plate, arrival, departure, tz, minutes)
    grid = slot_grid(sites, s, e, minutes, tz=tz)
    g = zero_fill(grid, flows, [site, "slot"], ["entries", "exits"])
    g = g.withColumn("net", F.col("entries") - F.col("exits"))
    keys = [site] + ([F.to_date("slot")] if reset_daily else [])
    w = Window.partitionBy(*keys).orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g = g.withColumn("occupancy", F.sum("net").over(w))
    if with_opening and not reset_daily:
        op = opening_balance(base, site, arrival, departure, tz, s - dt.timedelta(days=1), minutes)
        g = g.join(op, site, "left").withColumn("occupancy", F.col("occupancy") + F.coalesce("opening", F.lit(0)))
        g = g.drop("opening")
    return g.drop("net")


def split_by_hour(df: DataFrame, start: str, end: str, keep=()) -> DataFrame:
    """A session → one row per touched hour with the seconds of overlap.

    Hours run from the arrival hour to the departure hour (an exit exactly
    on the hour gives a zero-length last row, as the reference's array
    does).  Overlap = whole seconds from max(start, hour) to
    min(end, hour + 1h); sessions with no end produce no rows.
    """
    s, e = F.col(start), F.col(end)
    hours = F.sequence(F.date_trunc("hour", s), F.date_trunc("hour", e), F.expr("INTERVAL 1 hour"))
    x = df.where(e.isNotNull() & (e >= s)).select(*keep, start, end, F.explode(hours).alias("hour"))
    x = x.withColumn("hour", F.col("hour").cast("timestamp_ntz"))
    nxt = F.col("hour") + F.expr("INTERVAL 1 hour")
    lo = greatest_strict(start, "hour")
    hi = least_strict(end, nxt)
    return x.withColumn("overlap_s", _seconds_between(lo, hi))


def _seconds_between(a: Column, b: Column) -> Column:
    """Whole seconds elapsed from a to b (truncated), like TIMESTAMP_DIFF(..., SECOND)."""
    us = F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))
    return (us / 1000000).cast("bigint")


def hourly_share(split: DataFrame, keys) -> DataFrame:
    """Occupied minutes per hour (uncapped) and occupied share, capped at 1."""
    keys = list(keys)
    return split.groupBy(*keys, "hour").agg(
        (F.sum("overlap_s") / 60.0).alias("occupied_minutes"),
        F.least(F.sum("overlap_s") / 3600.0, F.lit(1.0)).alias("occupied_share"))


def expand_status(status: DataFrame, view: str, last_msg: str, hours: int = 3, max_age_minutes: int = 180,
                  keep=()) -> DataFrame:
    """A status reported every ``hours`` → one row per hour.

    Online (1) when the latest message is at most ``max_age_minutes``
    before the view time (boundary minutes); the flag is copied to each of
    the ``hours`` rows.
    """
    age = (F.unix_seconds(F.date_trunc("minute", F.col(view)).cast("timestamp"))
           - F.unix_seconds(F.date_trunc("minute", F.col(last_msg)).cast("timestamp"))) / 60
    online = F.when(F.col(last_msg).isNotNull() & (age <= max_age_minutes), 1).otherwise(0)
    base = status.select(*keep, F.date_trunc("hour", view).cast("timestamp_ntz").alias("__h"), online.alias("online"))
    return base.select(*keep, F.explode(F.sequence(F.lit(0), F.lit(hours - 1))).alias("__i"), "__h", "online") \
               .select(*keep, F.expr("timestampadd(HOUR, __i, __h)").alias("hour"), "online")


def split_overnight(df: DataFrame, start: str, end: str, tz: str, keep=()) -> DataFrame:
    """A visit → its entry row and, when it ends on another local day, an exit row.

    The entry row stands on the local arrival day and carries the exit hour
    and slot only when the visit ends that day (NULL for open visits too);
    the exit row stands on the local departure day, however many midnights
    later, without entry values.  Hours are local, 15-minute slots are UTC.
    """
    a, d = local_time(start, tz), local_time(end, tz)
    same = F.to_date(a) == F.to_date(d)

    def row(part: str, day: Column, entry: bool, out: Column) -> Column:
        hour = lambda c: F.date_trunc("hour", c).cast("timestamp_ntz")
        none = F.lit(None).cast("timestamp_ntz")
        return F.struct(F.lit(part).alias("part"), day.alias("day"),
                        (hour(a) if entry else none).alias("entry_hour"),
                        (bucket_floor(start, 900) if entry else none).alias("entry_slot"),
                        F.when(out, hour(d)).alias("exit_hour"), F.when(out, bucket_floor(end, 900)).alias("exit_slot"))

    first = row("entry", F.to_date(a), True, same)
    last = row("exit", F.to_date(d), False, F.lit(True))
    return df.select(*keep, F.explode(F.when(~same, F.array(first, last)).otherwise(F.array(first))).alias("p")) \
             .select(*keep, "p.*")
