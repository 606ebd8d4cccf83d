"""Date/time column expressions (all JVM built-ins, codegen friendly).

Conventions: stored times are UTC instants held as ``timestamp_ntz``;
"local" means wall-clock time in an IANA zone given per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def local_time(ts, tz) -> Column:
    """UTC instant → local wall-clock time in zone ``tz`` (column or name).

    NULL zone gives NULL, as the reference's CASE-derived zone does.
    """
    tz = F.lit(tz) if isinstance(tz, str) else tz  # a name is a zone; pass a Column for per-row zones
    return F.convert_timezone(F.lit("UTC"), tz, _c(ts).cast("timestamp_ntz"))


def utc_time(local_ts, tz) -> Column:
    """Local wall-clock → UTC instant (inverse of :func:`local_time`)."""
    tz = F.lit(tz) if isinstance(tz, str) else tz
    return F.convert_timezone(tz, F.lit("UTC"), _c(local_ts).cast("timestamp_ntz"))


def local_date(ts, tz=None) -> Column:
    """Calendar day of an instant: the UTC day without a zone, else local."""
    return F.to_date(_c(ts) if tz is None else local_time(ts, tz))


def parse_day(s: str | _dt.date) -> _dt.date:
    """'yyyymmdd' / 'yyyy-mm-dd' / date → ``datetime.date`` (report parameters)."""
    if isinstance(s, _dt.date):
        return s
    s = s.replace("-", "")
    return _dt.date(int(s[:4]), int(s[4:6]), int(s[6:8]))


def between_local_days(ts, tz, start, end) -> Column:
    """Local day of ``ts`` in [start, end], plus a UTC pre-filter.

    Catalyst cannot push a predicate on ``convert_timezone(..)`` into the
    scan, so a coarse bound on the raw column (±1 day covers every zone
    offset, which is < 24 h) is added; it reaches Parquet as a pushed filter
    and prunes row groups, the exact local test then runs on the survivors.
    """
    s, e = parse_day(start), parse_day(end)
    lo = _dt.datetime.combine(s - _dt.timedelta(days=1), _dt.time())
    hi = _dt.datetime.combine(e + _dt.timedelta(days=2), _dt.time())
    raw = _c(ts)
    coarse = (raw >= F.lit(lo).cast("timestamp_ntz")) & (raw < F.lit(hi).cast("timestamp_ntz"))
    d = local_date(ts, tz)
    return coarse & d.between(F.lit(s), F.lit(e))


def day_range(ts, start, end) -> Column:
    """Half-open UTC day range on a time column: ``start <= ts < end + 1 day``."""
    s, e = parse_day(start), parse_day(end)
    lo = _dt.datetime.combine(s, _dt.time())
    hi = _dt.datetime.combine(e + _dt.timedelta(days=1), _dt.time())
    return (_c(ts) >= F.lit(lo).cast("timestamp_ntz")) & (_c(ts) < F.lit(hi).cast("timestamp_ntz"))


def elapsed(unit: str, start, end) -> Column:
    """Whole ``unit``s elapsed from start to end (TIMESTAMP_DIFF semantics)."""
    return F.expr(f"timestampdiff({unit.upper()}, {_sql(start)}, {_sql(end)})")


def boundaries(unit: str, start, end) -> Column:
    """Unit boundaries crossed from start to end (DATETIME_DIFF semantics).

    00:59 → 01:01 is 1 hour here, 0 with :func:`elapsed`.
    """
    if unit == "day":
        return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))
    t0 = F.date_trunc(unit, _c(start).cast("timestamp_ntz"))
    t1 = F.date_trunc(unit, _c(end).cast("timestamp_ntz"))
    secs = F.unix_timestamp(t1.cast("timestamp")) - F.unix_timestamp(t0.cast("timestamp"))
    return (secs / _UNITS[unit]).cast("bigint")


def _sql(x) -> str:
    if isinstance(x, str):
        return f"`{x}`"
    raise TypeError("elapsed() takes column names")


def week_sunday(d) -> Column:
    """Week number with weeks starting Sunday; days before the first Sunday are week 0."""
    d = _c(d)
    return F.floor((F.dayofyear(d) + 6 - (F.dayofweek(d) - 1)) / 7).cast("int")


def week_monday(d) -> Column:
    """Week number with weeks starting Monday; days before the first Monday are week 0."""
    d = _c(d)
    return F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("int")


def bucket_floor(ts, seconds: int) -> Column:
    """Floor a time to a ``seconds`` grid (15 min = 900), keeping ``timestamp_ntz``."""
    secs = F.unix_seconds(_c(ts).cast("timestamp"))
    return F.timestamp_seconds(F.floor(secs / seconds) * seconds).cast("timestamp_ntz")


def stay_minutes(arrival, departure) -> Column:
    """Stay in minutes to one decimal; 0 when either end is missing."""
    secs = F.unix_seconds(_c(departure).cast("timestamp")) - F.unix_seconds(_c(arrival).cast("timestamp"))
    return F.coalesce(F.round(secs / 60.0, 1), F.lit(0.0))


def add_seconds(ts, secs) -> Column:
    return F.timestampadd("SECOND", _c(secs) if not isinstance(secs, int) else F.lit(secs), _c(ts))


def hhmm(ts) -> Column:
    """TIME formatted as HH:mm (FORMAT_TIME('%H:%M'))."""
    return F.date_format(_c(ts), "HH:mm")
