"""Ranking, previous/next-row and running-total operators.

Scale notes.  A window ``PARTITION BY k`` sends every row of a key to one
task, so a key holding a third of the rows becomes a third of the job in a
single task.  The operators here therefore prefer:

* aggregate forms (``max(struct(...))`` / ``max`` + join back) for
  newest/oldest row per key -- these combine map-side, so a hot key costs
  one row per input partition in the shuffle;
* *bounded* windows for rank / lag / lead / first value (``ranges.py``): the
  plain window for keys of up to ``limit`` rows, and for heavier keys ranges
  of (key, order) with one summary row each, scanned over the key's ranges.
  Exact, and no task holds more than about ``limit`` rows of a key;
* ``bucket`` forms, a fixed calendar or number slice in place of ranges, for
  running totals over daily tables and for callers that know that a slice of
  one key is small.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators import ranges as R

_FIRST_DAY = _dt.date(1, 1, 1)


def join_on(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """Equi-join on same-named keys where NULL matches NULL (window semantics).

    Keeps the left key columns only.  Null-safe equality is still a hashable
    equi-join for Spark (sort-merge / broadcast hash).
    """
    keys = list(keys)
    if not keys:
        raise ValueError("join_on needs at least one key")
    r = right.select(*[F.col(k).alias("__rk_" + k) for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r["__rk_" + k]) for k in keys]
    return left.join(r, cond, how).drop(*["__rk_" + k for k in keys])


def _cols(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _order(order, ascending: bool):
    out = []
    for o in _cols(order):
        c = F.col(o) if isinstance(o, str) else o
        out.append(c.asc() if ascending else c.desc())
    return out


def _split(df: DataFrame, keys, bucket: Column) -> tuple[DataFrame, list[str]]:
    """Add NULL-free partition columns for (keys, bucket).

    Each key becomes (text value, is-NULL flag), so NULL keys form their own
    group as in a window, yet every later join is a plain equi-join on the
    very columns the rows are already partitioned by (no re-shuffle of the
    big side).  The bucket is a date or a number; a NULL bucket (NULL
    ordering value) becomes the lowest value of its type, which sorts first
    ascending and last descending -- the same places ``ORDER BY`` gives NULLs.
    """
    exprs, names = [], []
    for i, k in enumerate(keys):
        c = F.col(k) if isinstance(k, str) else k
        exprs += [F.coalesce(c.cast("string"), F.lit("")).alias(f"__kv{i}"), c.isNull().alias(f"__kn{i}")]
        names += [f"__kv{i}", f"__kn{i}"]
    btype = df.select(bucket.alias("__t")).schema["__t"].dataType.simpleString()
    if btype in ("tinyint", "smallint", "int", "bigint"):
        low = F.lit(-(2 ** 63)).cast("bigint")
        b = F.coalesce(bucket.cast("bigint"), low)
    elif btype in ("float", "double"):
        b = F.coalesce(bucket.cast("double"), F.lit(float("-inf")))
    else:
        b = F.coalesce(bucket.cast("date"), F.lit(_FIRST_DAY.isoformat().rjust(10, "0")).cast("date"))
    return df.select("*", *exprs, b.alias("__b")), names


# ---------------------------------------------------------------- newest row

def latest_by_key(df: DataFrame, keys, order, tiebreak=None, ascending: bool = False,
                  where_before: Column | None = None) -> DataFrame:
    """One row per key: the newest by ``order`` (oldest with ``ascending``).

    ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order DESC) = 1``,
    computed as a grouped ``max``/``min`` of a struct led by the ordering
    columns, so partial aggregation collapses each key map-side before the
    shuffle (skew-safe).  ``tiebreak`` columns make the choice total.
    ``where_before`` filters rows *before* ranking (some reports rank first
    and filter after: filter the result instead).  NULL order values rank
    last for newest and first for oldest, as in ``ORDER BY``.
    """
    keys = _cols(keys)
    order = _cols(order) + _cols(tiebreak)
    if where_before is not None:
        df = df.where(where_before)
    names = [c for c in df.columns if c not in keys]
    # ordering fields lead the struct; plain column names are not repeated
    lead, seen = [], set()
    for i, o in enumerate(order):
        if isinstance(o, str) and o in names and o not in seen:
            lead.append(F.col(o).alias(o))
            seen.add(o)
        else:
            lead.append((F.col(o) if isinstance(o, str) else o).alias(f"__o{i}"))
    packed = F.struct(*lead, *[F.col(c).alias(c) for c in names if c not in seen])
    agg = F.min(packed) if ascending else F.max(packed)
    out = df.groupBy(*keys).agg(agg.alias("__r"))
    return out.select(*keys, *[F.col("__r")[c].alias(c) for c in names]).select(*df.columns)


def earliest_by_key(df: DataFrame, keys, order, tiebreak=None, where_before=None) -> DataFrame:
    """Oldest row per key (``ROW_NUMBER() ... ORDER BY order ASC = 1``)."""
    return latest_by_key(df, keys, order, tiebreak, ascending=True, where_before=where_before)


def rank_rows(df: DataFrame, keys, order, name: str = "rn", ascending: bool = False,
              tiebreak=None, bucket: Column | None = None, limit: int | None = R.LIMIT) -> DataFrame:
    """``ROW_NUMBER()`` beside each row (the rank itself is wanted).

    ``order`` columns sort ascending or descending; ``tiebreak`` columns
    always ascending.  Keys of more than ``limit`` rows are ranked by ranges:
    the number inside the range plus the rows of the key's ranges before it
    (``limit=None``: one window per key).  With ``bucket`` (a date, monotone in the first
    ordering column) the rank is split: row_number inside (keys, bucket)
    plus the number of the key's rows in buckets that sort before it -- a
    per-bucket count, prefix-summed per key over buckets.
    """
    keys = _cols(keys)
    spec = [*_order(order, ascending), *_order(tiebreak, True)]
    if bucket is None:
        def plain(d: DataFrame) -> DataFrame:
            return d.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*spec)).cast("bigint"))

        def split(d: DataFrame, names: list[str]) -> DataFrame:
            r = R.Ranges(d, names, spec)
            inner = d.withColumn("__in", F.row_number().over(r.inside))
            before = r.over.rowsBetween(Window.unboundedPreceding, -1)
            offs = r.summary(F.count(F.lit(1)).alias("__n")) \
                .select("__p", *names, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
            return r.joined(inner, offs).select(*df.columns, (F.col("__in") + F.col("__off")).alias(name))

        return R.bounded(df, keys, spec, plain, split, limit)
    b, kc = _split(df, keys, bucket)
    inner = b.withColumn("__in", F.row_number().over(Window.partitionBy(*kc, "__b").orderBy(*spec)))
    cnt = b.groupBy(*kc, "__b").agg(F.count(F.lit(1)).alias("__n"))
    wk = (Window.partitionBy(*kc).orderBy(F.col("__b").asc() if ascending else F.col("__b").desc())
          .rowsBetween(Window.unboundedPreceding, -1))
    offs = cnt.select(*kc, "__b", F.coalesce(F.sum("__n").over(wk), F.lit(0)).alias("__off"))
    out = inner.join(offs, kc + ["__b"], "left")
    return out.select(*df.columns, (F.col("__in") + F.col("__off")).cast("bigint").alias(name))


def latest_ties(df: DataFrame, keys, ts: str, inner: Column | None = None,
                source: DataFrame | None = None) -> DataFrame:
    """Rows whose (key, ts) equals the key's max ts in a filtered copy; ties kept.

    ``WHERE (k, ts) IN (SELECT k, MAX(ts) FROM t WHERE inner GROUP BY k)``:
    the outer rows are *not* filtered by ``inner``.  Computed as a grouped
    max (map-side combined) joined back on (keys, ts); the max side has one
    row per key, so AQE can broadcast it or split a hot key on the big side.
    ``source`` is a cheaper relation with the same keys and ``ts`` to take
    the max from (e.g. the documents without their nested arrays).
    """
    keys = _cols(keys)
    base = df if source is None else source
    src = base if inner is None else base.where(inner)
    mx = src.groupBy(*keys).agg(F.max(ts).alias(ts)).where(F.col(ts).isNotNull())
    for k in keys:
        mx = mx.where(F.col(k).isNotNull())
    return df.join(mx, on=keys + [ts], how="left_semi")


def dedupe_any(df: DataFrame, keys, tiebreak=None) -> DataFrame:
    """Any one row per key (ROW_NUMBER with no ORDER BY).

    Made deterministic by taking the smallest row by ``tiebreak`` (all
    remaining columns when not given).
    """
    keys = _cols(keys)
    tb = _cols(tiebreak) or [c for c in df.columns if c not in keys]
    return latest_by_key(df, keys, tb, ascending=True)


# ---------------------------------------------------------------- previous / next

def with_previous(df: DataFrame, keys, order: str, cols: Sequence[str] | None = None,
                  prefix: str = "prev_", bucket: Column | None = None, tiebreak=None,
                  descending: bool = False, limit: int | None = R.LIMIT) -> DataFrame:
    """``LAG(c) OVER (PARTITION BY keys ORDER BY order[, tiebreak])`` for each col.

    ``descending`` orders ``order`` and ``tiebreak`` descending (NULLs last).
    In a key of more than ``limit`` rows, the first row of each range takes
    the last row of the key's range before it (``limit=None``: one window per key).
    With ``bucket`` (a date or number, monotone in ``order``, e.g.
    ``to_date(ts)``) the lag is split: windows run per (keys, bucket); the
    first row of each bucket takes the last row of the nearest preceding
    non-empty bucket of the same key.
    """
    keys = _cols(keys)
    cols = list(cols or [order])
    tb = _cols(tiebreak)
    spec = _order([order, *tb], not descending)
    if bucket is None:
        def plain(d: DataFrame) -> DataFrame:
            w = Window.partitionBy(*keys).orderBy(*spec)
            return d.select("*", *[F.lag(c).over(w).alias(prefix + c) for c in cols])

        def split(d: DataFrame, names: list[str]) -> DataFrame:
            r = R.Ranges(d, names, spec)
            inner = d.select("*", F.row_number().over(r.inside).alias("__rn"),
                             *[F.lag(c).over(r.inside).alias(f"__l{i}") for i, c in enumerate(cols)])
            last = r.last([order, *tb], cols, descending)
            carry = last.select("__p", *names, F.lag("__e").over(r.over).alias("__pt"))
            return r.joined(inner, carry).select(*df.columns, *[
                F.when(F.col("__rn") == 1, F.col("__pt")[f"__v{i}"]).otherwise(F.col(f"__l{i}")).alias(prefix + c)
                for i, c in enumerate(cols)])

        return R.bounded(df, keys, spec, plain, split, limit)
    b, kc = _split(df, keys, bucket)
    w = Window.partitionBy(*kc, "__b").orderBy(*spec)
    inner = b.select("*", F.row_number().over(w).alias("__rn"),
                     *[F.lag(c).over(w).alias("__lag_" + c) for c in cols])
    # last row of each bucket: the max of (order, tiebreak) ascending, the min descending
    # (struct comparison puts NULLs first, matching NULLS FIRST asc / NULLS LAST desc)
    packed = F.struct(F.col(order).alias("__o"), *[F.col(t) for t in tb], *[F.col(c).alias("__v_" + c) for c in cols])
    tail = b.groupBy(*kc, "__b").agg((F.min(packed) if descending else F.max(packed)).alias("__t"))
    wb = Window.partitionBy(*kc).orderBy(F.col("__b").desc() if descending else F.col("__b").asc())
    carry = tail.select(*kc, "__b", F.lag("__t").over(wb).alias("__pt"))
    j = inner.join(carry, kc + ["__b"], "left")
    return j.select(*df.columns, *[
        F.when(F.col("__rn") == 1, F.col("__pt")["__v_" + c]).otherwise(F.col("__lag_" + c)).alias(prefix + c)
        for c in cols])


def with_next(df: DataFrame, keys, order: str, cols: Sequence[str], prefix: str = "next_",
              tiebreak=None, bucket: Column | None = None, limit: int | None = R.LIMIT) -> DataFrame:
    """``LEAD(c)`` for each col over one window spec (one exchange, one sort).

    In a key of more than ``limit`` rows, the last row of each range takes the
    first row of the key's next range (``limit=None``: one window per key).
    ``bucket`` splits the window as in :func:`with_previous`: the last row of
    a bucket takes the first row of the key's next non-empty bucket.
    """
    keys = _cols(keys)
    tb = _cols(tiebreak)
    spec = [F.col(order), *[F.col(t) for t in tb]]
    if bucket is None:
        def plain(d: DataFrame) -> DataFrame:
            w = Window.partitionBy(*keys).orderBy(*spec)
            return d.select("*", *[F.lead(c).over(w).alias(prefix + c) for c in cols])

        def split(d: DataFrame, names: list[str]) -> DataFrame:
            r = R.Ranges(d, names, spec)
            inner = d.select("*", F.lead(F.lit(1)).over(r.inside).alias("__more"),
                             *[F.lead(c).over(r.inside).alias(f"__l{i}") for i, c in enumerate(cols)])
            carry = r.first([order, *tb], cols).select("__p", *names, F.lead("__e").over(r.over).alias("__nh"))
            return r.joined(inner, carry).select(*df.columns, *[
                F.when(F.col("__more").isNull(), F.col("__nh")[f"__v{i}"]).otherwise(F.col(f"__l{i}")).alias(prefix + c)
                for i, c in enumerate(cols)])

        return R.bounded(df, keys, spec, plain, split, limit)
    b, kc = _split(df, keys, bucket)
    w = Window.partitionBy(*kc, "__b").orderBy(*spec)
    inner = b.select("*", F.lead(F.lit(1)).over(w).alias("__more"),
                     *[F.lead(c).over(w).alias("__lead_" + c) for c in cols])
    head = b.groupBy(*kc, "__b").agg(
        F.min(F.struct(F.col(order).alias("__o"), *[F.col(t) for t in tb],
                       *[F.col(c).alias("__v_" + c) for c in cols])).alias("__h"))
    carry = head.select(*kc, "__b", F.lead("__h").over(Window.partitionBy(*kc).orderBy("__b")).alias("__nh"))
    j = inner.join(carry, kc + ["__b"], "left")
    return j.select(*df.columns, *[
        F.when(F.col("__more").isNull(), F.col("__nh")["__v_" + c]).otherwise(F.col("__lead_" + c)).alias(prefix + c)
        for c in cols])


def previous_strictly_earlier(df: DataFrame, keys, ts: str, name: str = "prev_ts",
                              limit: int | None = R.LIMIT) -> DataFrame:
    """Max earlier time for the same key, skipping rows with an equal time.

    The correlated ``(SELECT MAX(ts) FROM t t2 WHERE t2.k = t.k AND
    t2.ts < t.ts)`` sub-query.  ``LAG`` equals it only when times are unique
    per key; here ties are handled exactly: take the distinct times per key
    (an aggregate), lag over those (by ranges for a heavy key), join back on
    (key, ts).
    """
    keys = _cols(keys)
    distinct_ts = df.select(*keys, ts).where(F.col(ts).isNotNull()).distinct()
    prev = with_previous(distinct_ts, keys, ts, [ts], prefix="__p_", limit=limit)
    prev = prev.withColumnRenamed("__p_" + ts, name)
    return join_on(df, prev, keys + [ts])


def period_lag(df: DataFrame, keys, order: str, cols: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Previous *existing* period's values (not the previous calendar period).

    Runs over a per-period aggregate (one row per key and period), so the
    window is small whatever the size of the fact.
    """
    return with_previous(df, keys, order, cols, prefix=prefix)


def sequence_gaps(df: DataFrame, device: str, seq: str, descending: bool = True,
                  reset: bool = False, name: str = "gap", seq_bucket: int | None = None,
                  device_descending: bool = False, limit: int | None = R.LIMIT) -> DataFrame:
    """Difference of ``seq`` from the previous row ordered by (device, seq).

    ``reset=False`` reproduces one global window over the whole table: the
    first row of a device is compared with the last row of the previous
    device.  Exact without a single-partition sort: lag per device, then
    each device's boundary value comes from a per-device aggregate (one row
    per device) lagged over devices.  ``reset=True`` gives the per-device
    gap (first row NULL).  The two directions are separate: by default
    devices ascend and, with ``descending``, numbers descend inside each (so a
    normal step is -1).  A device of more than ``limit`` rows is lagged by
    ranges (or by ``seq_bucket``-wide slices of the sequence), so one busy
    camera does not become one task.
    """
    bucket = F.floor(F.col(seq) / seq_bucket) if seq_bucket else None
    lagged = with_previous(df, device, seq, [seq], prefix="__p_", bucket=bucket, descending=descending, limit=limit)
    lagged = lagged.withColumnRenamed("__p_" + seq, "__prev")
    if reset:
        return lagged.withColumn(name, F.col(seq) - F.col("__prev")).drop("__prev")
    # last value of each device in the global order, carried to the next device
    # (NULLs sort last in either direction, so a device holding a NULL ends on it)
    last = F.min(seq) if descending else F.max(seq)
    edge = lagged.groupBy(device).agg(F.when(F.count(seq) == F.count(F.lit(1)), last).alias("__last"))
    # one row per device: a single small window over the device list
    wd = Window.orderBy(F.col(device).desc() if device_descending else F.col(device).asc())
    carry = edge.select(device, F.lag("__last").over(wd).alias("__carry"))
    j = join_on(lagged, carry, [device])
    prev = F.coalesce(F.col("__prev"), F.col("__carry"))
    return j.withColumn(name, F.col(seq) - prev).drop("__prev", "__carry")


# ---------------------------------------------------------------- running totals

def running_total(df: DataFrame, order, value: str, name: str = "running", keys=None,
                  opening: DataFrame | None = None, opening_col: str = "opening",
                  bucket: Column | None = None) -> DataFrame:
    """Cumulative sum of ``value`` by ``order`` (``ROWS UNBOUNDED PRECEDING``).

    ``keys`` restart the sum per key.  ``opening`` (one row per key, or a
    single row without keys) is added to every row.  With ``bucket`` the
    sum is two-level: per-(key, bucket) totals are prefix-summed (small),
    rows are summed inside their bucket, and the two are added -- no
    single-partition window even without keys.
    """
    keys = _cols(keys)
    order = _cols(order)
    if bucket is None:
        w = (Window.partitionBy(*keys).orderBy(*[F.col(o) for o in order])
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out = df.withColumn(name, F.sum(value).over(w))
    else:
        b, kc = _split(df, keys, bucket)
        w = (Window.partitionBy(*kc, "__b").orderBy(*[F.col(o) for o in order])
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        inner = b.withColumn("__in", F.sum(value).over(w))
        tot = b.groupBy(*kc, "__b").agg(F.sum(value).alias("__bt"))
        wk = Window.partitionBy(*kc).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        offs = tot.select(*kc, "__b", F.coalesce(F.sum("__bt").over(wk), F.lit(0)).alias("__off"))
        out = (inner.join(offs, kc + ["__b"], "left")
                    .select(*df.columns, (F.col("__in") + F.col("__off")).alias(name)))
    if opening is not None:
        if keys:
            out = join_on(out, opening.select(*keys, opening_col), keys)
            open_v = F.col(opening_col)
        else:
            # a single value: scalar sub-query, evaluated once
            open_v = opening.select(opening_col).scalar()
        out = out.withColumn(name, F.col(name) + F.coalesce(open_v, F.lit(0)))
        if keys:
            out = out.drop(opening_col)
    return out


def rolling_values(df: DataFrame, keys, order, col: str, n: int, name: str = "history") -> DataFrame:
    """Previous ``n`` values (excluding the current row) as an array.

    Empty frames give NULL (the reference's ARRAY_AGG over no rows), not
    Spark's ``[]``.  Meant for per-day aggregates: the frame is bounded.
    """
    w = (Window.partitionBy(*_cols(keys)).orderBy(*[F.col(o) for o in _cols(order)])
         .rowsBetween(-n, -1))
    arr = F.collect_list(col).over(w)
    return df.withColumn(name, F.when(F.size(arr) > 0, arr))


def exact_percentiles(df: DataFrame, keys, col: str, shares: Sequence[float], names: Sequence[str],
                      limit: int | None = R.LIMIT) -> DataFrame:
    """One row per key with interpolated percentiles (PERCENTILE_CONT) of the non-NULL ``col``.

    Keys of up to ``limit`` rows use ``percentile``, which holds a key's distinct values in one buffer.  For
    heavier keys the values are ranked by ranges (see ``ranges.py``): of a key with n values, the share p
    lies at rank 1 + p (n - 1); only the one or two values next to each wanted rank leave their range.
    """
    keys = _cols(keys)

    def plain(d: DataFrame) -> DataFrame:
        return d.groupBy(*keys).agg(*[F.percentile(col, p).alias(n) for p, n in zip(shares, names)])

    if limit is None:
        return plain(df)
    k, kc = R.keyed(df.select(*keys, F.col(col).cast("double").alias(col)), keys)
    heavy, rows = R.heavy_keys(k, kc, limit)
    if heavy is None:
        return plain(df)
    light = plain(k.join(heavy, kc, "left_anti").select(*keys, col))
    cut = R.range_rows(k.join(heavy, kc, "left_semi"), kc, [F.col(col)], rows, limit)
    r = R.Ranges(cut, kc, [F.col(col)])
    # NULLs sort first: they take no rank
    counts = r.summary(F.count(col).alias("__n"))
    before = counts.select("__p", *kc, F.coalesce(F.sum("__n").over(r.over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"),
                           F.sum("__n").over(Window.partitionBy(*kc)).alias("__all"))
    inner = cut.where(F.col(col).isNotNull()).withColumn("__in", F.row_number().over(r.inside))
    ranked = r.joined(inner, before).withColumn("__rank", F.col("__in") + F.col("__off"))
    at = [F.lit(float(p)) * (F.col("__all") - 1) + 1 for p in shares]
    near = None
    for a in at:
        hit = (F.col("__rank") >= F.floor(a)) & (F.col("__rank") <= F.floor(a) + 1)
        near = hit if near is None else near | hit
    vals = []
    for a, n in zip(at, names):
        low = F.max(F.when(F.col("__rank") == F.floor(a), F.col(col)))
        high = F.max(F.when(F.col("__rank") == F.least(F.floor(a) + 1, F.col("__all")), F.col(col)))
        part = F.max(a - F.floor(a))
        vals.append((low + F.when(part > 0, part * (high - low)).otherwise(0.0)).alias(n))
    some = ranked.where(near).groupBy(*kc).agg(*vals)
    # a heavy key of NULLs alone keeps its row
    ids = cut.groupBy(*kc).agg(*[F.first(c).alias(c) for c in keys])
    return light.unionByName(ids.join(some, kc, "left").select(*keys, *names))


def percentile_band(df: DataFrame, keys, col: str, lo: float = 0.05, hi: float = 0.95,
                    names=("p_lo", "p_hi"), window: bool = False, limit: int | None = R.LIMIT) -> DataFrame:
    """Interpolated percentiles of ``col`` per partition beside each row.

    Exact percentiles per key (:func:`exact_percentiles`), joined back on the
    keys -- one row per key on the small side -- so the rows are not sorted
    per key for a whole-partition window.  Over an already aggregated input
    (one row per key and day), ``window=True`` computes it as a
    whole-partition window instead: the input is then read once, and a
    partition holds at most one row per day.
    """
    keys = _cols(keys)
    if window:
        w = Window.partitionBy(*keys)
        return df.select("*", F.percentile(col, lo).over(w).alias(names[0]),
                         F.percentile(col, hi).over(w).alias(names[1]))
    return join_on(df, exact_percentiles(df, keys, col, (lo, hi), names, limit), keys)


def first_non_null_after(df: DataFrame, keys, order, col: str, name: str,
                         bucket: Column | None = None, limit: int | None = R.LIMIT) -> DataFrame:
    """First non-NULL ``col`` from the current row to the end of the partition.

    In a key of more than ``limit`` rows: first non-NULL to the end of the
    row's range, else that of the key's later ranges (``limit=None``: one
    window per key).
    With ``bucket`` (a date, monotone in the first ordering column): first
    non-NULL to the end of the row's bucket, else the first non-NULL of the
    key's later buckets (per-bucket first values, windowed per key).
    """
    keys = _cols(keys)
    order = _cols(order)
    spec = [F.col(o) for o in order]
    if bucket is None:
        def plain(d: DataFrame) -> DataFrame:
            w = Window.partitionBy(*keys).orderBy(*spec).rowsBetween(Window.currentRow, Window.unboundedFollowing)
            return d.withColumn(name, F.first(col, ignorenulls=True).over(w))

        def split(d: DataFrame, names: list[str]) -> DataFrame:
            r = R.Ranges(d, names, spec)
            inner = d.withColumn("__in", F.first(col, ignorenulls=True).over(
                r.inside.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
            after = r.over.rowsBetween(1, Window.unboundedFollowing)
            later = r.first(order, [col], present=col).select(
                "__p", *names, F.first(F.col("__e")["__v0"], ignorenulls=True).over(after).alias("__later"))
            return r.joined(inner, later).select(*df.columns, F.coalesce("__in", "__later").alias(name))

        return R.bounded(df, keys, spec, plain, split, limit)
    b, kc = _split(df, keys, bucket)
    w = Window.partitionBy(*kc, "__b").orderBy(*spec).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    inner = b.withColumn("__in", F.first(col, ignorenulls=True).over(w))
    # every bucket of the key, also those holding only NULLs (their first value is NULL)
    firsts = b.groupBy(*kc, "__b").agg(
        F.min(F.when(F.col(col).isNotNull(), F.struct(*spec, F.col(col).alias("__v")))).alias("__f"))
    wk = Window.partitionBy(*kc).orderBy("__b").rowsBetween(1, Window.unboundedFollowing)
    later = firsts.select(*kc, "__b", F.first(F.col("__f")["__v"], ignorenulls=True).over(wk).alias("__later"))
    out = inner.join(later, kc + ["__b"], "left")
    return out.select(*df.columns, F.coalesce("__in", "__later").alias(name))


def total_over(df: DataFrame, keys, value, name: str) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY keys)`` as aggregate + join (skew-safe).

    The aggregate is combined map-side (one row per key per partition) and
    has one row per key; the join back is broadcast when that is small, or
    a sort-merge join whose hot-key partition AQE splits.
    """
    keys = _cols(keys)
    v = F.col(value) if isinstance(value, str) else value
    tot = df.groupBy(*keys).agg(F.sum(v).alias(name))
    return join_on(df, tot, keys)
