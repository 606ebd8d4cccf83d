"""Intervals and events of one key without comparing all of one with all of the other.

A key with few intervals is joined plainly (an equi-join with a range
residual): each event meets at most those few, whatever the number of events.
So is one whose events times intervals stay under ``pairs``.  When they are
counted, both sides are dealt over tasks by their number of rows.  For a key
that is hot on both sides:

* *counts* need no pairs.  Starts, ends and events run as one ordered stream
  and running counts are read at the interval's ends.  With lo and hi the
  earlier and later of an event's two times, the events with an end inside
  [s, e] are N(lo <= e) - N(hi < s) - N(lo < s and hi > e).  The last term,
  events that reach over the whole interval, is a count in two dimensions;
  it is taken over dyadic blocks of the events in order of lo, each again a
  running count, and only for events and intervals that can take part;
* *pairs* are found by ranges: the events are cut into ranges of ``cut``
  rows, an interval is sent to the ranges it touches (its first and last one
  are looked up in a stream, too).  All events of the ranges between are
  pairs, so what is compared in vain is at most two ranges an interval.

Running counts are bounded windows (``ranges.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators import ranges as R

#: Intervals of one key that each of its events may meet, and comparisons of one key that a plain join may cost.
FEW, PAIRS = 1_000, 50_000_000
#: Events of one range when pairs are wanted.
CUT = 2_000

_HOW = {"sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))), "max": (F.max, F.greatest), "min": (F.min, F.least)}


def running(df: DataFrame, keys: Sequence[str], spec: list[Column], values: dict[str, str], how: str = "sum",
            limit: int | None = R.LIMIT) -> DataFrame:
    """Running ``how`` (sum, max, min) of the columns ``values`` (new name: column), the row included."""
    agg, both = _HOW[how]

    def plain(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*spec).rowsBetween(Window.unboundedPreceding, 0)
        return d.select("*", *[agg(c).over(w).alias(n) for n, c in values.items()])

    def split(d: DataFrame, names: list[str]) -> DataFrame:
        r = R.Ranges(d, names, spec)
        inner = d.select("*", *[agg(c).over(r.inside.rowsBetween(Window.unboundedPreceding, 0)).alias(f"__in_{n}")
                                for n, c in values.items()])
        before = r.over.rowsBetween(Window.unboundedPreceding, -1)
        carried = r.summary(*[agg(c).alias(f"__s_{n}") for n, c in values.items()]) \
            .select("__p", *names, *[agg(f"__s_{n}").over(before).alias(f"__c_{n}") for n in values])
        return r.joined(inner, carried).select(*df.columns, *[both(F.col(f"__in_{n}"), F.col(f"__c_{n}")).alias(n) for n in values])

    return R.bounded(df, keys, spec, plain, split, limit)


def hot_keys(intervals: DataFrame, events: DataFrame, keys: Sequence[str], pairs: int) -> DataFrame | None:
    """The keys with more than a few intervals for which intervals times events exceed ``pairs``.

    Only the intervals are counted unless some key has many; such keys are at most one per ``FEW`` intervals.
    """
    many = intervals.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("__a")).where(F.col("__a") > min(FEW, pairs // 100))
    rows = many.collect()
    if not rows:
        return None
    many = intervals.sparkSession.createDataFrame([tuple(r) for r in rows], many.schema)
    counts = events.join(many.select(*keys), list(keys), "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("__b"))
    found = counts.join(many, list(keys)).where(F.col("__a") * F.col("__b") > pairs).select(*keys)
    rows = found.collect()
    return found.sparkSession.createDataFrame([tuple(r) for r in rows], found.schema) if rows else None


def _either(a, d, s, e) -> Column:
    return F.col(a).between(F.col(s), F.col(e)) | F.col(d).between(F.col(s), F.col(e))


def _reaching_over(q: DataFrame, ev: DataFrame, keys: list[str], limit: int | None) -> DataFrame:
    """(keys, s, e, over): events with lo < s and hi > e, for the intervals that have some."""
    # an event takes part if an interval starts after its lo and before its hi
    null = F.lit(None).cast(ev.schema["hi"].dataType)
    marks = q.select(*keys, F.col("s").alias("t"), F.lit(1).alias("ord"), F.col("s").alias("next"), null.alias("hi")).distinct() \
        .unionByName(ev.select(*keys, F.col("lo").alias("t"), F.lit(0).alias("ord"), null.alias("next"), "hi"))
    late = running(marks, keys, [F.col("t").desc(), F.col("ord")], {"nearest": "next"}, "min", limit)
    ev = late.where((F.col("ord") == 0) & (F.col("nearest") < F.col("hi"))).select(*keys, F.col("t").alias("lo"), "hi")
    both = q.select(*keys, "s", "e", null.alias("hi"), F.col("s").alias("t"), F.lit(0).alias("ord"), F.lit(0).alias("one")) \
        .unionByName(ev.select(*keys, null.alias("s"), null.alias("e"), "hi", F.col("lo").alias("t"), F.lit(1).alias("ord"), F.lit(1).alias("one")))
    ranked = running(both, keys, [F.col("t"), F.col("ord")], {"n": "one"}, "sum", limit)
    # an event of rank n lies in block (n - 1) >> j of each level j; the n events before an interval are the blocks
    # (n >> j) - 1 of the levels j whose bit is set in n
    asked = ranked.where("one = 0 AND n > 0") \
        .select(*keys, "s", "e", "n", F.explode(F.sequence(F.lit(0), F.floor(F.log2("n")).cast("int") + 1)).alias("j")) \
        .where("shiftright(n, j) % 2 = 1").withColumn("block", F.expr("shiftright(n, j) - 1"))
    # levels above an interval's count of events are never asked for
    top = asked.groupBy(*keys).agg(F.max("j").alias("top"))
    held = ranked.where("one = 1").select(*keys, "hi", "n").join(top, keys) \
        .select(*keys, "hi", "n", F.explode(F.sequence(F.lit(0), "top")).alias("j")) \
        .withColumn("block", F.expr("shiftright(n - 1, j)")).where("block % 2 = 0")
    stream = held.select(*keys, "j", "block", null.alias("s"), null.alias("e"), F.col("hi").alias("t"), F.lit(1).alias("ord"), F.lit(1).alias("one")) \
        .unionByName(asked.select(*keys, "j", "block", "s", "e", F.col("e").alias("t"), F.lit(0).alias("ord"), F.lit(0).alias("one")))
    seen = running(stream, [*keys, "j", "block"], [F.col("t").desc(), F.col("ord")], {"above": "one"}, "sum", limit)
    return seen.where("one = 0").groupBy(*keys, "s", "e").agg(F.sum("above").alias("over"))


def _swept(iv: DataFrame, ev: DataFrame, keys: list[str], limit: int | None) -> DataFrame:
    """(keys, s, e, n) of distinct intervals with s <= e over events (keys, lo, hi)."""
    kind = iv.schema["s"].dataType
    none = F.lit(None).cast(kind)
    ends = ev.select(*keys, F.explode(F.array(F.struct(F.col("lo").alias("t"), F.lit(0).alias("ord")),
                                              F.struct(F.col("hi").alias("t"), F.lit(2).alias("ord")))).alias("x")) \
        .groupBy(*keys, "x.t", "x.ord").agg(F.count(F.lit(1)).alias("c"))
    ends = ends.select(*keys, "t", "ord", none.alias("s"), none.alias("e"), F.when(F.col("ord") == 0, F.col("c")).otherwise(0).alias("came"),
                       F.when(F.col("ord") == 2, F.col("c")).otherwise(0).alias("gone"))
    asks = iv.select(*keys, F.explode(F.array("s", "e")).alias("t"), F.lit(1).alias("ord"), "s", "e",
                     F.lit(0).cast("long").alias("came"), F.lit(0).cast("long").alias("gone"))
    run = running(ends.unionByName(asks), keys, [F.col("t"), F.col("ord")], {"n_came": "came", "n_gone": "gone"}, "sum", limit)
    # at e: all that came by then; at s: those gone before, and those that stand there
    q = run.where("ord = 1").groupBy(*keys, "s", "e").agg(
        F.max(F.when(F.col("t") == F.col("e"), F.col("n_came"))).alias("by_e"),
        F.min(F.when(F.col("t") == F.col("s"), F.col("n_gone"))).alias("before_s"),
        F.min(F.when(F.col("t") == F.col("s"), F.col("n_came"))).alias("by_s"))
    q = R.stored(q, "sweep")
    over = _reaching_over(q.where("by_s > before_s").select(*keys, "s", "e"), ev, keys, limit)
    return q.join(over, [*keys, "s", "e"], "left") \
        .select(*keys, "s", "e", (F.col("by_e") - F.col("before_s") - F.coalesce("over", F.lit(0))).alias("n"))


def count_either(intervals: DataFrame, events: DataFrame, keys: Sequence[str], a: str, d: str, start: str, end: str,
                 name: str = "n", pairs: int = PAIRS, limit: int | None = R.LIMIT) -> DataFrame:
    """Every interval with the number of its key's events whose ``a`` OR ``d`` lies in [start, end].

    A NULL or reversed interval counts 0, as BETWEEN does; a NULL key has no events; an event with one
    time counts by that one.
    """
    keys = list(keys)
    ev = events.select(*keys, F.least(a, d).alias("__lo"), F.greatest(a, d).alias("__hi")).where("__lo IS NOT NULL")
    ev = R.stored(ev, "events")
    size = intervals.count() + ev.count()
    hot = hot_keys(intervals, ev, keys, pairs)
    light = intervals if hot is None else _side(intervals, hot, keys, "left_anti")
    light_ev = ev if hot is None else _side(ev, hot, keys, "left_anti")
    # one join; the count needs no further exchange, as its groups hold the join's keys
    rows = R.spread(light, size, *keys).withColumn("__id", F.monotonically_increasing_id())
    right = R.spread(light_ev.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__lo", "__hi"), size, *[f"__k_{k}" for k in keys])
    cond = [rows[k] == right[f"__k_{k}"] for k in keys] + [_either("__lo", "__hi", start, end)]
    out = rows.join(right, cond, "left").groupBy("__id", *intervals.columns).agg(F.count("__lo").alias(name)).drop("__id")
    if hot is None:
        return out
    heavy, heavy_ev = (_side(x, hot, keys, "left_semi") for x in (intervals, ev))
    whole = F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end))
    iv = heavy.where(whole).select(*keys, F.col(start).alias("s"), F.col(end).alias("e")).distinct()
    found = _swept(iv, heavy_ev.withColumnsRenamed({"__lo": "lo", "__hi": "hi"}), keys, limit)
    back = found.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("s").alias("__s"), F.col("e").alias("__e"), F.col("n").alias("__n"))
    cond = [heavy[k] == back[f"__k_{k}"] for k in keys] + [heavy[start] == back["__s"], heavy[end] == back["__e"]]
    swept = heavy.join(back, cond, "left").select(*[heavy[c] for c in intervals.columns], F.coalesce("__n", F.lit(0)).alias(name))
    return out.unionByName(swept)


def _side(df: DataFrame, hot: DataFrame, keys: Sequence[str], kind: str) -> DataFrame:
    """Rows of the hot keys (left_semi) or of all others, NULL keys included (left_anti)."""
    h = hot.select(*[F.col(k).alias(f"__h_{k}") for k in keys])
    return df.join(h, [df[k] == h[f"__h_{k}"] for k in keys], kind)


def _touched(iv: DataFrame, cut: DataFrame, names: list[str], limit: int | None) -> DataFrame:
    """Intervals (key columns, ``__s``, ``__e``) with every range ``__p`` of the key that they touch."""
    span = cut.groupBy("__p", *names).agg(F.min("__t").alias("lo"), F.max("__t").alias("hi"))
    num = F.lit(None).cast("int")
    rows = iv.withColumn("__id", F.monotonically_increasing_id())
    rows = R.stored(rows, "intervals")

    def near(time: str, at: str, spec: list[Column], how: str) -> DataFrame:
        marks = span.select(*names, F.col(at).alias("t"), F.lit(0).alias("ord"), F.col("__p").alias("p"), F.lit(None).cast("long").alias("__id"))
        ask = rows.select(*names, F.col(time).alias("t"), F.lit(1).alias("ord"), num.alias("p"), "__id")
        return running(marks.unionByName(ask), names, spec, {"found": "p"}, how, limit).where("ord = 1").select("__id", F.col("found").alias(how))

    # the last range that begins by e, the first that ends from s on; an open end takes the last range
    end = rows.where("__e IS NULL").join(span.groupBy(*names).agg(F.max("__p").alias("max")), names).select("__id", "max")
    last = near("__e", "lo", [F.col("t"), F.col("ord")], "max").join(end.select("__id"), "__id", "left_anti").unionByName(end)
    first = near("__s", "hi", [F.col("t").desc(), F.col("ord")], "min")
    return rows.join(first, "__id").join(last, "__id").where("min <= max") \
        .select(*[c for c in rows.columns if c != "__id"], F.explode(F.sequence("min", "max")).alias("__p"))


def interval_pairs(events: DataFrame, intervals: DataFrame, keys: Sequence[str], ts: str, start: str, end: str, how: str = "left",
                   end_inclusive: bool = True, pairs: int = PAIRS, cut: int = CUT, limit: int | None = R.LIMIT) -> DataFrame:
    """Events joined to the intervals of their key that contain ``ts`` (a NULL ``end`` is open); ``left`` keeps
    events without one.  Columns: the events', then the intervals' but the keys."""
    keys = list(keys)
    rest = [c for c in intervals.columns if c not in keys]

    def joined(e: DataFrame, i: DataFrame, on: list[str]) -> DataFrame:
        i = i.select(*[F.col(k).alias(f"__k_{k}") for k in on], *rest)
        inside = F.coalesce((e[ts] <= i[end]) if end_inclusive else (e[ts] < i[end]), F.lit(True))
        return e.join(i, [*[e[k] == i[f"__k_{k}"] for k in on], e[ts] >= i[start], inside], how).drop(*[f"__k_{k}" for k in on])

    hot = hot_keys(intervals, events.where(F.col(ts).isNotNull()), keys, pairs)
    if hot is None:
        return joined(events, intervals, keys)

    def side(df: DataFrame, kind: str) -> DataFrame:
        return _side(df, hot, keys, kind)

    light = joined(side(events, "left_anti"), side(intervals, "left_anti"), keys)
    ev, names = R.keyed(side(events, "left_semi").withColumn("__t", F.col(ts)), keys)
    iv, _ = R.keyed(side(intervals, "left_semi"), keys)
    iv = iv.withColumns({"__s": F.col(start), "__e": F.col(end)}).where(F.col(start).isNotNull())
    rows = R.range_rows(ev, names, [F.col("__t")], ev.count(), 2 * cut)
    near = _touched(iv, rows, names, limit)
    found = joined(rows, near.select(*names, "__p", *rest), [*names, "__p"])
    return light.unionByName(found.select(*light.columns))
