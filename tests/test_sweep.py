"""Interval counts and pairs against plain loops, with keys hot on both sides."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kerbside.operators import ranges as R
from kerbside.operators import sweep as S

T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else T0 + dt.timedelta(hours=hours)


def data(seed, n_events=260, n_intervals=90, longest=120):
    """Events with NULL, reversed and long stays; intervals with NULL, reversed, repeated and point ones."""
    r = random.Random(seed)
    ev, iv = [], []
    for i in range(n_events):
        a = r.randrange(400)
        d = None if i % 11 == 0 else a + r.randrange(-3, longest)
        ev.append((i, "hot" if i % 2 else r.choice(["p", "q", None]), None if i % 17 == 0 else a, d))
    for i in range(n_intervals):
        s = r.randrange(400)
        e = None if i % 13 == 0 else s + r.randrange(-2, 60)
        iv.append((i, "hot" if i % 2 else r.choice(["p", "q", "z", None]), None if i % 19 == 0 else s, e))
    iv += [(1000 + x[0],) + x[1:] for x in iv[:9]]
    return ev, iv


def frames(spark, ev, iv):
    return (spark.createDataFrame([(i, k, at(a), at(d)) for i, k, a, d in ev], "eid long, k string, a timestamp_ntz, d timestamp_ntz"),
            spark.createDataFrame([(i, k, at(s), at(e)) for i, k, s, e in iv], "iid long, k string, s timestamp_ntz, e timestamp_ntz"))


@pytest.mark.parametrize("seed,pairs,limit,longest", [(1, 0, 40, 120), (2, 0, R.LIMIT, 400), (3, 1000, 40, 30), (4, S.PAIRS, R.LIMIT, 120)])
def test_counts_equal_plain_loops(spark, seed, pairs, limit, longest):
    ev, iv = data(seed, longest=longest)
    e, i = frames(spark, ev, iv)
    got = {r["iid"]: r["n"] for r in S.count_either(i, e, ["k"], "a", "d", "s", "e", pairs=pairs, limit=limit).collect()}
    inside = lambda t, s, x: t is not None and s is not None and x is not None and s <= t <= x
    want = {j: sum(k is not None and k == k2 and (inside(a, s, x) or inside(d, s, x)) for _, k2, a, d in ev) for j, k, s, x in iv}
    assert got == want and len(got) == len(iv)


@pytest.mark.parametrize("pairs,cut", [(0, 5), (0, 50), (S.PAIRS, 50)])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_pairs_equal_plain_loops(spark, pairs, cut, how):
    ev, iv = data(7)
    e, i = frames(spark, ev, iv)
    got = sorted((r["eid"], -1 if r["iid"] is None else r["iid"]) for r in
                 S.interval_pairs(e, i, ["k"], "a", "s", "e", how=how, pairs=pairs, cut=cut, limit=30).select("eid", "iid").collect())
    want = []
    for x, k, a, _ in ev:
        hit = [j for j, k2, s, y in iv if k is not None and k == k2 and a is not None and s is not None and s <= a and (y is None or a <= y)]
        want += [(x, j) for j in hit] or ([(x, -1)] if how == "left" else [])
    assert got == sorted(want)


def test_few_comparisons_in_vain(spark):
    """A key hot on both sides: the rows compared stay near the pairs found."""
    r = random.Random(3)
    e = spark.createDataFrame([(i, "k", at(r.randrange(20_000))) for i in range(4000)], "eid long, k string, a timestamp_ntz")
    iv = [(j, "k", s, s + 40) for j, s in enumerate(r.randrange(20_000) for _ in range(1500))]
    i = spark.createDataFrame([(j, k, at(s), at(x)) for j, k, s, x in iv], "iid long, k string, s timestamp_ntz, e timestamp_ntz")
    k, names = R.keyed(e.withColumn("__t", e["a"]), ["k"])
    rows = R.range_rows(k, names, [k["__t"]], 4000, 40)
    ivk, _ = R.keyed(i, ["k"])
    near = S._touched(ivk.withColumns({"__s": ivk["s"], "__e": ivk["e"]}), rows, names, 500)
    compared = near.join(rows.groupBy("__p").count(), "__p").agg({"count": "sum"}).first()[0]
    found = S.interval_pairs(e, i, ["k"], "a", "s", "e", how="inner", pairs=0, cut=20, limit=500).count()
    assert found <= compared <= found + 2 * 40 * 1500 < 4000 * 1500 / 20


def test_empty_sides(spark):
    e, i = frames(spark, *data(5))
    assert S.count_either(i.where("false"), e, ["k"], "a", "d", "s", "e", pairs=0).count() == 0
    assert {r["n"] for r in S.count_either(i, e.where("false"), ["k"], "a", "d", "s", "e", pairs=0).collect()} == {0}
    assert S.interval_pairs(e, i.where("false"), ["k"], "a", "s", "e", pairs=0).count() == e.count()


def test_counts_are_dealt_by_rows(spark, monkeypatch):
    """However few bytes they take, no task gets many of the rows."""
    monkeypatch.setattr(R, "TASK_ROWS", 100)
    e, i = frames(spark, [(j, f"k{j % 300}", j, j + 5) for j in range(900)], [(j, f"k{j % 300}", j, j + 50) for j in range(900)])
    got = S.count_either(i, e, ["k"], "a", "d", "s", "e")
    per = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per) == 900 and max(per) < 200
