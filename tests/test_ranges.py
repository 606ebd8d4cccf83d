"""Bounded windows: equal to the plain window, with a third of the rows on one key in one day."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kerbside.operators import ranges as R
from kerbside.operators import windows as W

T0 = dt.datetime(2024, 1, 1)
LIMIT = 60


@pytest.fixture(scope="module")
def rows(spark):
    """900 rows: 300 of key ``hot`` within one day (many at equal times), 90 of a NULL key, NULL times, the rest spread."""
    r = random.Random(4)
    data = []
    for i in range(900):
        if i % 3 == 0:
            k, t = "hot", T0 + dt.timedelta(minutes=r.randrange(200))
        elif i % 7 == 1:
            k, t = None, T0 + dt.timedelta(days=r.randrange(9))
        else:
            k, t = f"k{r.randrange(30)}", T0 + dt.timedelta(hours=r.randrange(900))
        data.append((i, k, None if i % 37 == 0 else t, r.choice([None, None, None, "x", "y"]), r.randrange(50)))
    return spark.createDataFrame(data, "id long, k string, t timestamp_ntz, a string, v long").repartition(5).cache()


def out(df, cols):
    return sorted(map(repr, (tuple(x) for x in df.select("id", *cols).collect())))


@pytest.mark.parametrize("limit", [25, LIMIT, 250])
def test_equal_to_the_plain_window(rows, limit):
    for asc in (True, False):
        a, b = (W.rank_rows(rows, "k", "t", ascending=asc, tiebreak="id", limit=n) for n in (limit, None))
        assert out(a, ["rn"]) == out(b, ["rn"])
    for down in (False, True):
        a, b = (W.with_previous(rows, "k", "t", ["t", "a"], tiebreak="id", descending=down, limit=n) for n in (limit, None))
        assert out(a, ["prev_t", "prev_a"]) == out(b, ["prev_t", "prev_a"])
    a, b = (W.with_next(rows, "k", "t", ["a", "v"], tiebreak="id", limit=n) for n in (limit, None))
    assert out(a, ["next_a", "next_v"]) == out(b, ["next_a", "next_v"])
    a, b = (W.first_non_null_after(rows, "k", ["t", "id"], "a", "fa", limit=n) for n in (limit, None))
    assert out(a, ["fa"]) == out(b, ["fa"])
    a, b = (W.previous_strictly_earlier(rows, "k", "t", limit=n) for n in (limit, None))
    assert out(a, ["prev_ts"]) == out(b, ["prev_ts"])


def test_no_range_holds_more_than_the_limit(rows):
    k, names = R.keyed(rows, ["k"])
    heavy, n = R.heavy_keys(k, names, LIMIT)
    assert {(r["__kv0"], r["__kn0"]) for r in heavy.collect()} == {("hot", False), ("", True)}
    cut = R.range_rows(k.join(heavy, names, "left_semi"), names, [F.col("t"), F.col("id")], n, LIMIT)
    sizes = [r["count"] for r in cut.groupBy("__p").count().collect()]
    assert sum(sizes) == n and max(sizes) <= LIMIT
    # ranges ascend along the order of each key
    last = {}
    for r in cut.orderBy("__kv0", "__kn0", "t", "id").collect():
        key = (r["__kv0"], r["__kn0"])
        assert last.get(key, -1) <= r["__p"]
        last[key] = r["__p"]


def test_equal_rows_are_cut_too(spark):
    """A key whose rows are all equal is cut as well; ranks are 1 to n."""
    df = spark.createDataFrame([("k", T0)] * 200, "k string, t timestamp_ntz")
    got = W.rank_rows(df, "k", "t", limit=20)
    assert sorted(r["rn"] for r in got.collect()) == list(range(1, 201))
    nxt = W.with_next(df, "k", "t", ["t"], limit=20)
    assert nxt.where("next_t IS NULL").count() == 1


def test_light_keys_take_one_exchange(rows):
    """No key over the limit: the plan is the plain window."""
    plan = W.rank_rows(rows, "k", "t", tiebreak="id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_empty(rows):
    assert W.rank_rows(rows.where("false"), "k", "t", limit=LIMIT).count() == 0
    assert W.with_previous(rows.where("false"), "k", "t", limit=LIMIT).count() == 0
