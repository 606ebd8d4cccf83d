"""Operators checked against brute force on small tables (including a hot key)
and report invariants."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from kerbside.operators import joins as J
from kerbside.operators import windows as W
from kerbside.operators.spatial import points_in_polygons
from kerbside.plans import occupancy as PO

T0 = dt.datetime(2024, 1, 1)


def rows_of(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def skewed(spark, n=3000, seed=7):
    """Rows where key 'hot' holds a third of the data; times with ties."""
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else f"k{rnd.randrange(40)}"
        t = T0 + dt.timedelta(minutes=rnd.randrange(60 * 24 * 20))
        data.append((i, k, t, rnd.randrange(100)))
    return spark.createDataFrame(data, "id long, k string, t timestamp_ntz, v long")


def test_latest_by_key_equals_row_number(spark):
    df = skewed(spark)
    got = W.latest_by_key(df, "k", "t", tiebreak="id")
    w = Window.partitionBy("k").orderBy(F.col("t").desc(), F.col("id").desc())
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert rows_of(got, df.columns) == rows_of(want, df.columns)
    assert got.count() == df.select("k").distinct().count()


def test_split_lag_equals_plain_lag(spark):
    df = skewed(spark)
    plain = W.with_previous(df, "k", "t", ["t", "v"], tiebreak="id")
    split = W.with_previous(df, "k", "t", ["t", "v"], tiebreak="id", bucket=F.to_date("t"))
    cols = ["id", "prev_t", "prev_v"]
    assert rows_of(plain, cols) == rows_of(split, cols)


def test_two_level_running_total(spark):
    df = skewed(spark)
    plain = W.running_total(df, ["t", "id"], "v", keys="k")
    split = W.running_total(df, ["t", "id"], "v", keys="k", bucket=F.to_date("t"))
    assert rows_of(plain, ["id", "running"]) == rows_of(split, ["id", "running"])
    glob = W.running_total(df, ["t", "id"], "v", bucket=F.to_date("t"))
    w = Window.orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("running", F.sum("v").over(w))
    assert rows_of(glob, ["id", "running"]) == rows_of(want, ["id", "running"])


def test_global_gap_without_single_partition(spark):
    rnd = random.Random(3)
    data = [(i, f"cam{rnd.randrange(6)}", None if i % 17 == 0 else rnd.randrange(10 ** 6)) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, dev string, seq long")
    got = W.sequence_gaps(df, "dev", "seq", descending=True)
    w = Window.orderBy(F.col("dev").asc(), F.col("seq").desc_nulls_last(), F.col("id"))
    want = df.withColumn("gap", F.col("seq") - F.lag("seq").over(w))
    # rows with equal (dev, seq) are interchangeable; compare per-row values on unique seq
    assert rows_of(got.where("seq IS NOT NULL"), ["id", "gap"]) == rows_of(want.where("seq IS NOT NULL"), ["id", "gap"])


def test_previous_strictly_earlier_skips_ties(spark):
    df = spark.createDataFrame([(1, "a", T0), (2, "a", T0), (3, "a", T0 + dt.timedelta(hours=1))],
                               "id long, k string, t timestamp_ntz")
    got = W.previous_strictly_earlier(df, "k", "t")
    assert rows_of(got, ["id", "prev_ts"]) == [(1, None), (2, None), (3, T0)]


def test_anti_null_aware(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    no_null = spark.createDataFrame([(1,)], "x int")
    with_null = spark.createDataFrame([(1,), (None,)], "x int")
    empty = spark.createDataFrame([], "x int")
    assert rows_of(J.anti_null_aware(left, no_null, "x"), ["x"]) == [(2,)]
    assert J.anti_null_aware(left, with_null, "x").count() == 0
    assert J.anti_null_aware(left, empty, "x").count() == 3


def test_interval_join_bucketed_equals_plain(spark):
    rnd = random.Random(5)
    ev = spark.createDataFrame([(i, f"p{rnd.randrange(5)}", T0 + dt.timedelta(hours=rnd.randrange(24 * 200)))
                                for i in range(800)], "eid long, plate string, t timestamp_ntz")
    iv = []
    for i in range(120):
        s = T0 + dt.timedelta(hours=rnd.randrange(24 * 200))
        e = None if i % 10 == 0 else s + dt.timedelta(hours=rnd.randrange(24 * 60))
        iv.append((i, f"p{rnd.randrange(5)}", s, e))
    ivs = spark.createDataFrame(iv, "iid long, plate string, s timestamp_ntz, e timestamp_ntz")
    a = J.interval_join(ev, ivs, ["plate"], "t", "s", "e", how="left", bucket=None)
    b = J.interval_join(ev, ivs, ["plate"], "t", "s", "e", how="left", bucket="month")
    assert rows_of(a, ["eid", "iid"]) == rows_of(b, ["eid", "iid"])


def test_point_in_polygon_brute_force(spark):
    square = [[{"lon": 0.0, "lat": 0.0}, {"lon": 4.0, "lat": 0.0}, {"lon": 4.0, "lat": 4.0}, {"lon": 0.0, "lat": 4.0}],
              [{"lon": 1.0, "lat": 1.0}, {"lon": 1.0, "lat": 2.0}, {"lon": 2.0, "lat": 2.0}, {"lon": 2.0, "lat": 1.0}]]
    tri = [[{"lon": 4.0, "lat": 0.0}, {"lon": 8.0, "lat": 0.0}, {"lon": 4.0, "lat": 4.0}]]
    polys = spark.createDataFrame([(1, square), (2, tri)], "pid long, rings array<array<struct<lon:double,lat:double>>>")
    pts = [(i, (i % 90) / 10.0, (i * 7 % 50) / 10.0) for i in range(600)]
    df = spark.createDataFrame(pts, "id long, lon double, lat double")
    got = dict(rows_of(points_in_polygons(df, polys, "id", "pid", cell=0.7), ["id", "pid"]))

    def inside(px, py, rings):
        n = 0
        for ring in rings:
            for k in range(len(ring)):
                (x1, y1), (x2, y2) = ring[k], ring[(k + 1) % len(ring)]
                if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                    n += 1
        return n % 2 == 1

    shapes = {1: [[(p["lon"], p["lat"]) for p in r] for r in square], 2: [[(p["lon"], p["lat"]) for p in r] for r in tri]}
    for i, x, y in pts:
        want = [pid for pid, rings in shapes.items() if inside(x, y, rings)]
        assert got[i] == (want[0] if want else None)


def test_grid_size_and_overlap_invariants(spark):
    ent = spark.createDataFrame([("a",), ("b",), ("c",)], "site string")
    g = PO.slot_grid(ent, "20240101", "20240102", 15)
    assert g.count() == 3 * 2 * 96
    s = spark.createDataFrame([(1, T0 + dt.timedelta(minutes=50), T0 + dt.timedelta(hours=3, minutes=10))],
                              "id long, a timestamp_ntz, d timestamp_ntz")
    parts = PO.split_by_hour(s, "a", "d", keep=["id"])
    assert parts.agg(F.sum("overlap_s")).first()[0] == (2 * 3600 + 20 * 60)
    assert parts.count() == 4


def test_running_occupancy_closes(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(300):
        a = dt.datetime(2024, 1, 9, 12) + dt.timedelta(minutes=rnd.randrange(60 * 50))
        d = None if i % 9 == 0 else a + dt.timedelta(minutes=rnd.randrange(1, 600))
        rows.append((i, "s1", f"P{i}", a, d))
    v = spark.createDataFrame(rows, "id long, site string, plate string, a timestamp_ntz, d timestamp_ntz")
    sites = spark.createDataFrame([("s1",)], "site string")
    occ = PO.running_occupancy(v, sites, "site", "plate", "a", "d", "UTC", "20240110", "20240111")
    last = occ.orderBy(F.col("slot").desc()).first()
    tot = occ.agg(F.sum("entries"), F.sum("exits")).first()
    opening = PO.opening_balance(v, "site", "a", "d", "UTC", "20240109").first().opening
    assert last.occupancy == opening + tot[0] - tot[1]


def test_split_rank_lead_first_value(spark):
    df = skewed(spark).withColumn("a", F.when(F.col("v") % 4 == 0, F.col("v").cast("string")))
    for asc in (True, False):
        plain = W.rank_rows(df, "k", "t", ascending=asc, tiebreak="id")
        split = W.rank_rows(df, "k", "t", ascending=asc, tiebreak="id", bucket=F.to_date("t"))
        assert rows_of(plain, ["id", "rn"]) == rows_of(split, ["id", "rn"])
    plain = W.with_next(df, "k", "t", ["v", "a"], tiebreak="id")
    split = W.with_next(df, "k", "t", ["v", "a"], tiebreak="id", bucket=F.to_date("t"))
    assert rows_of(plain, ["id", "next_v", "next_a"]) == rows_of(split, ["id", "next_v", "next_a"])
    plain = W.first_non_null_after(df, "k", ["t", "id"], "a", "fa")
    split = W.first_non_null_after(df, "k", ["t", "id"], "a", "fa", bucket=F.to_date("t"))
    assert rows_of(plain, ["id", "fa"]) == rows_of(split, ["id", "fa"])


def test_split_lag_descending_with_nulls(spark):
    rnd = random.Random(9)
    data = [(i, "hot" if i % 2 else f"d{rnd.randrange(3)}", None if i % 13 == 0 else rnd.randrange(50_000))
            for i in range(3000)]
    df = spark.createDataFrame(data, "id long, k string, s long")
    plain = W.with_previous(df, "k", "s", ["s"], tiebreak="id", descending=True)
    split = W.with_previous(df, "k", "s", ["s"], tiebreak="id", descending=True, bucket=F.floor(F.col("s") / 1000))
    assert rows_of(plain, ["id", "prev_s"]) == rows_of(split, ["id", "prev_s"])


def test_interval_either_bucketed_equals_plain(spark):
    rnd = random.Random(21)
    ev = []
    for i in range(900):
        a = T0 + dt.timedelta(hours=rnd.randrange(24 * 900))
        d = None if i % 11 == 0 else a + dt.timedelta(hours=rnd.randrange(24 * 40))
        ev.append((i, "hot" if i % 3 == 0 else f"p{rnd.randrange(6)}", a, d))
    evs = spark.createDataFrame(ev, "eid long, plate string, a timestamp_ntz, d timestamp_ntz")
    iv = []
    for i in range(150):
        s = T0 + dt.timedelta(hours=rnd.randrange(24 * 900))
        e = None if i % 13 == 0 else s + dt.timedelta(hours=rnd.randrange(24 * 120))
        row = (i, "hot" if i % 2 == 0 else f"p{rnd.randrange(6)}", s, e)
        iv.append(row)
        if i % 17 == 0:
            iv.append((1000 + i,) + row[1:])  # a duplicate interval under another id
    ivs = spark.createDataFrame(iv, "iid long, plate string, s timestamp_ntz, e timestamp_ntz")
    for how in ("inner", "left"):
        plain = J.interval_join_either(ivs, evs, ["plate"], "a", "d", "s", "e", how=how, bucket=None)
        for b in ("month", "year"):
            split = J.interval_join_either(ivs, evs, ["plate"], "a", "d", "s", "e", how=how, bucket=b)
            assert rows_of(plain, ["iid", "eid"]) == rows_of(split, ["iid", "eid"]), (how, b)


def test_either_interval_join_with_null_arrival(spark):
    """An event without arrival is found by its departure, bucketed or not."""
    iv = spark.createDataFrame([("p", T0, T0 + dt.timedelta(days=400))], "k string, s timestamp_ntz, e timestamp_ntz")
    day = dt.timedelta(days=1)
    ev = spark.createDataFrame([("p", None, T0 + 30 * day), ("p", T0 - 700 * day, T0 + 3 * day), ("p", T0 - 9 * day, None)],
                               "k string, a timestamp_ntz, d timestamp_ntz")
    plain = J.interval_join_either(iv, ev, ["k"], "a", "d", "s", "e")
    split = J.interval_join_either(iv, ev, ["k"], "a", "d", "s", "e", bucket="year")
    as_set = lambda df: {(str(r["a"]), str(r["d"])) for r in df.collect()}
    assert as_set(plain) == as_set(split) and plain.count() == split.count() == 2


def test_split_rank_is_wide(spark):
    df = spark.createDataFrame([(1, "a", T0)], "id long, k string, t timestamp_ntz")
    r = W.rank_rows(df, "k", "t", tiebreak="id", bucket=F.to_date("t"))
    assert r.schema["rn"].dataType.simpleString() == "bigint"


def test_device_border_of_global_gap(spark):
    """Devices ascend while numbers descend: the second device's first row is
    compared with the first device's last."""
    df = spark.createDataFrame([("a", 10), ("a", 9), ("b", 5), ("b", 4)], "dev string, seq long")
    got = {(r["dev"], r["seq"]): r["gap"] for r in W.sequence_gaps(df, "dev", "seq").collect()}
    assert got == {("a", 10): None, ("a", 9): -1, ("b", 5): -4, ("b", 4): -1}
