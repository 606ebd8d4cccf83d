"""Text areas, spherical containment and centroids, and the quadtree join against the plain even-odd test."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kerbside.operators import geo as G
from kerbside.operators.spatial import points_in_polygons, polygon_edges

RINGS = "id int, rings array<array<struct<lon:double,lat:double>>>"


@pytest.fixture(scope="module")
def polys(spark):
    """A square with a hole, a triangle, a ragged ring of 400 edges, a concave shape; corners on the points' grid."""
    r = random.Random(1)
    ragged = [(5 + (2 + r.random()) * math.cos(a), 5 + (2 + r.random()) * math.sin(a)) for a in (2 * math.pi * i / 400 for i in range(400))]
    shapes = [(1, [[(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (1, 3), (3, 3), (3, 1)]]), (2, [[(0, 6), (4, 6), (2, 10)]]), (3, [ragged]),
              (4, [[(6, 0), (10, 0), (10, 4), (8, 1), (6, 4)]])]
    return spark.createDataFrame([(i, [[(float(x), float(y)) for x, y in g] for g in s]) for i, s in shapes], RINGS)


@pytest.fixture(scope="module")
def points(spark):
    """A third of the points at one place, many on edges and corners, some outside the box, one without a place."""
    r = random.Random(2)
    rows = [(i, 4.9, 7.3) if i % 3 == 0 else (i, r.randrange(-2, 122) / 10, r.randrange(-2, 122) / 10) for i in range(3000)]
    return spark.createDataFrame([(i, float(x), float(y)) for i, x, y in rows] + [(9999, None, 1.0)], "pid int, lon double, lat double")


@pytest.mark.parametrize("work,levels", [(10**9, 14), (2000, 14), (300, 6), (1, 3)])
def test_quadtree_equals_even_odd(points, polys, work, levels):
    got = sorted((r.pid, -1 if r.id is None else r.id) for r in G.points_in_areas(points, polys, "pid", "id", work=work, levels=levels).collect())
    want = sorted((r.pid, -1 if r.id is None else r.id) for r in points_in_polygons(points, polys, "pid", "id").collect())
    assert got == want


def test_cells_split_where_points_and_edges_meet(points, polys):
    pts = points.where("lon BETWEEN 0 AND 10 AND lat BETWEEN 0 AND 10")
    cell = G._interleave(F.floor(F.col("lon") / 16 * 2 ** 8).cast("long"), F.floor(F.col("lat") / 16 * 2 ** 8).cast("long"), 8)
    leaves, edges = G.cover(pts.withColumn("__cell", cell), polygon_edges(polys, "id"), "id", (0.0, 0.0, 16.0), 500, 8)
    deep = {r["level"] for r in leaves.select("level").distinct().collect()}
    assert len(deep) > 2 and leaves.where("NOT edged AND inside").count() > 0
    work = edges.groupBy("level", "cell").agg(F.count(F.lit(1)).alias("e")).where("level < 8")
    for r in work.collect():
        k = pts.where(F.shiftright(cell, 2 * (8 - r["level"])) == r["cell"]).count() if r["e"] > 200 else 0
        assert k * r["e"] <= 500


def test_no_polygons(points, polys):
    assert G.points_in_areas(points, polys.where("false"), "pid", "id").where("id IS NULL").count() == points.count()
    assert G.points_in_areas(points, polys.where("false"), "pid", "id", how="inner").count() == 0
    assert G.points_in_areas(points.where("false"), polys, "pid", "id").count() == 0


def test_area_text(spark):
    rows = [("POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 3, 3 3, 3 1, 1 1))",), ("MULTIPOLYGON (((170 -1, -170 -1, -170 1.5e0, 170 1)), ((0 0,1 0,1 1)))",),
            ("POINT(1 2)",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(G.wkt_rings("t")).collect()]
    assert [len(g) if g else None for g in got] == [2, 2, None, None]
    assert [tuple(p) for p in got[0][1]] == [(1, 1), (1, 3), (3, 3), (3, 1)] and [tuple(p) for p in got[1][0]] == [(170, -1), (-170, -1), (-170, 1.5), (170, 1)]


def test_sphere_across_the_date_line(spark):
    """Containment by crossings equals a winding test with vectors; the area spans 170 E to 170 W."""
    ring = [(170.0, -20.0), (-170.0, -20.0), (-165.0, 10.0), (-170.0, 30.0), (170.0, 30.0)]
    area = spark.createDataFrame([(1, [ring])], RINGS)
    r = random.Random(5)
    pts = [(i, r.uniform(-180, 180) if i % 2 else (r.uniform(165, 198) + 180) % 360 - 180, r.uniform(-40, 45)) for i in range(800)]
    e = polygon_edges(area, "id")
    df = spark.createDataFrame(pts, "pid int, lon double, lat double")
    got = {x.pid for x in df.join(e, F.lit(True)).groupBy("pid").agg(
        F.sum(F.when(G.meridian_crossing(F.col("lon"), F.col("lat")), 1).otherwise(0)).alias("n")).where("n % 2 = 1").collect()}
    for slabs in (1, 7, 4096):
        assert {x.pid for x in G.points_on_sphere(df, area, "pid", "id", how="inner", slabs=slabs).collect()} == got

    def unit(lon, lat):
        lon, lat = math.radians(lon), math.radians(lat)
        return (math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat))

    def angle(p, a, b):
        dot = lambda u, v: sum(x * y for x, y in zip(u, v))
        cross = lambda u, v: (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])
        u, v = cross(p, a), cross(p, b)
        return math.atan2(dot(p, cross(u, v)), dot(u, v))

    want = set()
    for i, lon, lat in pts:
        p, vs = unit(lon, lat), [unit(*x) for x in ring]
        if abs(sum(angle(p, vs[k], vs[(k + 1) % len(vs)]) for k in range(len(vs)))) > math.pi and sum(x * y for x, y in zip(p, vs[0])) > 0:
            want.add(i)
    assert got == want and len(want) > 50


def test_sphere_centroid(spark):
    square = [(179.0, -1.0), (-179.0, -1.0), (-179.0, 1.0), (179.0, 1.0)]
    area = spark.createDataFrame([(1, [square]), (2, [square[::-1]]), (3, [[(10.0, 50.0), (10.2, 50.0), (10.2, 50.1), (10.0, 50.1)]])], RINGS)
    got = {r.id: (r.centroid_lon, r.centroid_lat) for r in G.sphere_centroids(area, "id").collect()}
    for i in (1, 2):
        assert abs(abs(got[i][0]) - 180) < 1e-9 and abs(got[i][1]) < 1e-9
    assert abs(got[3][0] - 10.1) < 1e-6 and abs(got[3][1] - 50.05) < 1e-3


def test_points_are_dealt_by_rows(spark, points, polys, monkeypatch):
    """However few bytes they take, no task gets many of the points."""
    from kerbside.operators import ranges as R
    monkeypatch.setattr(R, "TASK_ROWS", 200)
    got = G.points_in_areas(points, polys, "pid", "id", work=2000)
    per = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per) >= 3001 and max(per) < 600


def test_quadtree_with_repeated_points(points, polys):
    """A repeated point id counts the crossings of all its rows, at any size."""
    twice = points.unionByName(points.where("pid % 4 = 0")).unionByName(points.where("pid % 8 = 0").withColumn("lon", F.col("lon") + 1))
    got = sorted((r.pid, -1 if r.id is None else r.id) for r in G.points_in_areas(twice, polys, "pid", "id", work=500).collect())
    want = sorted((r.pid, -1 if r.id is None else r.id) for r in points_in_polygons(twice, polys, "pid", "id").collect())
    assert got == want
