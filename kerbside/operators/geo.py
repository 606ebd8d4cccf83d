"""Areas from text, containment and centroids on the sphere, and an adaptive quadtree join of points and polygons.

* :func:`wkt_rings` reads POLYGON and MULTIPOLYGON text into ring arrays with
  higher-order functions (no parser on the driver, no UDF).
* On the sphere an edge is a great circle.  A point is inside if the meridian
  from it to the north pole crosses an odd number of edges; edges are taken
  the short way round, so areas may lie across the date line.  Areas that
  hold a pole are not supported.
* :func:`points_in_areas` joins points to polygons over a quadtree that is
  deep where points and edges are many: a cell is split while its points
  times its edges exceed ``work``.  A cell that no edge of a polygon enters
  lies wholly inside or outside it and needs no edge test; in the others a
  point is compared with the edges *in its cell* only, along a path to a place
  of the cell whose side is known.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators.ranges import spread, stored
from kerbside.operators.spatial import points_in_polygons, polygon_edges

#: Point-edge tests of one cell from which it is split, and the deepest level (4^LEVELS cells).
WORK, LEVELS = 20_000_000, 14
#: Slabs of longitude that the edges on the sphere are dealt to.
SLABS = 4096


def wkt_rings(text: str | Column) -> Column:
    """Rings (array of arrays of (lon, lat)) of POLYGON or MULTIPOLYGON text, the closing point dropped; NULL for other text."""
    t = F.col(text) if isinstance(text, str) else text
    known = F.upper(F.trim(t)).rlike(r"^(MULTI)?POLYGON\s*\(")
    number = r"[-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?"

    def ring(r: Column) -> Column:
        pts = F.transform(F.split(r, ","), lambda p: F.struct(
            F.regexp_extract(p, rf"({number})\s+({number})", 1).cast("double").alias("lon"),
            F.regexp_extract(p, rf"({number})\s+({number})", 2).cast("double").alias("lat")))
        closed = (F.size(pts) > 1) & (F.element_at(pts, 1) == F.element_at(pts, -1))
        return F.when(closed, F.slice(pts, 1, F.size(pts) - 1)).otherwise(pts)

    return F.when(known, F.transform(F.regexp_extract_all(t, F.lit(r"\(([^()]+)\)"), F.lit(1)), ring))


def turn(a: Column, b: Column) -> Column:
    """Degrees from longitude ``a`` to ``b`` the short way, in [-180, 180)."""
    return F.pmod(b - a + 180, F.lit(360.0)) - 180


def meridian_crossing(px: Column, py: Column, x1="x1", y1="y1", x2="x2", y2="y2") -> Column:
    """Does the meridian from (px, py) to the north pole cross the great-circle edge (x1, y1)-(x2, y2)?"""
    x1, y1, x2, y2 = (F.col(c) for c in (x1, y1, x2, y2))
    span, at = turn(x1, x2), turn(x1, px)
    # half-open in longitude, as seen from the first end
    hit = F.when(span > 0, (at >= 0) & (at < span)).when(span < 0, (at < 0) & (at >= span)).otherwise(F.lit(False))
    t1, t2 = F.tan(F.radians(y1)), F.tan(F.radians(y2))
    lat = F.degrees(F.atan(F.try_divide(t1 * F.sin(F.radians(span - at)) + t2 * F.sin(F.radians(at)), F.sin(F.radians(span)))))
    return hit & (lat > py)


def sphere_centroids(areas: DataFrame, area_id: str, rings: str = "rings") -> DataFrame:
    """Centroid on the sphere: the direction of the area's vector moment, half the sum over the edges of the
    angle of each edge times the normal of its great circle.  Holes wind against the outline."""
    e = polygon_edges(areas, area_id, rings)

    def unit(x: str, y: str) -> list[Column]:
        lon, lat = F.radians(x), F.radians(y)
        return [F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)]

    a, b = unit("x1", "y1"), unit("x2", "y2")
    n = [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
    size = F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2])
    angle = F.atan2(size, a[0] * b[0] + a[1] * b[1] + a[2] * b[2])
    w = F.when(size > 0, F.try_divide(angle, size)).otherwise(0.0)
    m = e.groupBy(area_id).agg(*[F.sum(n[i] * w).alias(f"m{i}") for i in range(3)], *[F.sum(a[i]).alias(f"a{i}") for i in range(3)])
    # the smaller side is the area, whichever way its rings run
    side = F.when(F.col("m0") * F.col("a0") + F.col("m1") * F.col("a1") + F.col("m2") * F.col("a2") < 0, -1.0).otherwise(1.0)
    x, y, z = (F.col(f"m{i}") * side for i in range(3))
    return m.select(area_id, F.degrees(F.atan2(y, x)).alias("centroid_lon"), F.degrees(F.atan2(z, F.sqrt(x * x + y * y))).alias("centroid_lat"))


def points_on_sphere(points: DataFrame, areas: DataFrame, point_id: str, area_id: str, lon: str = "lon", lat: str = "lat",
                     rings: str = "rings", how: str = "left", slabs: int = SLABS) -> DataFrame:
    """Points joined to the areas on the sphere that contain them: ``point_id, area_id``.

    One equi-join on the slab of longitude and one count per (point, area); an edge stands in the slabs it
    spans the short way round, an edge along a meridian in none, as no meridian crosses it.
    """
    width = 360.0 / slabs

    def slab(x: Column) -> Column:
        return F.floor((x + 180) / F.lit(width)).cast("int")

    e = polygon_edges(areas, area_id, rings)
    first, span = slab(F.pmod(F.col("x1") + 180, F.lit(360.0)) - 180), turn(F.col("x1"), F.col("x2"))
    last = slab(F.pmod(F.col("x1") + 180, F.lit(360.0)) - 180 + span)
    # each slab once, also where few wide slabs wrap round
    spanned = F.array_distinct(F.transform(F.sequence(F.least(first, last), F.greatest(first, last)), lambda v: F.pmod(v, F.lit(slabs))))
    e = e.where(span != 0).select(area_id, "x1", "y1", "x2", "y2", F.explode(spanned).alias("s"))
    p = points.select(F.col(point_id).alias("__pid"), F.col(lon).alias("__px"), F.col(lat).alias("__py")) \
        .withColumn("s", F.pmod(slab(F.pmod(F.col("__px") + 180, F.lit(360.0)) - 180), F.lit(slabs)))
    hits = p.join(e, "s").where(meridian_crossing(F.col("__px"), F.col("__py"))).groupBy("__pid", area_id) \
        .agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1").select(F.col("__pid").alias(point_id), area_id)
    return hits if how == "inner" else points.select(point_id).join(hits, point_id, "left")


class _Planar:
    """Straight edges in the plane of lon and lat; a path runs sideways, then up or down."""

    @staticmethod
    def sideways(px, py, qx) -> Column:
        x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
        at = F.try_divide((x2 - x1) * (py - y1), y2 - y1) + x1
        return ((y1 > py) != (y2 > py)) & ((px < at) != (qx < at))

    @staticmethod
    def upward(px, py, qy) -> Column:
        x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
        at = F.try_divide((y2 - y1) * (px - x1), x2 - x1) + y1
        return ((x1 > px) != (x2 > px)) & ((py < at) != (qy < at))

    @classmethod
    def path(cls, px, py, qx, qy) -> Column:
        """Parity of crossings from (px, py) over (qx, py) to (qx, qy)."""
        return (F.when(cls.sideways(px, py, qx), 1).otherwise(0) + F.when(cls.upward(qx, py, qy), 1).otherwise(0)).cast("int")


# the known place of a cell: no round share, so that no edge or corner of real data runs through it
_AT_X, _AT_Y = 0.4142135623730951, 0.7320508075688772


def _interleave(x: Column, y: Column, level: int) -> Column:
    out = F.lit(0).cast("long")
    for b in range(level):
        out = out.bitwiseOR(F.shiftleft(F.shiftright(x, b).bitwiseAND(1), 2 * b)).bitwiseOR(F.shiftleft(F.shiftright(y, b).bitwiseAND(1), 2 * b + 1))
    return out


def cover(points: DataFrame, edges: DataFrame, poly_id: str, box: tuple[float, float, float], work: int = WORK, levels: int = LEVELS,
          keep: Callable = stored) -> tuple[DataFrame, DataFrame]:
    """The quadtree: leaves (level, cell, poly, inside) and the edges of each leaf (level, cell, poly, x1, y1, x2, y2).

    ``box`` is (x0, y0, side); ``points`` holds ``__cell``, the cell at the deepest level.  A leaf's ``inside`` says
    whether its known place is inside the polygon.  Cells at the deepest level are not split further.
    """
    x0, y0, side = box
    spark = edges.sparkSession
    counts = keep(points.groupBy("__cell").agg(F.count(F.lit(1)).alias("n")), "cells")
    qx, qy = F.lit(x0 + side * _AT_X), F.lit(y0 + side * _AT_Y)
    # the root: each polygon's side of the root's place by a ray to +x, over all its edges
    ray = F.when(((F.col("y1") > qy) != (F.col("y2") > qy))
                 & (qx < F.try_divide((F.col("x2") - F.col("x1")) * (qy - F.col("y1")), F.col("y2") - F.col("y1")) + F.col("x1")), 1).otherwise(0)
    leaf = edges.groupBy(poly_id).agg((F.sum(ray) % 2 == 1).alias("inside")).select(F.lit(0).cast("long").alias("cx"), F.lit(0).cast("long").alias("cy"), poly_id, "inside")
    at = edges.select(F.lit(0).cast("long").alias("cx"), F.lit(0).cast("long").alias("cy"), poly_id, "x1", "y1", "x2", "y2")
    leaves, kept = [], []
    for level in range(levels + 1):
        here = F.lit(level).alias("level")
        cell = _interleave(F.col("cx"), F.col("cy"), level).alias("cell")
        n = counts.groupBy(F.shiftright("__cell", 2 * (levels - level)).alias("cell")).agg(F.sum("n").alias("points"))
        size = at.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("edges"))
        heavy = size.select("cx", "cy", "edges", cell).join(n, "cell").where(F.col("points") * F.col("edges") > work).select("cx", "cy")
        heavy = keep(heavy, "heavy") if level < levels else spark.createDataFrame([], heavy.schema)
        if not heavy.head(1):
            leaves.append(leaf.select(here, cell, poly_id, "inside"))
            kept.append(at.select(here, cell, poly_id, "x1", "y1", "x2", "y2"))
            break
        # what stays at this level: light cells, and polygons that no longer have an edge in a heavy one
        edged = at.select("cx", "cy", poly_id).distinct()
        split = leaf.join(heavy, ["cx", "cy"]).join(edged, ["cx", "cy", poly_id])
        leaves.append(leaf.join(split.select("cx", "cy", poly_id), ["cx", "cy", poly_id], "left_anti").select(here, cell, poly_id, "inside"))
        kept.append(at.join(heavy, ["cx", "cy"], "left_anti").select(here, cell, poly_id, "x1", "y1", "x2", "y2"))
        child = side / 2 ** (level + 1)
        quads = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])).alias("q")
        place = lambda c, k, o, a: F.lit(o) + (F.col(c) + a) * F.lit(k)
        # a child's place: from its parent's along the parent's edges
        kids = split.select("cx", "cy", poly_id, "inside", quads).select(
            "cx", "cy", poly_id, "inside", (F.col("cx") * 2 + F.col("q.i")).alias("kx"), (F.col("cy") * 2 + F.col("q.j")).alias("ky"))
        steps = _Planar.path(place("kx", child, x0, _AT_X), place("ky", child, y0, _AT_Y), place("cx", 2 * child, x0, _AT_X), place("cy", 2 * child, y0, _AT_Y))
        moved = kids.join(at, ["cx", "cy", poly_id]).groupBy("kx", "ky", poly_id, "inside").agg((F.sum(steps) % 2 == 1).alias("odd"))
        leaf = moved.select(F.col("kx").alias("cx"), F.col("ky").alias("cy"), poly_id, (F.col("inside") != F.col("odd")).alias("inside"))
        down = at.join(heavy, ["cx", "cy"]).select(poly_id, "x1", "y1", "x2", "y2", quads, "cx", "cy").select(
            (F.col("cx") * 2 + F.col("q.i")).alias("cx"), (F.col("cy") * 2 + F.col("q.j")).alias("cy"), poly_id, "x1", "y1", "x2", "y2")
        lo = lambda c, o: F.lit(o) + F.col(c) * F.lit(child)
        touches = (F.greatest("x1", "x2") >= lo("cx", x0)) & (F.least("x1", "x2") <= lo("cx", x0) + child) & \
                  (F.greatest("y1", "y2") >= lo("cy", y0)) & (F.least("y1", "y2") <= lo("cy", y0) + child)
        at = keep(down.where(touches), "edges")
        leaf = keep(leaf, "leaves")
    both = [None, None]
    for k, parts in enumerate((leaves, kept)):
        for p in parts:
            both[k] = p if both[k] is None else both[k].unionByName(p)
    # a leaf that no edge enters and whose place is outside can't hold a point
    return both[0].join(both[1].select("level", "cell", poly_id).distinct().withColumn("edged", F.lit(True)), ["level", "cell", poly_id], "left") \
        .withColumn("edged", F.coalesce("edged", F.lit(False))).where("inside OR edged"), both[1]


def points_in_areas(points: DataFrame, polys: DataFrame, point_id: str, poly_id: str, lon: str = "lon", lat: str = "lat",
                    rings: str = "rings", how: str = "left", work: int = WORK, levels: int = LEVELS) -> DataFrame:
    """Points joined to the polygons (straight edges, even-odd rule) that contain them: ``point_id, poly_id``.

    A point on a border belongs to the side that the half-open ray test gives it.  ``left`` keeps points
    without a polygon, and those without coordinates; equal polygon ids are one polygon.
    """
    edges = polygon_edges(polys, poly_id, rings)
    b = edges.agg(F.min("x1"), F.min("y1"), F.max("x1"), F.max("y1"), F.count(F.lit(1))).first()
    if b[0] is None:
        none = points.select(point_id, F.lit(None).cast(polys.schema[poly_id].dataType).alias(poly_id))
        return none if how == "left" else none.where("false")
    n = points.count()
    if n * b[4] <= work:  # one cell would do
        return points_in_polygons(points, polys, point_id, poly_id, lon, lat, rings, how=how)
    edges = stored(edges.where(F.col(poly_id).isNotNull()), "polygon-edges")
    side = max(b[2] - b[0], b[3] - b[1]) * 1.0000001 or 1.0
    x0, y0, cells = b[0], b[1], 2 ** levels
    inside_box = F.col(lon).between(x0, x0 + side) & F.col(lat).between(y0, y0 + side)

    def index(c: str, o: float) -> Column:
        return F.least(F.floor((F.col(c) - o) / side * cells).cast("long"), F.lit(cells - 1))

    pts = spread(points.where(inside_box).select(F.col(point_id).alias("__pid"), F.col(lon).alias("__px"), F.col(lat).alias("__py"),
                                          _interleave(index(lon, x0), index(lat, y0), levels).alias("__cell")), n, "__pid")
    leaves, leaf_edges = cover(pts, edges, poly_id, (x0, y0, side), work, levels)
    leaves, leaf_edges = stored(leaves, "cover"), stored(leaf_edges, "cover-edges")
    # the levels in use: at most levels + 1 values
    used = [r["level"] for r in leaves.select("level").distinct().collect()]
    at = pts.select("*", F.explode(F.array(*[F.lit(v) for v in sorted(used)] or [F.lit(0)])).alias("level")) \
        .withColumn("cell", F.expr(f"shiftright(__cell, 2 * ({levels} - level))"))
    # one mark a leaf that tells the side of its place, and one an edge
    marks = leaves.select("level", "cell", poly_id, F.col("inside").cast("int").alias("side")) \
        .unionByName(leaf_edges, allowMissingColumns=True)
    # the deepest level's coordinates give back the leaf's known place
    unit = F.lit(side) / F.pow(F.lit(2.0), F.col("level"))
    qx, qy = (F.lit(o) + (F.floor((F.col(p) - F.lit(o)) / unit) + a) * unit for o, p, a in ((x0, "__px", _AT_X), (y0, "__py", _AT_Y)))
    odd = F.coalesce("side", _Planar.path(F.col("__px"), F.col("__py"), F.col("__qx"), F.col("__qy")))
    # the points are dealt by their id, and so are the counts
    hits = at.withColumns({"__qx": qx, "__qy": qy}).join(marks, ["level", "cell"]) \
        .groupBy("__pid", poly_id).agg((F.sum(odd) % 2 == 1).alias("odd")).where("odd").select(F.col("__pid").alias(point_id), poly_id)
    return hits if how == "inner" else spread(points.select(point_id), n, point_id).join(hits, point_id, "left")
