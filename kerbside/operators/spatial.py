"""Point-in-polygon join and polygon centroids as distributed DataFrame jobs.

Spark 4.1 has no usable geometry predicate, so containment is computed
with plain columns:

* a polygon is ``rings: array<array<struct<lon, lat>>>`` (first ring the
  outline, further rings holes; the even-odd rule makes holes work);
* polygon bounding boxes are covered by grid cells (a generator per
  polygon, no cartesian join) and points are equi-joined to polygons on
  their cell, giving candidate pairs;
* polygon edges are exploded onto the y-cells they span, so each
  candidate pair meets only edges that can cross its horizontal ray;
* containment = odd number of crossings of the ray towards +x
  (half-open rule: a point on a shared edge belongs to exactly one side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cell(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(size)).cast("bigint")


def polygon_edges(polys: DataFrame, poly_id: str, rings: str = "rings") -> DataFrame:
    """One row per edge (x1, y1, x2, y2); rings are closed implicitly."""
    r = polys.select(poly_id, F.posexplode(rings).alias("ring_no", "ring"))
    n = F.size("ring")
    e = r.select(poly_id, "ring", F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
    nxt = F.when(F.col("k") + 1 == F.size("ring"), F.lit(0)).otherwise(F.col("k") + 1)
    return e.select(poly_id,
                    F.col("ring")[F.col("k")]["lon"].alias("x1"), F.col("ring")[F.col("k")]["lat"].alias("y1"),
                    F.col("ring")[nxt]["lon"].alias("x2"), F.col("ring")[nxt]["lat"].alias("y2"))


def crosses(px: Column, py: Column) -> Column:
    """Does the ray from (px, py) towards +x cross edge (x1, y1)-(x2, y2)?"""
    x1, y1, x2, y2 = F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")
    straddles = (y1 > py) != (y2 > py)
    x_at = (x2 - x1) * (py - y1) / (y2 - y1) + x1
    return straddles & (px < x_at)


def points_in_polygons(points: DataFrame, polys: DataFrame, point_id: str, poly_id: str,
                       lon: str = "lon", lat: str = "lat", rings: str = "rings",
                       cell: float = 1.0, how: str = "left") -> DataFrame:
    """Points joined to the polygons that contain them (``how='left'`` keeps every point).

    Returns ``point_id, poly_id`` pairs (poly NULL for an uncovered point
    with a left join).  Work is proportional to candidate pairs x edges in
    one y-band, all on executors.
    """
    edges = polygon_edges(polys, poly_id, rings)
    # bounding box cells of each polygon (generator, not a join)
    bb = edges.groupBy(poly_id).agg(F.min("x1").alias("x0"), F.max("x1").alias("x9"),
                                    F.min("y1").alias("y0"), F.max("y1").alias("y9"))
    cells = bb.select(poly_id,
                      F.explode(F.sequence(_cell(F.col("x0"), cell), _cell(F.col("x9"), cell))).alias("cx"),
                      _cell(F.col("y0"), cell).alias("cy0"), _cell(F.col("y9"), cell).alias("cy9"))
    cells = cells.select(poly_id, "cx", F.explode(F.sequence("cy0", "cy9")).alias("cy"))
    pts = points.select(F.col(point_id).alias("__pid"), F.col(lon).alias("__px"), F.col(lat).alias("__py"),
                        _cell(F.col(lon), cell).alias("cx"), _cell(F.col(lat), cell).alias("cy"))
    cand = pts.join(cells, ["cx", "cy"], "inner")
    # edges on every y-cell their y-range touches
    ecell = edges.select(poly_id, "x1", "y1", "x2", "y2",
                         F.explode(F.sequence(_cell(F.least("y1", "y2"), cell),
                                              _cell(F.greatest("y1", "y2"), cell))).alias("cy"))
    hits = (cand.join(ecell, [poly_id, "cy"], "inner")
                .groupBy("__pid", poly_id)
                .agg(F.sum(F.when(crosses(F.col("__px"), F.col("__py")), 1).otherwise(0)).alias("__n"))
                .where(F.col("__n") % 2 == 1)
                .select(F.col("__pid").alias(point_id), poly_id))
    if how == "inner":
        return hits
    return points.select(point_id).join(hits, point_id, "left")


def polygon_centroids(polys: DataFrame, poly_id: str, rings: str = "rings") -> DataFrame:
    """Area-weighted centroid (ST_CENTROID) from the signed shoelace sums over edges.

    Holes must wind opposite to the outline so that their area subtracts.
    """
    e = polygon_edges(polys, poly_id, rings)
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    agg = e.groupBy(poly_id).agg(F.sum(cross).alias("__a2"),
                                 F.sum((F.col("x1") + F.col("x2")) * cross).alias("__cx"),
                                 F.sum((F.col("y1") + F.col("y2")) * cross).alias("__cy"))
    return agg.select(poly_id, (F.col("__cx") / (3 * F.col("__a2"))).alias("centroid_lon"),
                      (F.col("__cy") / (3 * F.col("__a2"))).alias("centroid_lat"),
                      F.abs(F.col("__a2") / 2).alias("area"))
