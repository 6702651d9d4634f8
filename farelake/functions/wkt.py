"""Zone centroids from WKT text with built-in expressions.

Not a WKT parser: a ring is what the ring pattern matches, which needs a decimal
point in every coordinate. Rings under three points are dropped; holes count as
rings. The centroid is the plain mean of all kept vertices; null when none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the ring pattern of the reference's zone map.
RING_PATTERN = r"\((-?\d+\.\d+\s+-?\d+\.\d+(?:\s*,\s*-?\d+\.\d+\s+-?\d+\.\d+)*)\)"


def rings(wkt: Column) -> Column:
    """array<array<struct<x,y>>>: kept rings of a WKT text (empty for null)."""
    texts = F.regexp_extract_all(F.coalesce(wkt, F.lit("")), F.lit(RING_PATTERN), 1)

    def points(ring: Column) -> Column:
        parts = F.transform(F.split(ring, ","), lambda p: F.split(F.trim(p), r"\s+"))
        parts = F.filter(parts, lambda a: F.size(a) >= 2)
        return F.transform(parts, lambda a: F.struct(a[0].cast("double").alias("x"),
                                                    a[1].cast("double").alias("y")))

    return F.filter(F.transform(texts, points), lambda r: F.size(r) >= 3)


def centroid(wkt: Column) -> Column:
    """struct<lon, lat, n_rings, n_points>; lon/lat null without points."""
    rs = rings(wkt)
    pts = F.flatten(rs)
    n = F.size(pts)
    sx = F.aggregate(pts, F.lit(0.0), lambda acc, p: acc + p["x"])
    sy = F.aggregate(pts, F.lit(0.0), lambda acc, p: acc + p["y"])
    return F.struct(
        F.when(n > 0, F.round(sx / n, 6)).alias("lon"),
        F.when(n > 0, F.round(sy / n, 6)).alias("lat"),
        F.size(rs).alias("n_rings"),
        n.alias("n_points"))
