"""Planar geometry as Column expressions over arrays of directed edges (x1, y1, x2, y2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_bbox(x: Column, y: Column, bbox) -> Column:
    """Closed on all four sides."""
    min_x, min_y, max_x, max_y = bbox
    return x.between(min_x, max_x) & y.between(min_y, max_y)


def in_ring(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd ray casting: left and lower borders are inside, right and upper ones are not."""

    def crosses(e):
        at = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
        return F.coalesce(((e["y1"] > y) != (e["y2"] > y)) & (x < at), F.lit(False))

    return F.aggregate(edges, F.lit(False), lambda inside, e: inside != crosses(e))


def in_polygon(rings: Column, x: Column, y: Column) -> Column:
    """Inside the first ring and in none of the others. rings: array of (ring_id, edges) in order."""
    outer = in_ring(rings[0]["edges"], x, y)
    holes = F.exists(F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0))), lambda r: in_ring(r["edges"], x, y))
    return outer & ~holes


def in_polygons(polygons: Column, x: Column, y: Column) -> Column:
    """Inside one of several polygons."""
    return F.exists(polygons, lambda rings: in_polygon(rings, x, y))


def ring_area(edges: Column) -> Column:
    """Shoelace area of a closed ring."""
    return F.abs(F.aggregate(edges, F.lit(0.0), lambda a, e: a + e["x1"] * e["y2"] - e["x2"] * e["y1"])) / 2


def polygon_area(rings: Column) -> Column:
    """The first ring's area less those of the others."""
    areas = F.transform(rings, lambda r: ring_area(r["edges"]))
    return 2 * areas[0] - F.aggregate(areas, F.lit(0.0), lambda a, b: a + b)


def perimeter(rings: Column) -> Column:
    """Over all rings, holes too."""
    length = lambda e: F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"])
    return F.aggregate(F.flatten(F.transform(rings, lambda r: F.transform(r["edges"], length))), F.lit(0.0), lambda a, b: a + b)


def compactness(area: Column, around: Column) -> Column:
    """4 pi A / P^2, within 0 and 1."""
    return F.least(F.greatest(4 * F.pi() * area / (around * around), F.lit(0.0)), F.lit(1.0))


def bbox_iou(a, b) -> Column:
    """Intersection over union of two boxes (min_x, min_y, max_x, max_y); 0 where the union is empty."""
    width = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    height = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    both = width * height
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def clip01(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
