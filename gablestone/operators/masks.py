"""Masks in long form (object_id, row, col; row 0 is the northern one): scaling, clipping, outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.functions import geometry as G
from gablestone.operators.spatial import buildings

#: Quality flags of detected objects.
REDUCED, NOT_CLIPPED = "DISCONNECTED_COMPONENTS_REDUCED_TO_LARGEST", "NOT_CLIPPED_TO_FOOTPRINT"
PIXELS = ["row", "col"]


def binary(values: DataFrame, least: float = 0.5) -> DataFrame:
    """The pixels of soft masks (object_id, row, col, value) that count."""
    return values.where(F.col("value") >= least).select("object_id", *PIXELS)


def resized(mask: DataFrame, shape: tuple[int, int], target: tuple[int, int]) -> DataFrame:
    """A mask on a grid of another shape (rows, columns): each new pixel takes the old one under its
    centre."""

    def spread(c: str, old: int, new: int):
        around = F.sequence(F.floor(F.col(c) * new / old) - 1, F.ceil((F.col(c) + 1) * new / old) + 1)
        return F.explode(F.filter(around, lambda r: (r >= 0) & (r < new) & (F.floor((2 * r + 1) * old / (2 * new)) == F.col(c))))

    rows = mask.withColumn("row_", spread("row", shape[0], target[0])).withColumn("col_", spread("col", shape[1], target[1]))
    return rows.select("object_id", F.col("row_").cast("long").alias("row"), F.col("col_").cast("long").alias("col"))


def areas(mask: DataFrame, pixel_x: float, pixel_y: float) -> DataFrame:
    """Pixels of each object, and their area; objects without a pixel have no row."""
    return mask.groupBy("object_id").agg(F.count("*").alias("pixel_area")).withColumn("area_m2", F.col("pixel_area") * abs(pixel_x * pixel_y))


def footprint_pixels(edges: DataFrame, grids: DataFrame) -> DataFrame:
    """Pixels whose centre is in the footprint, of north-up grids (building_id, west, north, pixel,
    height, width)."""
    cells = grids.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("height") - 1))).withColumn("col", F.explode(F.sequence(F.lit(0).cast("long"), F.col("width") - 1)))
    cells = cells.withColumn("x", F.col("west") + (F.col("col") + 0.5) * F.col("pixel")).withColumn("y", F.col("north") - (F.col("row") + 0.5) * F.col("pixel"))
    hit = cells.join(buildings(edges).select("building_id", "polygons"), "building_id").where(G.in_polygons(F.col("polygons"), F.col("x"), F.col("y")))
    return hit.select("building_id", *PIXELS)


def clipped(mask: DataFrame, objects: DataFrame, pixels: DataFrame) -> DataFrame:
    """Masks within the footprint of their object's building (objects: object_id, building_id)."""
    return mask.join(objects.select("object_id", "building_id"), "object_id").join(pixels, ["building_id", *PIXELS], "left_semi").select("object_id", *PIXELS)


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def both(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, a.columns, "left_semi")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, a.columns, "left_anti")


def outlines(mask: DataFrame, west: float, north: float, pixel: float) -> DataFrame:
    """(object_id, part, area_m2, rings): the outline of each 4-connected region, its outer ring first
    (counter-clockwise, closed), then its holes. A mask is one object's; regions are numbered from the
    north-western pixel on."""

    def trace(pdf):
        import pandas as pd

        own = {(int(r), int(c)) for r, c in pdf[["row", "col"]].itertuples(index=False)}
        rows, left = [], set(own)
        for start in sorted(own):
            if start not in left:
                continue
            left.discard(start)
            region, stack = {start}, [start]
            while stack:
                r, c = stack.pop()
                for near in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                    if near in left:
                        left.discard(near)
                        region.add(near)
                        stack.append(near)
            rings = _rings(region)
            place = lambda p: {"x": west + p[1] * pixel, "y": north - p[0] * pixel}
            rows.append((pdf["object_id"].iloc[0], len(rows), len(region) * pixel * pixel, [[place(p) for p in ring] for ring in rings]))
        return pd.DataFrame(rows, columns=["object_id", "part", "area_m2", "rings"])

    kind = dict(mask.dtypes)["object_id"]
    return mask.groupBy("object_id").applyInPandas(trace, f"object_id {kind}, part int, area_m2 double, rings array<array<struct<x: double, y: double>>>")


def _rings(region: set) -> list[list[tuple[int, int]]]:
    """Closed rings of corner points (row, column) around a region, the outer one first; the region is
    to the left of each side, and sides in line are one."""
    onward: dict[tuple, list] = {}
    for r, c in region:
        for near, a, b in (((r - 1, c), (r, c + 1), (r, c)), ((r, c - 1), (r, c), (r + 1, c)), ((r + 1, c), (r + 1, c), (r + 1, c + 1)), ((r, c + 1), (r + 1, c + 1), (r, c + 1))):
            if near not in region:
                onward.setdefault(a, []).append(b)
    found = []
    while onward:
        first = min(onward)
        ring, at, came = [first], first, None
        while True:
            ways = onward[at]
            if len(ways) > 1 and came is not None:  # two pixels meet at a corner only: stay with one's own
                step = (at[0] - came[0], at[1] - came[1])
                ways.sort(key=lambda b: step[0] * (b[1] - at[1]) - step[1] * (b[0] - at[0]))
                to = ways.pop()
            else:
                to = ways.pop()
            if not ways:
                del onward[at]
            came, at = at, to
            if at == first:
                break
            ring.append(at)
        turns = [p for k, p in enumerate(ring) if (ring[k - 1][0] - p[0]) * (ring[(k + 1) % len(ring)][1] - p[1]) != (ring[k - 1][1] - p[1]) * (ring[(k + 1) % len(ring)][0] - p[0])]
        found.append([*turns, turns[0]])
    size = lambda ring: sum(a[1] * b[0] - b[1] * a[0] for a, b in zip(ring, ring[1:]))
    return sorted(found, key=lambda ring: -abs(size(ring)))


def largest_part(parts: DataFrame) -> DataFrame:
    """The largest outline of each object, of equal ones the first, and whether others were dropped."""
    best = parts.groupBy("object_id").agg(F.max_by(F.struct("area_m2", "rings"), F.struct("area_m2", (-F.col("part")).alias("order"))).alias("b"), F.count("*").alias("n"))
    return best.select("object_id", "b.area_m2", "b.rings", F.when(F.col("n") > 1, F.array(F.lit(REDUCED))).otherwise(F.array().cast("array<string>")).alias("quality_flags"))


def collection(objects: DataFrame, crs: str = "EPSG:25830") -> DataFrame:
    """(building_id, value): one feature collection with its coordinate system for each building.
    objects: building_id, object_id, class_name, confidence, area_m2, rings."""
    feature = F.struct(
        F.lit("Feature").alias("type"), F.col("object_id").cast("string").alias("id"), F.struct(F.lit("Polygon").alias("type"), F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))).alias("coordinates")).alias("geometry"),
        F.struct("class_name", "confidence", "area_m2").alias("properties"),
    )
    rows = objects.groupBy("building_id").agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col("object_id").alias("k"), F.to_json(feature).alias("j")))), lambda x: x["j"]).alias("features"))
    head = f'{{"type":"FeatureCollection","name":"roof_objects","crs":{{"type":"name","properties":{{"name":"{crs}"}}}},"features":['
    return rows.select("building_id", F.concat(F.lit(head), F.array_join("features", ","), F.lit("]}")).alias("value"))
