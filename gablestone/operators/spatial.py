"""Points and footprints: the bucketed spatial join and the summaries that rest on it.

Both sides are dealt to square cells; points meet the buildings of their own cell in an equi-join,
the closed bounding box is checked again, and ray casting runs as one expression over the polygons that
the row carries. A point and a building make one row, however many polygons the building has. Cells of
footprints are broadcast only where their number, worked out before they are made, is small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.functions import geometry as G
from gablestone.operators.quantiles import quantiles

CELL = 16.0
#: Above this number of cells, or of bytes that they carry, boxes are joined by a shuffle on the cell (Spark's own estimate does not see
#: cells): what is broadcast stands in the driver as rows, as a hash table and as blocks.
BROADCAST_CELLS, BROADCAST_BYTES = 200_000, 8_000_000
GROUND, BUILDING, LEGACY_OVERLAP = 2, 6, 12
VEGETATION = (3, 4, 5)


def footprints(edges: DataFrame) -> DataFrame:
    """One row for each polygon: building_id, polygon_id, rings, min_x, min_y, max_x, max_y, area."""
    ring = edges.groupBy("building_id", "polygon_id", "ring_id").agg(
        F.sort_array(F.collect_list(F.struct("edge_id", "x1", "y1", "x2", "y2"))).alias("edges"),
        *[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("x1", "y1")],
    )
    own = ring.groupBy("building_id", "polygon_id").agg(
        F.sort_array(F.collect_list(F.struct("ring_id", "edges"))).alias("rings"), F.min("min_x1").alias("min_x"), F.min("min_y1").alias("min_y"), F.max("max_x1").alias("max_x"), F.max("max_y1").alias("max_y")
    )
    return own.withColumn("area", G.polygon_area(F.col("rings")))


def buffered(prints: DataFrame, margin: float) -> DataFrame:
    """With bounding boxes wider by a margin, as bx1, by1, bx2, by2."""
    return prints.select("*", (F.col("min_x") - margin).alias("bx1"), (F.col("min_y") - margin).alias("by1"), (F.col("max_x") + margin).alias("bx2"), (F.col("max_y") + margin).alias("by2"))


def join_boxes(points: DataFrame, boxes: DataFrame, cell: float = CELL) -> DataFrame:
    """Points in the closed boxes (bx1 .. by2) of a table, with its columns."""
    at = lambda c: F.floor(F.col(c) / cell)
    wide = (at("bx2") - at("bx1") + 1) * (at("by2") - at("by1") + 1)
    carried = F.octet_length(F.to_json(F.struct(*boxes.columns)))
    size = boxes.agg(F.sum(wide).alias("n"), F.sum(wide * carried).alias("bytes")).first()
    small = (size["n"] or 0) <= BROADCAST_CELLS and (size["bytes"] or 0) <= BROADCAST_BYTES
    dealt = boxes.withColumn("cx", F.explode(F.sequence(at("bx1"), at("bx2")))).withColumn("cy", F.explode(F.sequence(at("by1"), at("by2"))))
    met = points.withColumn("cx", at("x")).withColumn("cy", at("y")).join(F.broadcast(dealt) if small else dealt.hint("merge"), ["cx", "cy"])
    return met.where(F.col("x").between(F.col("bx1"), F.col("bx2")) & F.col("y").between(F.col("by1"), F.col("by2"))).drop("cx", "cy")


def buildings(edges: DataFrame) -> DataFrame:
    """One row for each building: building_id, polygons (of their rings), the box around all of them, and area. Rows that are so already stay
    as they are, so that what takes edges also takes buildings."""
    if "polygons" in edges.columns:
        return edges
    box = [f(c).alias(c) for f, c in ((F.min, "min_x"), (F.min, "min_y"), (F.max, "max_x"), (F.max, "max_y"))]
    own = footprints(edges).groupBy("building_id").agg(F.sort_array(F.collect_list(F.struct("polygon_id", "rings"))).alias("polygons"), *box, F.sum("area").alias("area"))
    return own.withColumn("polygons", F.transform("polygons", lambda p: p["rings"]))


def sided(own: DataFrame) -> DataFrame:
    """Buildings with their boxes and their sides as plain numbers (x1, y1, x2, y2), with the number of sides of each ring and of rings of each polygon (parts)."""
    return own.select(
        "building_id", "min_x", "min_y", "max_x", "max_y", F.expr("flatten(transform(flatten(transform(polygons, p -> flatten(transform(p, r -> r.edges)))), e -> array(e.x1, e.y1, e.x2, e.y2)))").alias("sides"),
        F.expr("transform(flatten(polygons), r -> size(r.edges))").alias("rings"), F.expr("transform(polygons, p -> size(p))").alias("parts"),
    )


def in_footprints(points: DataFrame, edges: DataFrame, margin: float = 0.0) -> DataFrame:
    """Points near a building, once for each building, with its columns and whether they are inside one of its polygons."""
    met = join_boxes(points, buffered(buildings(edges), margin))
    # Rays are cast within the building's own box only.
    tight = F.col("x").between(F.col("min_x"), F.col("max_x")) & F.col("y").between(F.col("min_y"), F.col("max_y"))
    return met.withColumn("inside", F.when(tight, G.in_polygons(F.col("polygons"), F.col("x"), F.col("y"))).otherwise(F.lit(False)))


def crop_summary(points: DataFrame, bbox) -> DataFrame:
    """Counts, heights and classes of the points in a box; one row, none where it is empty."""
    min_x, min_y, max_x, max_y = bbox
    if min_x >= max_x or min_y >= max_y:
        raise ValueError("the box has no area")
    area = (max_x - min_x) * (max_y - min_y)
    of = lambda *k: F.count_if(F.col("classification").isin(*k))
    inside = points.where(G.in_bbox(F.col("x"), F.col("y"), bbox))
    p = quantiles(inside.select("z"), [], "z", (0.01, 0.5, 0.95, 0.99)).select(F.col("quantiles").alias("p"))
    out = inside.agg(
        F.count("*").alias("point_count"), F.min("z").alias("z_min"), F.max("z").alias("z_max"),
        of(GROUND).alias("ground_count"), of(*VEGETATION).alias("vegetation_count"), of(BUILDING).alias("building_count"), of(LEGACY_OVERLAP).alias("legacy_overlap_count"), F.sum("overlap_flag").alias("overlap_count"),
    )
    out = out.where("point_count > 0").crossJoin(p).withColumn("area_m2", F.lit(float(area))).withColumn("density_m2", F.col("point_count") / area)
    return out.select("area_m2", "point_count", "density_m2", "z_min", *[F.col("p")[i].alias(n) for i, n in enumerate(("z_p01", "z_p50", "z_p95", "z_p99"))], "z_max", "ground_count", "vegetation_count", "building_count", "legacy_overlap_count", "overlap_count")


def crop_histogram(points: DataFrame, bbox) -> DataFrame:
    """The number of points of each class in a box as one JSON object, keys in the order of the classes."""
    counts = points.where(G.in_bbox(F.col("x"), F.col("y"), bbox)).groupBy("classification").agg(F.count("*").alias("n"))
    entries = F.sort_array(F.collect_list(F.struct("classification", "n")))
    return counts.agg(F.to_json(F.map_from_entries(F.transform(entries, lambda e: F.struct(e["classification"].cast("string"), e["n"])))).alias("class_histogram"))


def quality_flags(summary: DataFrame, minimum_density: float) -> DataFrame:
    """Names of what is wrong with a crop, in a fixed order."""
    checks = [
        ("extreme_elevations", (F.col("z_p01") - F.col("z_min") > 20) | (F.col("z_max") - F.col("z_p99") > 20)), ("legacy_overlap_points", F.col("legacy_overlap_count") > 0),
        ("few_building_points", F.col("building_count") < 100), ("few_ground_points", F.col("ground_count") < 100), ("low_density", F.col("density_m2") < minimum_density),
    ]
    return summary.withColumn("flags", F.array_join(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in checks]), lambda f: f.isNotNull()), ","))


def building_summary(points: DataFrame, edges: DataFrame, context: float = 25.0, keys: tuple = (), inside: DataFrame | None = None) -> DataFrame:
    """Per building: points in its polygons by class, and heights of its roof over the ground of the
    context box. Buildings without ground or roof points have no row. A point counts once, in
    whichever polygon it lies; points that are equal in all columns are several, so keys that tell points apart are not
    needed (the parameter stays for callers that name them). Only points in the building's own
    box meet its rings; of the context, ground points meet boxes alone. inside: the points of the footprints, where they are found already."""
    own = buildings(edges)
    inner = in_footprints(points, own).where("inside") if inside is None else inside
    inner = inner.select("building_id", "z", "classification", F.lit(True).alias("inside"))
    around = join_boxes(points.where(F.col("classification") == GROUND), buffered(own.select("building_id", "min_x", "min_y", "max_x", "max_y"), context))
    near = inner.unionByName(around.select("building_id", "z", "classification", F.lit(False).alias("inside")))
    inside, kind = F.col("inside"), F.col("classification")
    height = lambda when, q: F.percentile(F.when(when, F.col("z")), F.lit(q))
    out = near.groupBy("building_id").agg(
        F.count_if(inside).alias("footprint_points"), F.count_if(inside & (kind != LEGACY_OVERLAP)).alias("usable_points"), F.count_if(inside & (kind == BUILDING)).alias("building_points"),
        F.count_if(inside & kind.isin(*VEGETATION)).alias("vegetation_points"), F.count_if(inside & (kind == LEGACY_OVERLAP)).alias("legacy_overlap_points"), F.count_if(~inside).alias("context_ground_points"),
        height(~inside, 0.5).alias("ground_p50"), height(inside & (kind == BUILDING), 0.5).alias("roof_p50"), height(inside & (kind == BUILDING), 0.95).alias("roof_p95"),
    )
    out = out.where("context_ground_points > 0 and building_points > 0").join(own.select("building_id", F.col("area").alias("footprint_area_m2")).hint("merge"), "building_id")
    return out.select(
        "building_id", "footprint_area_m2", "footprint_points", "usable_points", (F.col("usable_points") / F.col("footprint_area_m2")).alias("usable_density_m2"), "building_points", "vegetation_points", "legacy_overlap_points",
        "context_ground_points", "ground_p50", "roof_p50", "roof_p95", (F.col("roof_p50") - F.col("ground_p50")).alias("height_p50"), (F.col("roof_p95") - F.col("ground_p50")).alias("height_p95"),
    )


def class_histogram(points: DataFrame, edges: DataFrame) -> DataFrame:
    """Points in each building by class."""
    return in_footprints(points, edges).where("inside").groupBy("building_id", "classification").agg(F.count("*").alias("points"))


#: Sides that are looked at in one call.
SIDES = 200_000


def _shifted(shifts: list[float], reach: float, step: float):
    """A function of batches (building_id, x, y, sides, rings, parts) that gives, for each shift along y, a bit for each shift along x: whether
    the point is inside then."""

    def inside(x, y, sides, rings, parts, near):
        import numpy as np

        of = np.repeat(np.arange(len(x)), near)
        x1, y1, x2, y2 = sides.reshape(-1, 4).T
        known = ~(np.isnan(y1) | np.isnan(y2))
        out = np.empty((len(x), len(shifts)), np.int64)
        first_side = np.concatenate([[0], np.cumsum(rings)[:-1]])
        first_ring = np.concatenate([[0], np.cumsum(parts[0])[:-1]])
        first_part = np.concatenate([[0], np.cumsum(parts[1])[:-1]])
        with np.errstate(divide="ignore", invalid="ignore"):
            for k, s in enumerate(shifts):
                ys = (y + s)[of]
                # A border that crosses a point's height at v turns inside and outside for the first shifts along x,
                # those with x + shift < v: a bit for each shift, and one pass over the sides for all of them.
                at = np.flatnonzero(((y1 > ys) != (y2 > ys)) & known)
                v = (x2[at] - x1[at]) * (ys[at] - y1[at]) / (y2[at] - y1[at]) + x1[at]
                low = np.nan_to_num(np.ceil((v - x[of[at]] + reach) / step), nan=0.0).clip(0, len(shifts)).astype(np.int64)
                turned = np.zeros(len(of), np.int64)
                turned[at] = (np.int64(1) << low) - 1
                ring = np.bitwise_xor.reduceat(turned, first_side)
                outer = ring[first_ring].copy()
                ring[first_ring] = 0
                out[:, k] = np.bitwise_or.reduceat(outer & ~np.bitwise_or.reduceat(ring, first_ring), first_part)
        return out

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def numbers(column, kind):
            return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False), column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)

        for b in batches:
            x, y = (b.column(c).to_numpy(zero_copy_only=False) for c in "xy")
            done, found, sides = 0, [], b.column("sides").value_lengths().to_numpy(zero_copy_only=False) // 4
            ends = np.cumsum(sides)
            while done < len(x):
                stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + SIDES)))
                part = b.slice(done, stop - done)
                flat, _ = numbers(part.column("sides"), float)
                rings, _ = numbers(part.column("rings"), np.int64)
                parts, own = numbers(part.column("parts"), np.int64)
                found.append(inside(x[done:stop], y[done:stop], flat, rings, (parts, own), sides[done:stop]))
                done = stop
            if found:
                bits = np.concatenate(found)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1, dtype=np.int32) * len(shifts)), pa.array(bits.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("building_id"), lists], names=["building_id", "bits"])

    return run


def alignment(points: DataFrame, edges: DataFrame, reach: float = 2.0, step: float = 0.5) -> DataFrame:
    """The shift (of 9 x 9) under which the largest share of nearby building points is inside one of the building's
    polygons; of equal shares the first, x outside and y inside; with a warning where the shift is at the limit."""
    n = int(reach / step)
    shifts = [i * step for i in range(-n, n + 1)]
    flat = sided(buildings(edges))
    near = join_boxes(points.where(F.col("classification") == BUILDING).select("x", "y", "classification"), buffered(flat, reach))
    kind = dict(near.dtypes)["building_id"]
    # Most points of a building have one of a few patterns of bits; only patterns are spread out.
    bits = near.select("building_id", "x", "y", "sides", "rings", "parts").mapInArrow(_shifted(shifts, reach, step), f"building_id {kind}, bits array<long>")
    patterns = bits.groupBy("building_id", "bits").agg(F.count("*").alias("n"))
    moved = patterns.select("building_id", "n", F.posexplode("bits").alias("at", "inside"))
    sums = moved.groupBy("building_id", "at").agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.shiftright("inside", i).bitwiseAND(F.lit(1))).alias(f"s{i}") for i in range(len(shifts))])
    each = F.array(*[F.struct(F.lit(s).alias("sx"), (F.col(f"s{i}") / F.col("n")).alias("score")) for i, s in enumerate(shifts)])
    shares = sums.select("building_id", (F.col("at") * step - reach).alias("sy"), F.explode(each).alias("e")).select("building_id", "sy", "e.sx", "e.score")
    best = shares.groupBy("building_id").agg(F.min(F.struct((-F.col("score")).alias("order"), "sx", "sy")).alias("b"))
    return best.select("building_id", (-F.col("b.order")).alias("score"), "b.sx", "b.sy", (F.greatest(F.abs("b.sx"), F.abs("b.sy")) == reach).alias("at_limit"))


def morphology(edges: DataFrame) -> DataFrame:
    """Area, perimeter over all rings, vertices and compactness of each building."""
    own = edges.select("building_id", F.explode("polygons").alias("rings")).withColumn("area", G.polygon_area(F.col("rings"))) if "polygons" in edges.columns else footprints(edges)
    own = own.withColumn("around", G.perimeter(F.col("rings"))).withColumn("vertices", F.aggregate(F.transform("rings", lambda r: F.size(r["edges"])), F.lit(0), lambda a, b: a + b))
    out = own.groupBy("building_id").agg(F.sum("area").alias("area_m2"), F.sum("around").alias("perimeter_m"), F.sum("vertices").alias("vertices"))
    return out.withColumn("compactness", G.compactness(F.col("area_m2"), F.col("perimeter_m")))


def grid_cells(boxes: DataFrame, buffer: float = 0.0, size: float = 1000.0, zone: int = 30) -> DataFrame:
    """The catalogue cells that each box (min_x .. max_y) touches, half-open; a cell is named by its
    western and northern edge. A box without width on a border has none."""
    first = lambda c: F.floor((F.col(c) - buffer) / size)
    last = lambda c: F.ceil((F.col(c) + buffer) / size) - 1
    found = boxes.select("building_id", first("min_x").alias("e1"), last("max_x").alias("e2"), first("min_y").alias("n1"), last("max_y").alias("n2")).where("e2 >= e1 and n2 >= n1")
    found = found.withColumn("easting_km", F.explode(F.sequence("e1", "e2"))).withColumn("northing_km", F.explode(F.sequence("n1", "n2")))
    return found.select("building_id", "easting_km", "northing_km", F.format_string(f"%d-%d-H{zone}", F.col("easting_km"), F.col("northing_km") + 1).alias("cell_id"))
