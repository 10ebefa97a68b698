"""Grids in long form: one row for each cell; row 0 is the southern one; NULL where there is nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gablestone.operators.overlay import spread
from gablestone.operators.spatial import BUILDING, buildings, in_footprints, sided


#: Cells that are looked at in one call.
CELLS = 1_000_000


def footprint_cells(edges: DataFrame, resolution: float) -> DataFrame:
    """Cells of each building's grid whose centre is in its footprint. Buildings are few bytes beside their cells, so they are
    dealt out by their number; a task walks the rows of one grid after the other, in blocks."""
    own = sided(buildings(edges))
    kind = dict(own.dtypes)["building_id"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for i, ox, oy, cols, rows, shape in _grids(b, resolution):
                ids, step = b.column("building_id").slice(i, 1), max(1, CELLS // cols)
                cx = ox + (np.arange(cols) + 0.5) * resolution
                for first in range(0, rows, step):
                    row = np.arange(first, min(rows, first + step))
                    cy = oy + (row + 0.5) * resolution
                    at, col = np.nonzero(_inside(cx, cy, *shape))
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(np.zeros(n, np.int64))), pa.array(row[at]), pa.array(col), pa.array(np.full(n, ox)), pa.array(np.full(n, oy)), pa.array(cx[col]), pa.array(cy[at])], names=["building_id", "row", "col", "ox", "oy", "cx", "cy"]
                    )

    return spread(own).mapInArrow(run, f"building_id {kind}, row long, col long, ox double, oy double, cx double, cy double")


def _grids(b, resolution: float):
    """Of each building of a batch that has a box: its place, the corner and size of its grid, and its sides, rings and parts."""
    import numpy as np

    for i, (ox, oy, ux, uy) in enumerate(zip(*[b.column(c).to_pylist() for c in ("min_x", "min_y", "max_x", "max_y")])):
        if None not in (ox, oy, ux, uy):
            shape = np.array(b.column("sides")[i].as_py(), float).reshape(-1, 4), *(np.array(b.column(c)[i].as_py(), np.int64) for c in ("rings", "parts"))
            yield i, ox, oy, *(max(1, int(np.ceil((high - low) / resolution))) for low, high in ((ox, ux), (oy, uy))), shape


def _inside(cx, cy, sides, rings, parts):
    """Whether the points of a grid (rows cy, columns cx) are in one of the polygons: as geometry.in_polygons, side by side."""
    import numpy as np

    found, ring, side = np.zeros((len(cy), len(cx)), bool), 0, 0
    for n in parts:
        polygon = np.zeros_like(found)
        for k in range(n):
            odd = np.zeros_like(found)
            for x1, y1, x2, y2 in sides[side : side + rings[ring]]:
                # Without a number a side is not crossed.
                at = np.flatnonzero((y1 > cy) != (y2 > cy)) if y1 == y1 and y2 == y2 else []
                if len(at):
                    odd[at] ^= cx < ((x2 - x1) * (cy[at] - y1) / (y2 - y1) + x1)[:, None]
            side, ring = side + rings[ring], ring + 1
            polygon = polygon & ~odd if k else odd
        found |= polygon
    return found


def _placed(points: DataFrame, edges: DataFrame, resolution: float, placed: bool = False) -> DataFrame:
    """Building points in the footprint with their cells. placed: points are those of the footprints already, with the
    corner (ox, oy) of their building."""
    roof = points.where(F.col("classification") == BUILDING) if placed else in_footprints(points.where(F.col("classification") == BUILDING), edges).where("inside").select("building_id", "x", "y", "z", F.col("min_x").alias("ox"), F.col("min_y").alias("oy"))
    return roof.withColumn("row", F.floor((F.col("y") - F.col("oy")) / resolution)).withColumn("col", F.floor((F.col("x") - F.col("ox")) / resolution))


def occupancy(points: DataFrame, edges: DataFrame, resolution: float, placed: bool = False, regions: bool = True) -> DataFrame:
    """Of each building's footprint cells: how many there are, how many hold a building point, and (with regions) the size of the
    largest 4-connected region of those that hold none. Grids are bounded by the building; each is looked at in one call, and
    only cells with points are shuffled."""
    held = _placed(points, edges, resolution, placed).select("building_id", "row", "col").distinct().groupBy("building_id").agg(F.collect_list(F.struct("row", "col")).alias("held"))
    own = sided(buildings(edges)).join(held.hint("merge"), "building_id", "left")
    kind = dict(own.dtypes)["building_id"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            found = []
            for i, ox, oy, cols, rows, shape in _grids(b, resolution):
                inside = _inside(ox + (np.arange(cols) + 0.5) * resolution, oy + (np.arange(rows) + 0.5) * resolution, *shape)
                n = int(inside.sum())
                if not n:
                    continue
                cells = b.column("held")[i].values
                if cells is not None:
                    row, col = (cells.field(c).to_numpy(zero_copy_only=False) for c in ("row", "col"))
                    ok = (row >= 0) & (row < rows) & (col >= 0) & (col < cols)
                    inside[row[ok], col[ok]] = False
                found.append((i, n, n - int(inside.sum()), _largest(inside) if regions else None))
            i, n, occupied, largest = zip(*found) if found else [()] * 4
            yield pa.RecordBatch.from_arrays([b.column("building_id").take(pa.array(i, pa.int64())), *[pa.array(v, pa.int64()) for v in (n, occupied, largest)]], names=["building_id", "footprint_cells", "occupied_cells", "largest_empty_cells"])

    return spread(own).mapInArrow(run, f"building_id {kind}, footprint_cells long, occupied_cells long, largest_empty_cells long")


def _largest(free) -> int:
    """The number of cells of the largest 4-connected region."""
    import numpy as np

    # A border of cells that are not free keeps the ends of rows apart.
    wide = free.shape[1] + 1
    left, best = set(np.flatnonzero(np.pad(free, ((0, 0), (0, 1)))).tolist()), 0
    while left:
        stack, n = [left.pop()], 0
        while stack:
            at, n = stack.pop(), n + 1
            for near in (at + 1, at - 1, at + wide, at - wide):
                if near in left:
                    left.remove(near)
                    stack.append(near)
        best = max(best, n)
    return best


def coverage(points: DataFrame, edges: DataFrame, resolution: float, placed: bool = False) -> DataFrame:
    """Footprint cells, those with a building point, and their share."""
    return occupancy(points, edges, resolution, placed, regions=False).select("building_id", "footprint_cells", "occupied_cells", (F.col("occupied_cells") / F.col("footprint_cells")).alias("coverage"))


def interpolated(values: Column, fraction: float) -> Column:
    """The quantile of an array's values between its two neighbours in order: lo * (1 - d) + hi * d, where the first product is added
    unrounded (as a fused multiply-add does), so that steps between cells are those of the checking engine; NULL where there are none."""
    own = F.sort_array(values)
    at = (F.size(values) - 1) * F.lit(fraction)
    lo, hi, d = F.get(own, F.floor(at).cast("int")), F.get(own, F.ceil(at).cast("int")), at - F.floor(at)

    def fused(v):
        a, b, c = v["lo"], 1 - v["d"], v["hi"] * v["d"]
        high = lambda x: x * 134217729.0 - (x * 134217729.0 - x)
        product, total = a * b, a * b + c
        lost = ((high(a) * high(b) - product) + high(a) * (b - high(b)) + (a - high(a)) * high(b)) + (a - high(a)) * (b - high(b))
        part = total - product
        return F.when(v["d"] == 0, a).otherwise(F.nanvl(total + (((product - (total - part)) + (c - part)) + lost), total))

    return F.transform(F.array(F.struct(lo.alias("lo"), hi.alias("hi"), d.alias("d"))), fused)[0]


def height_raster(points: DataFrame, edges: DataFrame, resolution: float, percentile: float = 0.9, placed: bool = False) -> DataFrame:
    """Percentile of the heights and number of points in each footprint cell; NULL height where there
    is none."""
    seen = _placed(points, edges, resolution, placed).groupBy("building_id", "row", "col").agg(F.collect_list("z").alias("all"), F.count("*").alias("points"))
    seen = seen.select("building_id", "row", "col", interpolated(F.col("all"), percentile).alias("height"), "points")
    cells = footprint_cells(edges, resolution).join(seen.hint("merge"), ["building_id", "row", "col"], "left")
    return cells.select("building_id", "row", "col", "cx", "cy", "height", F.coalesce("points", F.lit(0)).alias("points"))


def empty_regions(points: DataFrame, edges: DataFrame, resolution: float, placed: bool = False) -> DataFrame:
    """The largest 4-connected region of footprint cells without a point, as a share of the footprint."""
    return occupancy(points, edges, resolution, placed).select("building_id", "largest_empty_cells", (F.col("largest_empty_cells") / F.col("footprint_cells")).alias("hole_ratio"))


def normalized(raster: DataFrame, terrain: DataFrame, terrain_cell: float, keys: tuple = ("trow", "tcol")) -> DataFrame:
    """Heights above the terrain cell that holds each cell's centre. Terrain rows count from its origin
    (tx, ty) at the south-west."""
    cells = raster.join(terrain.groupBy("building_id").agg(F.min("tx").alias("tx0"), F.min("ty").alias("ty0")).hint("merge"), "building_id")
    cells = cells.withColumn(keys[0], F.floor((F.col("cy") - F.col("ty0")) / terrain_cell)).withColumn(keys[1], F.floor((F.col("cx") - F.col("tx0")) / terrain_cell))
    met = cells.join(terrain.select("building_id", *keys, "elevation").hint("merge"), ["building_id", *keys], "left")
    return met.select("building_id", "row", "col", "height", "elevation", (F.col("height") - F.col("elevation")).alias("above_ground"))


def height_metrics(raster: DataFrame, resolution: float, value: str = "height", threshold: float = 1.0, digits: int | None = None) -> DataFrame:
    """Of differences between neighbouring cells that both have a value: how many, gradient quantiles,
    and the share of steps of at least a threshold. With digits, differences are rounded first, so that a step of just the
    threshold counts however its two heights came about."""
    cells = raster.where(F.col(value).isNotNull())
    along = Window.partitionBy("building_id", "row").orderBy("col")
    across = Window.partitionBy("building_id", "col").orderBy("row")
    step = lambda w, c: F.when(F.col(c) - F.lag(c).over(w) == 1, F.abs(F.col(value) - F.lag(value).over(w)))
    steps = cells.select("building_id", step(along, "col").alias("a"), step(across, "row").alias("b"))
    steps = steps.select("building_id", F.explode(F.array("a", "b")).alias("d")).where("d is not null")
    if digits is not None:
        steps = steps.withColumn("d", F.round("d", digits))
    return steps.groupBy("building_id").agg(
        F.count("*").alias("pairs"), F.percentile(F.col("d") / resolution, F.lit(0.5)).alias("gradient_p50"), F.percentile(F.col("d") / resolution, F.lit(0.95)).alias("gradient_p95"),
        F.avg((F.col("d") >= threshold).cast("int")).alias("discontinuity_ratio"),
    )


def resolution_agreement(fine: DataFrame, coarse: DataFrame, fine_cell: float, coarse_cell: float) -> DataFrame:
    """Medians of fine cells in each coarse cell against its own value."""
    if fine_cell >= coarse_cell:
        raise ValueError("the fine grid must be finer")
    at = lambda c: F.floor((F.col(c) + 0.5) * fine_cell / coarse_cell)
    inner = fine.where("height is not null").select("building_id", at("row").alias("row"), at("col").alias("col"), "height")
    inner = inner.groupBy("building_id", "row", "col").agg(F.percentile("height", F.lit(0.5)).alias("fine"))
    own = coarse.where("height is not null").select("building_id", "row", "col", "height").join(inner, ["building_id", "row", "col"], "left")
    error = F.abs(F.col("fine") - F.col("height"))
    return own.groupBy("building_id").agg(
        F.count("fine").alias("joint_cells"), F.avg(error).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"), F.percentile(error, F.lit(0.95)).alias("p95"), (F.count("fine") / F.count("*")).alias("overlap")
    )
