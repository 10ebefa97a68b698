"""Quality of point clouds: outliers, spacing, neighbourhoods, local planes, roof planes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablestone.operators.samples import sampled
from gablestone.operators.shared import cut


#: Fixed value: text of a warning.
PLANES_REACHED = "plane limit reached with points left"


def outlier_ratio(points: DataFrame, key: str = "building_id") -> DataFrame:
    """Share of heights more than six robust deviations from the median; where the deviation is zero,
    the share that differs from it; NULL below three points."""
    mid = points.groupBy(key).agg(F.percentile("z", F.lit(0.5)).alias("mid"), F.count("*").alias("n"))
    off = points.select(key, "z").join(mid.hint("merge"), key).withColumn("off", F.abs(F.col("z") - F.col("mid")))
    mad = off.groupBy(key).agg(F.percentile("off", F.lit(0.5)).alias("mad"))
    bad = F.when(F.col("mad") == 0, F.col("off") > 0).otherwise(F.col("off") / F.nullif(1.4826 * F.col("mad"), F.lit(0.0)) > 6)
    out = off.join(mad.hint("merge"), key).groupBy(key, "n").agg(F.avg(bad.cast("int")).alias("ratio"))
    return out.select(key, F.when(F.col("n") >= 3, F.col("ratio")).alias("outlier_ratio"))


def _around(points: DataFrame, size: float, own: str) -> DataFrame:
    """Each point in its cell and in the eight around it."""
    near = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    cell = points.withColumn("cx", F.floor(F.col("x") / size)).withColumn("cy", F.floor(F.col("y") / size))
    if own == "one":
        return cell
    return cell.withColumn("d", F.explode(F.array(*near))).withColumn("cx", F.col("cx") + F.col("d.i")).withColumn("cy", F.col("cy") + F.col("d.j")).drop("d")


def neighbours(points: DataFrame, radius: float, keys: list[str], group: str = "building_id", some: DataFrame | None = None) -> DataFrame:
    """Pairs of points (or of some of them, with all) of a group within a radius in the plane, each with itself too: the point's keys,
    the other's x, y, z and the distance. Cells of the radius' size meet in an equi-join."""
    a = _around(points if some is None else some, radius, "all").select(group, *keys, "x", "y", "cx", "cy")
    b = _around(points, radius, "one").select(group, "cx", "cy", *[F.col(k).alias(f"o_{k}") for k in keys], *[F.col(c).alias(f"o_{c}") for c in "xyz"])
    gap = F.hypot(F.col("x") - F.col("o_x"), F.col("y") - F.col("o_y"))
    return a.join(b, [group, "cx", "cy"]).withColumn("gap", gap).where(F.col("gap") <= radius).drop("cx", "cy")


def _extent(points: DataFrame, group: str) -> DataFrame:
    """The longest distance in the plane that two points of a group can have."""
    return cut(points.groupBy(group).agg(F.hypot(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("extent")))


def _placed(points: DataFrame, axes: str) -> DataFrame:
    """Points whose place is known and finite."""
    return points.where(" and ".join(f"abs(cast({c} as double)) < double('infinity')" for c in axes))


def spacing(points: DataFrame, keys: list[str], group: str = "building_id", start: float = 1.0, sample: int | None = None) -> DataFrame:
    """Median and 90 % quantile of the distance to the nearest other point, over all points, or among a sample of so many
    a group. Points without one in reach are looked at again with twice the reach, against all, up to the group's extent."""
    points = _placed(points, "xy")
    points = cut(sampled(points, [group], keys, sample) if sample else points)
    other = reduce(lambda p, q: p | q, [F.col(k) != F.col(f"o_{k}") for k in keys])
    todo, done, r, extent = points, None, start, _extent(points, group).hint("merge")
    while True:
        near = cut(neighbours(points, r, keys, group, todo).where(other).groupBy(group, *keys).agg(F.min("gap").alias("gap")))
        done = near if done is None else done.union(near)
        # A little more than the extent, so that rounding leaves no pair out.
        todo = cut(todo.join(near.select(group, *keys).hint("merge"), [group, *keys], "left_anti").join(extent.where(F.col("extent") * 1.001 > r).select(group), group, "left_semi"))
        if todo.isEmpty():
            break
        r *= 2
    return done.groupBy(group).agg(F.percentile("gap", F.lit(0.5)).alias("spacing_p50"), F.percentile("gap", F.lit(0.9)).alias("spacing_p90"))


def roof_observations(points: DataFrame, keys: list[str], group: str = "building_id", radius: float = 1.5, minimum: int = 4, below: float = 0.75, sample: int | None = None) -> DataFrame:
    """Points (or a sample of so many a group) with whether each is kept: it has few neighbours, or is not far below their 80 % quantile."""
    points = cut(sampled(points, [group], keys, sample)) if sample else points
    local = neighbours(points, radius, keys, group).groupBy(group, *keys).agg(F.count("*").alias("around"), F.percentile("o_z", F.lit(0.8)).alias("p80"))
    return points.join(local, [group, *keys]).withColumn("kept", (F.col("around") < minimum) | (F.col("z") >= F.col("p80") - below)).select(group, *keys, "around", "kept")


def local_planes(points: DataFrame, keys: list[str], group: str = "building_id", k: int = 16, radius: float = 4.0, residual: float = 0.20, planarity: float = 0.30, sample: int | None = None) -> DataFrame:
    """Share of points whose k nearest (itself included, in space) lie on a plane, and the median
    residual: the square root of the least eigenvalue of their covariance. Neighbours are looked for
    within a radius in the plane, twice that for points whose k-th is farther, and so on up to the
    group's extent; ties go by key. With a sample, planes are those around so many points a group; neighbours are all points."""
    points = cut(_placed(points, "xyz").select(group, *keys, "x", "y", "z"))
    todo, done, r, extent = cut(sampled(points, [group], keys, sample)) if sample else None, None, radius, _extent(points, group).hint("merge")
    while True:
        near = cut(_planes_around(points, todo, keys, group, k, r, residual, planarity))
        unsure = near.where("left is not null").join(extent, group)
        for found in (near.where("left is null"), unsure.where(F.col("extent") * 1.001 <= r)):
            found = found.where("n >= 3").select(group, "residual", "flat")
            done = found if done is None else done.union(found)
        left = unsure.where(F.col("extent") * 1.001 > r).select(group, "left.*")
        if left.isEmpty():
            break
        todo = cut((points if todo is None else todo).join(left, [group, *keys], "left_semi"))
        r *= 2
    return done.groupBy(group).agg(F.avg(F.col("flat").cast("int")).alias("planar_support"), F.percentile("residual", F.lit(0.5)).alias("residual_p50"))


#: Pairs of points that are looked at in one call.
PAIRS = 400_000


def _planes_around(points: DataFrame, todo: DataFrame | None, keys: list[str], group: str, k: int, r: float, residual: float, planarity: float) -> DataFrame:
    """group, n, residual and flat of the plane through the nearest k of each point of todo (None: of all), among those within r in the plane; and its
    keys (left) where it has fewer. A group is dealt to tiles of eight times r; points within r of a tile's border are in both."""
    size, reach = 8 * r, r * (1 + 1e-6)
    across = lambda c: F.explode(F.sequence(F.floor((F.col(c) - reach) / size), F.floor((F.col(c) + reach) / size)))
    home = lambda c: F.floor(F.col(c) / size)
    rows = points.withColumn("tx_", across("x")).withColumn("ty_", across("y"))
    if todo is None:
        rows = rows.withColumn("own_", (F.col("tx_") == home("x")) & (F.col("ty_") == home("y"))).withColumn("other_", F.lit(True))
    else:
        todo = todo.withColumn("tx_", home("x")).withColumn("ty_", home("y"))
        rows = rows.join(todo.select(group, "tx_", "ty_").distinct(), [group, "tx_", "ty_"], "left_semi").select(*todo.columns, F.lit(False).alias("own_"), F.lit(True).alias("other_"))
        rows = rows.unionByName(todo.withColumn("own_", F.lit(True)).withColumn("other_", F.lit(False)))

    def planes(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        # Candidates stand in the order of their keys, so that the first of equally far ones has the least.
        table = table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in keys], null_placement="at_start"))
        x, y, z, own, other = (table[c].to_numpy() for c in ("x", "y", "z", "own_", "other_"))
        at, (ox, oy, oz), out = np.flatnonzero(own), (v[other] for v in (x, y, z)), []
        step = max(1, PAIRS // max(1, len(ox)))
        for i in (at[s : s + step] for s in range(0, len(at), step)):
            dx, dy = x[i][:, None] - ox, y[i][:, None] - oy
            dx *= dx
            dy *= dy
            dx += dy
            # A tenth or so of the pairs lie within reach in the plane; only those are looked at in space.
            row, col = np.nonzero(dx <= r * r * (1 + 1e-9))
            flat = dx[row, col]
            near, edge = flat <= r * r, np.abs(flat - r * r) <= 1e-9 * r * r
            near[edge] = np.hypot(x[i][row[edge]] - ox[col[edge]], y[i][row[edge]] - oy[col[edge]]) <= r
            row, col, flat = row[near], col[near], flat[near]
            dz = oz[col] - z[i][row]
            count = np.bincount(row, minlength=len(i))
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            space = np.full((len(i), max(1, int(count.max(initial=0)))), np.inf)
            space[row, place] = np.sqrt(flat + dz * dz)
            last = np.partition(space, k - 1, axis=1)[:, k - 1] if space.shape[1] >= k else np.full(len(i), np.inf)
            taken, tied = space < last[:, None], (space == last[:, None]) & (space < np.inf)
            taken |= tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= (k - taken.sum(1))[:, None])
            picked = taken[row, place]
            row, col = row[picked], col[picked]
            n = np.bincount(row, minlength=len(i))
            first = np.concatenate([[0], np.cumsum(n)[:-1]])
            p = np.stack([ox[col] - x[i][row], oy[col] - y[i][row], dz[picked]])
            p -= (np.add.reduceat(p, first, axis=1) / n)[:, row]
            m = np.stack([np.stack([np.add.reduceat(a * b, first) / n for b in p], -1) for a in p], -1)
            low, mid, high = np.clip(np.linalg.eigvalsh(m), 0, None).T
            with np.errstate(divide="ignore", invalid="ignore"):
                flat = (np.sqrt(low) <= residual) & (high != 0) & ((mid - low) / high >= planarity)
            out.append((n, np.sqrt(low), flat, last <= r))
        n, low, flat, sure = (np.concatenate(v) if out else np.empty(0, t) for v, t in zip(zip(*out) if out else [()] * 4, (np.int64, float, bool, bool)))
        mine = table.take(pa.array(at))
        keep = [mine[c].combine_chunks() for c in keys]
        left = pa.StructArray.from_arrays(keep, names=keys, mask=pa.array(sure)) if len(at) else pa.array([], pa.struct([(c, v.type) for c, v in zip(keys, keep)]))
        return pa.table({group: mine[group].combine_chunks(), "n": pa.array(n), "residual": pa.array(low), "flat": pa.array(flat), "left": left})

    kinds = dict(points.dtypes)
    schema = f"{group} {kinds[group]}, n long, residual double, flat boolean, left struct<{', '.join(f'{c}: {kinds[c]}' for c in keys)}>"
    return rows.groupBy(group, "tx_", "ty_").applyInArrow(planes, schema)


#: Gaps between points and candidate planes that are looked at in one call.
GAPS = 1_000_000


def roof_planes(points: DataFrame, keys: list[str], group: str = "building_id", sample: int | None = None, trials: int = 200, planes: int = 8, threshold: float = 0.20, seed: int = 42) -> DataFrame:
    """Planes found one after the other in each group's points: the triple (of three different points) with most points
    within the threshold, refitted by principal axes. Groups are buildings; all points of one meet in a task, which compares them with
    the candidates block by block (with a sample, only so many a group are looked at). The aspect is the direction, clockwise from north, that the upward normal leans against (uphill). A plane has its
    centroid, its offset along the normal, the share of the points that supports it, and warnings."""

    def detect(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        rng = np.random.default_rng(seed)
        own = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in keys])
        xyz = np.stack([table[c].to_numpy()[own.to_numpy()] for c in "xyz"], -1)
        least, rest, rows = max(30, int(np.ceil(0.05 * len(xyz)))), xyz, []
        while len(rows) < planes and len(rest) >= least:
            n = len(rest)
            first, second, third = (rng.integers(0, n - k, trials) for k in range(3))
            second += second >= first
            third += third >= np.minimum(first, second)
            third += third >= np.maximum(first, second)
            a, b, c = rest[first], rest[second], rest[third]
            normal = np.cross(b - a, c - a)
            size = np.linalg.norm(normal, axis=1)
            ok = size > 1e-9
            if not ok.any():
                break
            normal = normal[ok] / size[ok, None]
            offset, step, counts, bits = (a[ok] * normal).sum(1), max(1, GAPS // trials), 0, []
            for s in range(0, n, step):
                near = np.abs(rest[s : s + step] @ normal.T - offset) <= threshold
                counts += near.sum(0)
                # A bit for each candidate: a point takes no more room for them than for its place.
                bits.append(np.packbits(near, axis=1))
            best = int(np.argmax(counts))
            inside = rest[np.concatenate([b[:, best // 8] >> (7 - best % 8) & 1 for b in bits]).astype(bool)]
            if len(inside) < least:
                break
            centre = inside.mean(0)
            n = np.linalg.svd(inside - centre, full_matrices=False)[2][-1]
            n = -n if n[2] < 0 else n
            gap = np.abs((rest - centre) @ n)
            taken = gap <= threshold
            if taken.sum() < least:
                break
            flat = np.hypot(n[0], n[1])
            rows.append((len(rows), int(taken.sum()), *n.tolist(), float(np.degrees(np.arccos(np.clip(n[2], -1, 1)))), None if flat < 1e-8 else float((np.degrees(np.arctan2(-n[0], -n[1])) + 360) % 360), float(np.median(gap[taken])), float(np.percentile(gap[taken], 95)), *centre.tolist(), float(centre @ n), float(taken.sum() / len(xyz))))
            rest = rest[~taken]
        explained, warning = sum(r[1] for r in rows) / max(1, len(xyz)), PLANES_REACHED if len(rows) == planes and len(rest) >= least else None
        names = ["plane", "support", "nx", "ny", "nz", "slope_deg", "aspect_deg", "median_m", "p95_m", "cx", "cy", "cz", "offset", "support_ratio"]
        kinds = [pa.int32(), pa.int64()] + [pa.float64()] * 12
        columns = {c: pa.array([r[i] for r in rows], kind) for i, (c, kind) in enumerate(zip(names, kinds))}
        first = {group: pa.array([table[group][0].as_py()] * len(rows), pa.int64())}
        return pa.table(first | columns | {"explained": pa.array([explained] * len(rows), pa.float64()), "warnings": pa.array([warning] * len(rows), pa.string())})

    schema = f"{group} long, plane int, support long, nx double, ny double, nz double, slope_deg double, aspect_deg double, median_m double, p95_m double, cx double, cy double, cz double, offset double, support_ratio double, explained double, warnings string"
    points = _placed(points, "xyz").select(group, *keys, "x", "y", "z")
    return (sampled(points, [group], keys, sample, seed) if sample else points).groupBy(group).applyInArrow(detect, schema)


def dominant_normals(planes: DataFrame, group: str = "building_id", degrees: float = 10.0) -> DataFrame:
    """Number of directions among a group's planes: from the best supported on, a plane within the
    angle of an earlier direction adds none."""
    order = F.sort_array(F.collect_list(F.struct((-F.col("support")).alias("s"), "plane", "nx", "ny", "nz")))
    near = lambda d, p: F.abs(d["nx"] * p["nx"] + d["ny"] * p["ny"] + d["nz"] * p["nz"]) >= F.cos(F.radians(F.lit(degrees)))
    merged = F.aggregate("p", F.slice("p", 1, 0), lambda found, p: F.when(F.exists(found, lambda d: near(d, p)), found).otherwise(F.concat(found, F.array(p))))
    return planes.groupBy(group).agg(order.alias("p")).select(group, F.size(merged).alias("dominant_normals"))


def nearest_plane(points: DataFrame, planes: DataFrame, keys: list[str], group: str = "building_id") -> DataFrame:
    """The plane of its group that each point lies closest to, and how far from it; the first of equal
    ones. planes: group, plane, nx, ny, nz and the offset of the plane along its normal."""
    gap = F.abs(F.col("x") * F.col("nx") + F.col("y") * F.col("ny") + F.col("z") * F.col("nz") - F.col("offset"))
    met = points.join(planes.select(group, "plane", "nx", "ny", "nz", "offset"), group)
    best = met.groupBy(group, *keys).agg(F.min(F.struct(gap.alias("distance"), "plane")).alias("b"))
    return best.select(group, *keys, "b.plane", "b.distance")


def colour_limits(rows: DataFrame, value: str, group: str = "building_id", low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Robust limits of a colour scale: two quantiles of each group's values."""
    q = F.percentile(value, F.array(F.lit(low), F.lit(high)))
    return rows.groupBy(group).agg(q.alias("q")).select(group, F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))
