"""Small cases worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from gablestone.functions import geometry, projection, text
from gablestone.operators import benchmarks, cloud_quality, decisions, evidence, meshes, rasters, spatial

EDGES = "building_id long, polygon_id long, ring_id long, edge_id long, x1 double, y1 double, x2 double, y2 double"
POINTS = "building_id long, k long, x double, y double, z double, classification long, overlap_flag long"


def ring(corners, building=1, polygon=0, number=0):
    return [(building, polygon, number, i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(corners, corners[1:] + corners[:1]))]


def square(low, high, **kw):
    return ring([(low, low), (high, low), (high, high), (low, high)], **kw)


def cloud(spark, rows):
    return spark.createDataFrame([(1, i, float(x), float(y), float(z), c, 0) for i, (x, y, z, c) in enumerate(rows)], POINTS)


def test_a_hole_is_outside(spark):
    edges = spark.createDataFrame(square(0, 10) + square(4, 6, number=1), EDGES)
    found = spatial.in_footprints(cloud(spark, [(2, 2, 0, 6), (5, 5, 0, 6), (12, 5, 0, 6), (0, 0, 0, 6), (10, 10, 0, 6)]), edges.drop("none"), 5.0)
    assert {r.k: r.inside for r in found.select("k", "inside").collect()} == {0: True, 1: False, 2: False, 3: True, 4: False}
    assert spatial.footprints(edges).first().area == 96


def test_crop_summary(spark):
    points = cloud(spark, [(0, 0, 2, 2), (1, 1, 8, 6), (5, 5, 12, 5), (10, 10, 20, 1)])
    r = spatial.crop_summary(points, (-1.0, -1.0, 6.0, 6.0)).first()
    assert (r.point_count, r.z_min, r.z_p50, r.z_max, r.overlap_count) == (3, 2, 8, 12, 0) and r.z_p95 == pytest.approx(11.6) and r.density_m2 == pytest.approx(3 / 49)
    assert spatial.crop_summary(points, (50.0, 50.0, 60.0, 60.0)).count() == 0
    with pytest.raises(ValueError):
        spatial.crop_summary(points, (1.0, 0.0, 1.0, 5.0))


def test_building_summary(spark):
    points = cloud(spark, [(1, 1, 20, 6), (2, 2, 22, 6), (3, 3, 24, 12), (8, 8, 10, 2), (9, 9, 12, 2)]).drop("building_id")
    r = spatial.building_summary(points, spark.createDataFrame(square(0, 5), EDGES), 5.0, ("k",)).first()
    assert (r.footprint_area_m2, r.footprint_points, r.usable_points, r.building_points, r.ground_p50, r.roof_p50, r.height_p50) == (25, 3, 2, 2, 11, 21, 10)


def test_several_polygons_count_a_point_once(spark):
    edges = spark.createDataFrame(square(0, 5) + square(4, 9, polygon=1), EDGES)
    points = cloud(spark, [(4.5, 4.5, 20, 6), (8, 8, 22, 6), (1, 8, 10, 2)]).drop("building_id")
    r = spatial.building_summary(points, edges, 5.0, ("k",)).first()
    assert (r.footprint_area_m2, r.footprint_points, r.building_points) == (50, 2, 2)


def test_quality_of_a_small_roof(spark):
    edges = spark.createDataFrame(square(0, 4), EDGES)
    points = cloud(spark, [(0.5, 0.5, 10, 6), (1.5, 0.5, 10.1, 6), (2.5, 0.5, 10.2, 6), (3.5, 0.5, 30, 6), (6, 6, 0, 2)])
    assert rasters.coverage(points.drop("building_id"), edges, 1.0).first().coverage == 0.25
    assert rasters.coverage(points.drop("building_id"), edges, 0.5).first().coverage == 4 / 64
    assert rasters.empty_regions(points.drop("building_id"), edges, 1.0).first().hole_ratio == 12 / 16
    roof = points.where("classification = 6")
    assert cloud_quality.spacing(roof, ["k"]).first().spacing_p50 == 1
    assert cloud_quality.outlier_ratio(roof).first().outlier_ratio == 0.25


def test_height_raster_metrics_and_agreement(spark):
    edges = spark.createDataFrame(square(0, 2), EDGES)
    points = cloud(spark, [(0.2, 0.2, 10, 6), (0.4, 0.4, 12, 6), (1.2, 0.2, 20, 6), (3, 3, 5, 2)]).drop("building_id")
    grid = {(r.row, r.col): (r.height, r.points) for r in rasters.height_raster(points, edges, 1.0, 0.5).collect()}
    assert grid == {(0, 0): (11, 2), (0, 1): (20, 1), (1, 0): (None, 0), (1, 1): (None, 0)}
    cells = lambda rows: spark.createDataFrame([(1, r, c, float(h)) for r, c, h in rows], "building_id long, row long, col long, height double")
    m = rasters.height_metrics(cells([(0, 0, 10), (0, 1, 10.5), (1, 0, 12), (1, 1, 14)]), 1.0).first()
    assert (m.pairs, m.gradient_p50, m.discontinuity_ratio) == (4, 2.0, 0.75)
    coarse = cells([(0, 0, 10), (0, 1, 12), (1, 0, 14), (1, 1, 16)])
    fine = cells([(2 * r + i, 2 * c + j, h + 0.2) for r, c, h in ((0, 0, 10), (0, 1, 12), (1, 0, 14), (1, 1, 16)) for i in (0, 1) for j in (0, 1)])
    a = rasters.resolution_agreement(fine, coarse, 0.5, 1.0).first()
    assert (a.joint_cells, a.overlap) == (4, 1) and a.mae == pytest.approx(0.2) and a.rmse == pytest.approx(0.2)


def test_roof_observations(spark):
    points = cloud(spark, [(0, 0, 10, 6), (0.2, 0, 10.1, 6), (0, 0.2, 9.9, 6), (0.2, 0.2, 10, 6), (0.1, 0.1, 4, 6)])
    assert [r.kept for r in cloud_quality.roof_observations(points, ["k"]).orderBy("k").collect()] == [True] * 4 + [False]
    assert all(r.kept for r in cloud_quality.roof_observations(points.limit(2), ["k"]).collect())


def test_planes(spark):
    one = cloud(spark, [(x, y, 0.2 * x + 10, 6) for x in range(10) for y in range(10)])
    found = cloud_quality.roof_planes(one, ["k"]).collect()
    assert len(found) == 1 and found[0].support == 100 and found[0].slope_deg == pytest.approx(math.degrees(math.atan(0.2)), abs=0.1)
    two = cloud(spark, [(x, y, 20 - 0.3 * abs(x), 6) for x in range(-10, 10) for y in range(10)])
    planes = cloud_quality.roof_planes(two, ["k"])
    assert planes.count() == 2 and planes.agg(F.sum("support")).first()[0] == 200
    assert cloud_quality.dominant_normals(planes).first().dominant_normals == 2
    flat = cloud_quality.local_planes(cloud(spark, [(x, y, 0.2 * x + 0.1 * y, 6) for x in range(6) for y in range(6)]), ["k"], k=9).first()
    assert flat.planar_support > 0.9 and flat.residual_p50 < 0.01


def test_planes_and_spacing_of_a_sparse_roof(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    xyz = np.concatenate([rng.uniform(0, 20, (30, 3)) * [1, 1, 0.02], rng.uniform(0, 3, (20, 3)) * [1, 1, 0.1], [[150, 90, 5], [10, 10, 60]]])
    points = cloud(spark, [(*p, 6) for p in xyz.tolist()])
    low, flat = [], []
    for p in xyz:
        near = xyz[np.argsort(np.linalg.norm(xyz - p, axis=1), kind="stable")[:16]]
        e = np.clip(np.linalg.eigvalsh(np.cov(near.T, bias=True)), 0, None)
        low.append(math.sqrt(e[0]))
        flat.append(low[-1] <= 0.20 and (e[1] - e[0]) / e[2] >= 0.30)
    got = cloud_quality.local_planes(points, ["k"]).first()
    assert got.planar_support == pytest.approx(sum(flat) / len(flat)) and got.residual_p50 == pytest.approx(float(np.median(low)), abs=1e-9)
    gaps = [sorted(np.hypot(*(xyz - p)[:, :2].T))[1] for p in xyz]
    got = cloud_quality.spacing(points, ["k"]).first()
    assert (got.spacing_p50, got.spacing_p90) == pytest.approx((np.quantile(gaps, 0.5), np.quantile(gaps, 0.9)))
    two = cloud_quality.spacing(cloud(spark, [(0, 0, 0, 6), (500, 0, 0, 6)]), ["k"]).first()
    assert two.spacing_p50 == 500


CUBE = [(x, y, z) for z in (0, 10) for x, y in ((0, 0), (10, 0), (10, 8), (0, 8))]
FACES = [("GroundSurface", [0, 3, 2, 1]), ("RoofSurface", [4, 5, 6, 7])] + [("WallSurface", [i, (i + 1) % 4, (i + 1) % 4 + 4, i + 4]) for i in range(4)]


def mesh(spark, faces=FACES):
    v = spark.createDataFrame([(1, i, *map(float, p)) for i, p in enumerate(CUBE)], "model_id long, vertex_idx long, x double, y double, z double")
    f = spark.createDataFrame([(1, k, o, i, s) for k, (s, c) in enumerate(faces) for o, i in enumerate(c)], "model_id long, face_id long, ordinal long, vertex_idx long, semantic string")
    return v, f


def test_mesh_validation(spark):
    prints = spatial.footprints(spark.createDataFrame(ring([(0, 0), (10, 0), (10, 8), (0, 8)]), EDGES))
    r = meshes.validate(*mesh(spark), prints).first()
    assert (r.watertight, r.height, r.iou, r.area_ratio, r.geometry_valid, r.plausibility_pass, r.failures) == (True, 10, 1, 1, True, True, "")
    r = meshes.validate(*mesh(spark, FACES[:-1]), prints).first()
    assert not r.geometry_valid and r.boundary_edges == 4 and r.failures == meshes.NOT_WATERTIGHT and not r.accepted


def test_fit(spark):
    points = spark.createDataFrame([(1, i, *map(float, p)) for i, p in enumerate([(2, 2, 10), (4, 4, 10.2), (6, 6, 9.8), (8, 7, 11)])], "model_id long, k long, x double, y double, z double")
    triangles = meshes.roof_triangles(*mesh(spark))
    r = meshes.fit_report(meshes.residuals(points, triangles, ("k",))).first()
    assert triangles.count() == 2 and r.rmse_m == pytest.approx(math.sqrt(1.08 / 4)) and r.p95_m == pytest.approx(0.88) and r.within_020m == 0.75


def test_a_triangle_without_area_has_no_distance(spark):
    points = spark.createDataFrame([(1, 0, 1.0, 1.0, 1.0)], "model_id long, k long, x double, y double, z double")
    flat = spark.createDataFrame([(1, 0, 1, *[0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 2.0, 0.0, 0.0])], "model_id long, face_id long, k long, " + ", ".join(f"{n}{c} double" for n in "agc" for c in "xyz"))
    r = meshes.fit_report(meshes.residuals(points, flat, ("k",))).first()
    assert r.status == "degenerate triangle" and r.rmse_m is None and r.points == 1


def test_polygon_soup(spark):
    v, f = mesh(spark)
    own = f.join(v, ["model_id", "vertex_idx"]).withColumn("own", F.col("face_id") * 4 + F.col("ordinal"))
    loose = own.select("model_id", F.col("own").alias("vertex_idx"), "x", "y", "z"), own.select("model_id", "face_id", "ordinal", F.lit(None).cast("string").alias("semantic"), F.col("own").alias("vertex_idx"))
    prints = spatial.footprints(spark.createDataFrame(ring([(0, 0), (10, 0), (10, 8), (0, 8)]), EDGES))
    r = meshes.validate_obj(*loose, prints).first()
    assert (r.vertices, r.duplicates, r.faces, r.watertight, r.accepted, r.failures) == (24, 16, 6, True, True, "")
    broken = loose[1].union(spark.createDataFrame([(1, 9, 0, None, 0), (1, 9, 1, None, 777), (1, 9, 2, None, 1)], loose[1].schema))
    r = meshes.validate_obj(loose[0], broken, prints).first()
    assert (r.invalid_faces, r.failures, r.geometry_valid) == (1, meshes.BAD_FACES, False)


def test_surfaces_with_holes(spark):
    v = spark.createDataFrame([(1, i, float(x), float(y), 5.0 + 0.1 * x) for i, (x, y) in enumerate([(0, 0), (10, 0), (10, 10), (0, 10), (4, 4), (4, 6), (6, 6), (6, 4)])], "model_id long, vertex_idx long, x double, y double, z double")
    f = spark.createDataFrame([(1, r, o, i, "RoofSurface", 0, r) for r, c in enumerate([[0, 1, 2, 3], [4, 5, 6, 7]]) for o, i in enumerate(c)], "model_id long, face_id long, ordinal long, vertex_idx long, semantic string, surface_id long, ring_id long")
    found = meshes.triangulated(v, f).collect()
    size = lambda t: abs((t.gx - t.ax) * (t.cy - t.ay) - (t.gy - t.ay) * (t.cx - t.ax)) / 2
    assert len(found) == 8 and sum(map(size, found)) == pytest.approx(96) and all(t.error is None for t in found)
    assert meshes.surface_areas(v, f).first().area == pytest.approx(96 * math.sqrt(1.01))
    assert meshes.triangulated(v.withColumn("x", F.lit(1.0)).withColumn("z", F.lit(1.0)), f).first().error == "the surface is degenerate"


@pytest.mark.parametrize("seed", range(6))
def test_triangles_cover_random_polygons(seed):
    import numpy as np

    from gablestone.functions.triangles import triangulate

    rng = np.random.default_rng(seed)
    n = int(rng.integers(4, 25))
    angle = np.sort(rng.uniform(0, 2 * np.pi, n))
    star = np.c_[np.cos(angle), np.sin(angle)] * rng.uniform(6, 12, n)[:, None]
    holes = [np.array([[x, y], [x, y + 1], [x + 1, y + 1], [x + 1, y]]) for x, y in ((-2, -2), (1, 1), (-2, 1))][: int(rng.integers(0, 4))]
    xy = np.concatenate([star, *holes])
    area = lambda p: abs(np.sum(p[:, 0] * np.roll(p[:, 1], -1) - np.roll(p[:, 0], -1) * p[:, 1])) / 2
    if np.diff(np.append(angle, angle[0] + 2 * np.pi)).max() > 2:
        return  # the holes may lie outside
    rings, at = [list(range(n))], n
    for h in holes:
        rings.append(list(range(at, at + 4)))
        at += 4
    t = triangulate(rings, np.c_[xy, xy @ [0.2, 0.3]])
    assert len(t) == len(xy) + 2 * len(holes) - 2
    assert sum(area(xy[list(x)]) for x in t) == pytest.approx(area(star) - len(holes))


def test_plan_reasons(spark):
    rows = [(1, "auto", "strict", "auto", "2.2", True, True, True, True, "GOOD", "SIMPLE"), (2, "2.2", "fallback", "auto", "1.2", True, False, False, True, "GOOD", "COMPLEX"), (3, "2.2", "strict", "city3d", None, False, False, False, True, "", "SIMPLE"), (4, "2.2", "force_experimental", "city3d", None, False, False, False, True, "", "SIMPLE")]
    d = spark.createDataFrame(rows, "id long, lod_request string, policy string, backend_request string, highest_lod string, lod12 boolean, lod13 boolean, lod22 boolean, available boolean, quality_class string, complexity_class string")
    got = {r.id: r for r in decisions.with_plan(d).collect()}
    assert (got[1].profile, got[1].plan_reasons) == ("balanced", ["automatic target is highest supported LoD 2.2", "selected available roofer backend"])
    assert (got[2].profile, got[2].target_lod, got[2].plan_reasons[0]) == ("conservative", "1.2", "downgraded unsupported request to LoD 1.2")
    assert (got[3].decision, got[3].plan_reasons) == ("no_lod", ["requested LoD 2.2 is not supported"])
    assert (got[4].selected_backend, got[4].plan_warnings) == ("city3d", [decisions.FORCED_WARNING])


def test_buildings_without_points_have_a_report(spark):
    edges = spark.createDataFrame(square(0, 4) + square(100, 104, building=2), EDGES)
    points = cloud(spark, [(0.5, 0.5, 10, 6), (1.5, 0.5, 10.1, 6), (2.5, 0.5, 10.2, 6), (2.5, 2.5, 10.2, 2)]).drop("building_id")
    got = {r.building_id: r for r in evidence.quality_report(points, edges, ["k"]).collect()}
    assert (got[1].available, got[1].point_count, got[1].roof_point_count, got[1].density_roof, got[1].coverage_100m, got[1].spacing_p50) == (True, 4, 3, 3 / 16, 3 / 16, 1)
    assert (got[2].available, got[2].roof_point_count, got[2].alignment_score, got[2].outlier_ratio, got[2].warnings) == (True, 0, None, None, evidence.NO_ROOF_POINTS)  # the cloud has points, if none of this building
    with pytest.raises(ValueError):
        evidence.Limits(neighbours=2)


def test_the_aspect_of_a_plane(spark):
    south = cloud(spark, [(x, y, 0.2 * y, 6) for x in range(10) for y in range(10)])  # it rises to the north
    assert cloud_quality.roof_planes(south, ["k"]).first().aspect_deg == pytest.approx(0, abs=0.1)
    plane = spark.createDataFrame([(1, 0, 0.0, 0.0, 1.0, 5.0), (1, 1, 0.0, 0.0, 1.0, 9.0)], "building_id long, plane int, nx double, ny double, nz double, offset double")
    got = cloud_quality.nearest_plane(cloud(spark, [(0, 0, 6, 6), (0, 0, 7, 6)]), plane, ["k"]).orderBy("k").collect()
    assert [(r.plane, r.distance) for r in got] == [(0, 1), (0, 2)]


def test_distance_to_edges_and_corners(spark):
    points = spark.createDataFrame([(1, i, *map(float, p)) for i, p in enumerate([(-3, -4, 10), (5, -2, 10), (5, 4, 13), (13, 12, 10)])], "model_id long, k long, x double, y double, z double")
    got = [r.distance for r in meshes.residuals(points, meshes.roof_triangles(*mesh(spark)), ("k",)).orderBy("k").collect()]
    assert got == pytest.approx([5, 2, 3, 5])


def test_roof_form(spark):
    rows = [(5.0, 0.9, 0.8, 0.0, 0.1, 0.0), (5.0, 0.9, 0.8, 0.2, 0.5, 0.0), (5.0, 0.9, 0.8, 0.2, 1.5, 0.0), (0.5, 0.9, None, 0.2, 0.5, 0.0), (5.0, 0.9, 0.3, 0.2, 0.5, 0.0), (None, 0.9, 0.8, 0.0, 0.0, 0.0)]
    d = spark.createDataFrame(rows, "d double, v double, p double, g double, h double, s double")
    assert [r[0] for r in d.select(decisions.roof_form(*map(F.col, "dvpghs"))).collect()] == ["FLAT", "PITCHED", "COMPOUND", "INSUFFICIENT_EVIDENCE", "UNCERTAIN", "INSUFFICIENT_EVIDENCE"]


def test_ranking_and_summary(spark):
    e = spark.createDataFrame([(1, 0, "roofer", 0.4, 1.5, True), (1, 1, "roofer", 0.8, 1.0, False), (1, 2, "roofer", 0.4, 1.5, True)], "building_id long, input_ord long, backend string, rmse_m double, p95_m double, accepted boolean")
    assert [(r.input_ord, r["rank"]) for r in benchmarks.ranking(e).orderBy("rank").collect()] == [(0, 1), (2, 2)]
    by = {r.backend: r for r in benchmarks.backend_summary(e).collect()}
    assert by["roofer"].evaluated == 3 and by["roofer"].mean_rmse == pytest.approx(1.6 / 3) and by["city3d"].evaluated == 0 and by["city3d"].mean_rmse is None


def test_grid_cells(spark):
    box = lambda *b: spark.createDataFrame([(1, *map(float, b))], "building_id long, min_x double, min_y double, max_x double, max_y double")
    got = spatial.grid_cells(box(724980, 4372100, 724990, 4372200), 25.0).orderBy("easting_km").collect()
    assert [(r.easting_km, r.northing_km, r.cell_id) for r in got] == [(724, 4372, "724-4373-H30"), (725, 4372, "725-4373-H30")]
    assert spatial.grid_cells(box(1000, 0, 2000, 10)).count() == 1 and spatial.grid_cells(box(1000, 0, 1000, 10)).count() == 0


def test_projection_goes_there_and_back(spark):
    d = spark.createDataFrame([(724385.52, 4372941.57)], "e double, n double")
    there = projection.apply(d, projection.to_geographic("e", "n"), ("lon", "lat"))
    r = projection.apply(there, projection.to_utm("lon", "lat"), ("e2", "n2")).first()
    assert r.lon == pytest.approx(-0.3913, abs=1e-3) and r.lat == pytest.approx(39.4767, abs=1e-3)
    assert r.e2 == pytest.approx(r.e, abs=1e-3) and r.n2 == pytest.approx(r.n, abs=1e-3)


def test_text_rules(spark):
    d = spark.createDataFrame([(" 1234567ab8901c ", "EPSG:25830", "1 2 3 4"), ("123!", "urn:ogc:def:crs:EPSG::4326", "1 2 3"), (None, "25830", "")], "r string, c string, p string")
    got = d.select(text.reference_root(F.col("r")), text.crs(F.col("c")), F.size(text.positions(F.col("p")))).collect()
    assert [tuple(r) for r in got] == [("1234567AB8901C", "EPSG:25830", 2), (None, "EPSG:4326", None), (None, None, None)]


def test_box_overlap(spark):
    r = spark.range(1).select(geometry.bbox_iou([*map(F.lit, (0.0, 0.0, 2.0, 2.0))], [*map(F.lit, (1.0, 0.0, 3.0, 2.0))]), geometry.bbox_iou([F.lit(0.0)] * 4, [F.lit(0.0)] * 4)).first()
    assert r[0] == pytest.approx(1 / 3) and r[1] == 0


def test_cells_are_dealt_out_and_those_of_the_rays(spark):
    shapes = [s for b in range(1, 7) for s in (ring([(b * 50, 0), (b * 50 + 20.3, 1), (b * 50 + 9, 15.7)], b), ring([(b * 50 + 8, 3), (b * 50 + 11, 3), (b * 50 + 9, 9)], b, 0, 1), ring([(b * 50 + 1, 9), (b * 50 + 12, 9), (b * 50 + 4, 22)], b, 1))]
    edges = spark.createDataFrame([r for s in shapes for r in s], "building_id long, polygon_id long, ring_id long, edge_id long, x1 double, y1 double, x2 double, y2 double")
    cells = rasters.footprint_cells(edges, 0.5)
    # Few bytes of footprints are not one task's work.
    assert cells.rdd.getNumPartitions() > 1
    own = spatial.buildings(edges).crossJoin(spark.range(41).withColumnRenamed("id", "col")).crossJoin(spark.range(44).withColumnRenamed("id", "row"))
    own = own.select("building_id", "row", "col", geometry.in_polygons(F.col("polygons"), F.col("min_x") + (F.col("col") + 0.5) * 0.5, F.col("min_y") + (F.col("row") + 0.5) * 0.5).alias("inside")).where("inside")
    assert {tuple(r)[:3] for r in own.collect()} == {tuple(r) for r in cells.select("building_id", "row", "col").collect()}
    points = spark.createDataFrame([(float(50 + 7), 2.2, 1.0, 6)], "x double, y double, z double, classification long")
    found = {r["building_id"]: r for r in rasters.empty_regions(points, edges, 0.5).collect()}
    n = cells.where("building_id = 2").count()
    assert len(found) == 6 and 0 < found[1]["largest_empty_cells"] < n and found[2]["hole_ratio"] == found[2]["largest_empty_cells"] / n
