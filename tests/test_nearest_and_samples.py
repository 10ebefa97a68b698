"""Nearest triangles by growing rings, and samples that do not depend on partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablestone.operators import cloud_quality, meshes, samples

TRIANGLE = "model_id long, face_id long, k long, " + ", ".join(f"{n}{c} double" for n in "agc" for c in "xyz")


def terrain(n, rng, model=1):
    """2 n n triangles over a square, and a large one over all of them."""
    z = rng.normal(0, 0.3, (n + 1, n + 1))
    out = []
    for i in range(n):
        for j in range(n):
            p = lambda a, b: (float(a), float(b), float(z[a, b]))
            out += [(model, 2 * (i * n + j), 1, *p(i, j), *p(i + 1, j), *p(i, j + 1)), (model, 2 * (i * n + j) + 1, 1, *p(i + 1, j), *p(i + 1, j + 1), *p(i, j + 1))]
    return [*out, (model, 10**6, 1, 0.0, 0.0, 9.0, float(n), 0.0, 9.0, 0.0, float(n), 9.0)]


def test_search_finds_what_comparing_all_finds(spark):
    rng = np.random.default_rng(3)
    faces = spark.createDataFrame(terrain(8, rng) + [(2, 0, 1, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0)], TRIANGLE)
    points = [(1, i, *map(float, rng.uniform(-3, 11, 2)), float(rng.normal(2, 4))) for i in range(150)] + [(1, 900, 4.0, 4.0, 400.0), (1, 901, 900.0, -70.0, 3.0), (1, 902, 4.0, 4.0, 0.0), (2, 903, 0.2, 0.2, 5.0), (3, 904, 0.0, 0.0, 0.0)]
    rows = spark.createDataFrame(points, "model_id long, k1 long, x double, y double, z double")
    near = {r.k1: r.distance for r in meshes.residuals(rows, faces, ("k1",), few=4).collect()}
    every = {r.k1: r.distance for r in meshes.residuals(rows, faces, ("k1",), few=10**6).collect()}
    assert near.keys() == every.keys() and 904 not in near and all(near[k] == pytest.approx(every[k], abs=1e-9) for k in every)


def test_a_thin_triangle_leaves_its_model_without_distances(spark):
    rng = np.random.default_rng(4)
    faces = spark.createDataFrame(terrain(3, rng) + terrain(3, rng, 2) + [(2, 5, 1, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 2.0, 2.0, 2.0)], TRIANGLE)
    rows = spark.createDataFrame([(m, k, 1.0 + k, 1.0, 1.0) for m in (1, 2) for k in range(3)], "model_id long, k1 long, x double, y double, z double")
    got = meshes.residuals(rows, faces, ("k1",), few=4)
    assert {(r.model_id, r.distance is None) for r in got.collect()} == {(1, False), (2, True)}
    assert {r.model_id: r.status for r in meshes.fit_report(got).collect()} == {1: "ok", 2: "degenerate triangle"}


def test_ten_thousand_triangles_compare_few_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    faces = spark.createDataFrame(terrain(71, rng), TRIANGLE).repartition(4).cache()
    rows = spark.createDataFrame([(1, i, *map(float, rng.uniform(0, 71, 2)), float(rng.normal(0, 1))) for i in range(200)], "model_id long, k1 long, x double, y double, z double")
    compared, inner = [], meshes._distances

    def counted(df):
        compared.append(df.count())
        return inner(df)

    monkeypatch.setattr(meshes, "_distances", counted)
    got = meshes.residuals(rows, faces, ("k1",))
    assert got.count() == 200 and faces.count() > 10_000 and sum(c for c in compared if c) * 10 < 200 * faces.count()


@pytest.mark.parametrize("most", [1, 7, 64, 5000])
def test_samples_do_not_depend_on_partitions(spark, most):
    rows = [(g, i, f"{g}-{i}") for g, n in (("a", 3000), ("b", 5), (None, 400)) for i in range(n)]
    frame = spark.createDataFrame(rows, "g string, k long, priority string")
    got = [sorted(map(tuple, samples.sampled(frame.repartition(n), ["g"], ["k"], most).collect()), key=repr) for n in (1, 7)]
    assert got[0] == got[1] and samples.sampled(frame, ["g"], ["k"], most, seed=1).count() == len(got[0])
    sizes = {g: sum(r[0] == g for r in got[0]) for g in ("a", "b", None)}
    assert sizes == {"a": min(most, 3000), "b": min(most, 5), None: min(most, 400)} and set(got[0]) <= set(rows)


def test_a_larger_sample_holds_the_smaller_and_is_fair(spark):
    frame = spark.createDataFrame([(1, i) for i in range(4000)], "g long, k long")
    few, many = ({r.k for r in samples.sampled(frame, ["g"], ["k"], n).collect()} for n in (100, 1000))
    assert few < many and abs(np.mean(list(many)) - 2000) < 4 * 4000 / np.sqrt(12 * 1000)
    with pytest.raises(ValueError):
        samples.sampled(frame, ["g"], ["k"], 0)


def test_measures_take_samples(spark):
    rng = np.random.default_rng(6)
    points = spark.createDataFrame([(1, i, float(x), float(y), float(0.5 * x)) for i, (x, y) in enumerate(rng.uniform(0, 20, (3000, 2)))], "building_id long, k long, x double, y double, z double")
    whole, some = (cloud_quality.spacing(points, ["k"], sample=n).first().spacing_p50 for n in (None, 300))
    assert some > 2 * whole and cloud_quality.spacing(points, ["k"], sample=10**6).first().spacing_p50 == whole
    assert cloud_quality.local_planes(points, ["k"], sample=50).first().planar_support >= 0.8
    assert cloud_quality.roof_observations(points, ["k"], sample=40).count() == 40
    plane = cloud_quality.roof_planes(points, ["k"], sample=500).first()
    assert (plane.support, plane.support_ratio, plane.warnings) == (500, 1.0, None) and plane.offset == pytest.approx(plane.cx * plane.nx + plane.cy * plane.ny + plane.cz * plane.nz)
    near = cloud_quality.nearest_plane(points, cloud_quality.roof_planes(points, ["k"]), ["k"])  # planes feed it as they are
    assert near.agg(F.max("distance")).first()[0] == pytest.approx(0, abs=1e-6)


def test_roof_planes_take_rows_as_arrow(spark):
    """Groups come as Arrow tables, whatever the order and partitions of their rows; a group without planes has no row."""
    rows = [(1, k, float(k % 10), float(k // 10), 5.0) for k in range(60)] + [(2, k, float(k), 0.0, 0.0) for k in range(5)]
    points = spark.createDataFrame(rows, "building_id long, k long, x double, y double, z double")
    got = [cloud_quality.roof_planes(points.repartition(n), ["k"]) for n in (1, 5)]
    assert "FlatMapGroupsInArrow" in got[0]._jdf.queryExecution().executedPlan().toString()
    a, b = (df.collect() for df in got)
    assert a == b and [(r.building_id, r.plane, r.support, r.nz, r.aspect_deg, r.warnings) for r in a] == [(1, 0, 60, 1.0, None, None)]


def test_roof_planes_count_every_point(spark):
    """Support, its least, shares and fits are those of the whole group, also beyond one block of points."""
    n = 24_000
    one = spark.range(n).selectExpr("1L as building_id", "id as k", "cast(id % 150 as double) / 10 as x", "cast(floor(id / 150) as double) / 10 as y").withColumn("z", F.expr("if(k % 3 = 0, 20 + 0.5 * x, 10 - 0.25 * y)"))
    # 100 points on a third plane: more than a sample's least support would be, fewer than 5 % of all.
    few = spark.range(100).selectExpr("1L as building_id", f"id + {n} as k", "cast(id % 10 as double) as x", "cast(floor(id / 10) as double) as y", "50.0D as z")
    points = one.unionByName(few)
    got = cloud_quality.roof_planes(points, ["k"]).orderBy("plane").collect()
    assert [r.support for r in got] == [16_000, 8_000] and [r.explained for r in got] == [pytest.approx(n / (n + 100))] * 2
    assert [r.support_ratio for r in got] == [pytest.approx(16_000 / (n + 100)), pytest.approx(8_000 / (n + 100))] and got[0].cx == pytest.approx(one.where("k % 3 <> 0").agg(F.avg("x")).first()[0])
    few_only = cloud_quality.roof_planes(points.where(f"k >= {n} or k % 40 = 0"), ["k"]).collect()
    assert sorted(r.support for r in few_only) == [100, 200, 400]
