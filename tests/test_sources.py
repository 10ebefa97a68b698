import json
import zipfile

import numpy as np
import pytest

from gablestone.operators import meshes, spatial
from gablestone.plans import registry
from gablestone.sources import las, models
from gablestone.sources import registry as registry_source
from gablestone.streaming import landing


def test_las_tiles(spark, tmp_path):
    las.write(f"{tmp_path}/a.las", np.array([3.5, 7.25, 42.0]), np.array([2.5, 8.0, 11.0]), np.array([100.0, 104.5, 90.25]), [6, 2, 3], [True, False, False])
    las.write(f"{tmp_path}/b.las", np.array([2048.0]), np.array([0.75]), np.array([-3.5]), [12])
    las.register(spark)
    rows = spark.read.format("las").option("range_points", 2).load(str(tmp_path)).orderBy("tile", "point_id").collect()
    assert [(r.tile, r.point_id, round(r.x, 3), round(r.z, 3), r.classification, r.overlap) for r in rows] == [("a.las", 0, 3.5, 100, 6, True), ("a.las", 1, 7.25, 104.5, 2, False), ("a.las", 2, 42, 90.25, 3, False), ("b.las", 0, 2048, -3.5, 12, False)]
    assert las.header((tmp_path / "a.las").read_bytes())["max"] == (42, 11, 104.5)


def test_crops_keep_whole_records_in_the_first_scale(spark, tmp_path):
    rng = np.random.default_rng(8)
    clouds = [np.round(rng.uniform(low, low + 40, (500, 3)), 2) for low in (0, 20)]
    for name, xyz, scale in zip("ab", clouds, (0.01, 0.001)):
        las.write(f"{tmp_path}/{name}.las", *xyz.T, rng.integers(0, 20, 500), rng.random(500) < 0.5, scale)
        data = bytearray((tmp_path / f"{name}.las").read_bytes())
        for i in range(500):  # a return number, user data and a time that no column shows
            data[375 + 30 * i + 14], data[375 + 30 * i + 17], data[375 + 30 * i + 22 : 375 + 30 * i + 24] = 1 + i % 3, i % 251, i.to_bytes(2, "little")
        (tmp_path / f"{name}.las").write_bytes(data)
    box, sources = (20.0, 15.0, 45.0, 38.0), [f"{tmp_path}/a.las", f"{tmp_path}/b.las"]
    n = las.crop(spark, sources, f"{tmp_path}/cut", box)
    inside = [(np.array([box[0], box[1]]) <= x[:, :2]).all(1) & (x[:, :2] <= np.array(box[2:])).all(1) for x in clouds]
    assert n == sum(map(sum, inside)) > 100

    def points(path):
        out = []
        for r in spark.read.format("las").option("records", "true").load(path).collect():
            out.append((round(r.x, 2), round(r.y, 2), round(r.z, 2), r.classification, r.overlap, bytes(r.record[12:])))
        return sorted(out)

    las.register(spark)
    want = [p for s in sources for p in points(s) if box[0] <= p[0] <= box[2] and box[1] <= p[1] <= box[3]]
    assert points(f"{tmp_path}/cut") == sorted(want)
    for file in las._files(f"{tmp_path}/cut"):
        h = las.header(las._head(file))
        assert np.allclose(h["scale"], 0.01) and h["min"][0] >= 20 and h["max"][1] <= 38
    assert spark.read.format("las").option("bbox", "20,15,45,38").load(f"{tmp_path}/a.las").count() == inside[0].sum()


def test_crops_that_cannot_be_made(spark, tmp_path):
    las.write(f"{tmp_path}/a.las", np.array([1.0]), np.array([1.0]), np.array([1.0]), [2])
    data = bytearray((tmp_path / "a.las").read_bytes())
    data[104] = 7
    (tmp_path / "b.las").write_bytes(data)
    a, b, out = (f"{tmp_path}/{x}" for x in ("a.las", "b.las", "out"))
    for sources, where, box in (([], out, (0, 0, 2, 2)), ([a], out, (0, 0, 0, 2)), ([a], a, (0, 0, 2, 2)), ([a, b], out, (0, 0, 2, 2)), ([a], out, (5, 5, 6, 6)), ([f"{tmp_path}/none"], out, (0, 0, 2, 2))):
        with pytest.raises(ValueError):
            las.crop(spark, sources, where, box)
    assert not las._files(out)
    assert las.crop(spark, [a], out, (1, 1, 2, 2)) == 1


def test_obj(spark, tmp_path):
    (tmp_path / "m.obj").write_text("v 0 0 0\nv 5\nv 1 0 0\nv 0 1 0\nf 1/1 2/2 3/3\nv 0 0 1\nf -1 -2 -3\n")
    v, f = models.read_obj(spark, str(tmp_path / "m.obj"))
    assert v.count() == 4
    by = {}
    for r in f.orderBy("face_id", "ordinal").collect():
        by.setdefault(r.face_id, []).append(r.vertex_idx)
    assert by == {0: [0, 1, 2], 1: [3, 2, 1]}


def test_cityjsonseq(spark, tmp_path):
    solid = {"type": "Solid", "lod": "2.2", "boundaries": [[[[0, 1, 2]], [[0, 2, 3]]]], "semantics": {"surfaces": [{"type": "GroundSurface"}, {"type": "RoofSurface"}], "values": [[0, 1]]}}
    lines = [{"type": "CityJSON", "transform": {"scale": [0.5, 0.5, 1], "translate": [10, 20, 0]}}, {"type": "CityJSONFeature", "id": "a", "vertices": [[0, 0, 0], [2, 0, 0], [2, 2, 0], [0, 2, 4]], "CityObjects": {"a": {"geometry": [solid]}}}]
    (tmp_path / "m.jsonl").write_text("\n\n".join(map(json.dumps, lines)))
    v, f = models.read_cityjsonseq(spark, str(tmp_path / "m.jsonl"))
    assert [(r.x, r.y, r.z) for r in v.orderBy("vertex_idx").collect()] == [(10, 20, 0), (11, 20, 0), (11, 21, 0), (10, 21, 4)]
    assert {(r.semantic, r.faces) for r in meshes.semantic_histogram(f).collect()} == {("GroundSurface", 1), ("RoofSurface", 1)}


def test_two_objects_and_a_hole_keep_their_faces_apart(spark, tmp_path):
    square = lambda k: {"type": "Solid", "lod": "2.2", "boundaries": [[[[k, k + 1, k + 2, k + 3]]]], "semantics": {"surfaces": [{"type": "RoofSurface"}], "values": [[0]]}}
    pierced = {"type": "Solid", "lod": "2.2", "boundaries": [[[[0, 1, 2, 3], [8, 11, 10, 9]]]], "semantics": {"surfaces": [{"type": "RoofSurface"}], "values": [[0]]}}
    corners = [[0, 0, 0], [10, 0, 0], [10, 10, 0], [0, 10, 0], [20, 0, 0], [30, 0, 0], [30, 10, 0], [20, 10, 0], [4, 4, 0], [6, 4, 0], [6, 6, 0], [4, 6, 0]]
    head = {"type": "CityJSON", "transform": {"scale": [1, 1, 1], "translate": [0, 0, 0]}}
    for name, objects in (("two", {"a": {"geometry": [square(0)]}, "b": {"geometry": [square(4)]}}), ("hole", {"a": {"geometry": [pierced]}})):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(map(json.dumps, [head, {"type": "CityJSONFeature", "id": "x", "vertices": corners, "CityObjects": objects}])))
    (tmp_path / "none.jsonl").write_text(json.dumps(head))
    v, f = models.read_cityjsonseq(spark, str(tmp_path / "two.jsonl"))
    assert sorted(r.area for r in meshes.face_areas(v, f).collect()) == [100, 100]
    v, f = models.read_cityjsonseq(spark, str(tmp_path / "hole.jsonl"))
    assert sorted(r.area for r in meshes.face_areas(v, f).collect()) == [4, 100] and [r.area for r in meshes.surface_areas(v, f).collect()] == [96]
    assert [(r.model_id, r.error) for r in models.cityjson_errors(spark, str(tmp_path)).collect()] == [("none.jsonl", "no feature")]


def test_archives_and_geojson(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/1.PNG", b"123")
        z.writestr("y.csv", b"1")
    members = models.archive_members(spark, str(tmp_path / "a.zip"))
    assert {(r.member, r.suffix, r.size) for r in members.collect()} == {("x/1.PNG", ".png", 3), ("y.csv", ".csv", 1)}
    r = registry_source.inventory(members, 1).first()
    assert (r.files, r.bytes, r.top, r.suffixes, r.sample) == (2, 4, ["x", "y.csv"], {".csv": 1, ".png": 1}, ["x/1.PNG"])
    edges = spark.createDataFrame([(1, 0, 0, i, *map(float, e)) for i, e in enumerate([(0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 0)])], "building_id long, polygon_id long, ring_id long, edge_id long, x1 double, y1 double, x2 double, y2 double")
    models.write_geojson(spatial.footprints(edges), f"{tmp_path}/g", ["building_id"])
    f = json.loads(spark.read.text(f"{tmp_path}/g").first().value)
    assert f["geometry"]["coordinates"] == [[[0, 0], [1, 0], [1, 1], [0, 0]]] and f["properties"] == {"building_id": 1}


def test_tiles_as_they_land(spark, tmp_path):
    spark.createDataFrame([(6, 1.0), (6, 3.0), (2, 0.0)], "classification long, z double").write.parquet(f"{tmp_path}/in")
    q = landing.class_counts(landing.landed(spark, f"{tmp_path}/in", "classification long, z double")).writeStream.outputMode("complete").format("memory").queryName("landed").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.classification, r.points, r.z_max) for r in spark.table("landed").collect()} == {(6, 2, 3), (2, 1, 0)}


def test_queries_and_their_sql_go_together(spark, sf_dir):
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert registry.flagship(spark, sf_dir).count() == 10
