"""Valid polygons, overlays, cadastral documents, archives and the training set made of one."""

import json
import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablestone.functions import arrangement
from gablestone.operators import cadastre, conversion, masks, overlay
from gablestone.sources import archives, registry

RINGS = "array<array<struct<x: double, y: double>>>"


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def odd(rings, x, y):
    """Even-odd by a ray, in floats."""
    inside = False
    for r in rings:
        for (a, b), (c, d) in zip(r, r[1:] + r[:1]):
            if (b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a:
                inside = not inside
    return inside


def covered(polygons, x, y):
    return sum(odd([r[:-1] for r in p], x, y) for p in polygons)


@pytest.mark.parametrize("rings, areas, counts", [
    ([[(0, 0), (4, 4), (4, 0), (0, 4)]], [4, 4], [1, 1]),  # a bow-tie
    ([box(0, 0, 10, 10), box(20, 20, 5, 5)], [100, 25], [1, 1]), ([box(0, 0, 10, 10), box(2, 2, 3, 3)], [91], [2]), ([box(2, 2, 3, 3), box(0, 0, 10, 10)], [91], [2]),
    ([box(0, 0, 4, 4), box(4, 4, 4, 4)], [16, 16], [1, 1]), ([box(0, 0, 4, 4), box(4, 0, 4, 4)], [32], [1]), ([box(0, 0, 4, 4), box(2, 2, 4, 4)], [12, 12], [1, 1]),
    ([box(0, 0, 10, 10), box(0, 4, 3, 3)], [91], [1]), ([box(0, 0, 10, 10), [(0, 5), (2, 4), (2, 6)]], [98], [2]), ([box(0, 0, 9, 9), box(1, 1, 7, 7), box(2, 2, 5, 5)], [32, 25], [2, 1]),
    ([[(0, 0), (5, 0), (5, 5), (5, 8), (5, 5), (0, 5)]], [25], [1]), ([box(0, 0, 4, 4)] * 2, [], []), ([[(0, 0), (3, 3), (0, 0)]], [], []), ([[(1, 1)]], [], []), ([], [], []),
])
def test_rings_become_valid_polygons(rings, areas, counts):
    got = arrangement.select([rings], any)
    assert [arrangement.area([p]) for p in got] == areas and [len(p) for p in got] == counts
    for p in got:
        for k, r in enumerate(p):
            assert r[0] == r[-1] and len(set(r[:-1])) == len(r) - 1 and (arrangement._area2(r[:-1]) > 0) == (k == 0)


def test_random_rings_against_sampled_points():
    rng = random.Random(8)
    for n in range(60):
        layers = [[[(rng.randint(0, 12), rng.randint(0, 12)) for _ in range(rng.randint(3, 8))] for _ in range(rng.randint(1, 3))] for _ in range(2)]
        for name, test in overlay.TESTS.items():
            got = arrangement.select(layers, test)
            for _ in range(60):
                x, y = rng.uniform(-1, 13) + 1e-4, rng.uniform(-1, 13) + 1e-4
                want = test(tuple(odd(rings, x, y) for rings in layers))
                assert covered(got, x, y) == int(want), (n, name, layers)
        whole = {k: arrangement.area(arrangement.select(layers, t)) for k, t in overlay.TESTS.items()}
        assert whole["union"] == pytest.approx(whole["intersection"] + whole["difference_both_ways"])


def frame(spark, rows, columns):
    return spark.createDataFrame([(*r[:-1], [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in r[-1]] if r[-1] is not None else None) for r in rows], f"{columns}, rings {RINGS}")


def test_rows_are_repaired(spark):
    rows = frame(spark, [(1, [[(0, 0), (4, 4), (4, 0), (0, 4)]]), (2, []), (3, None), (4, [[(0, 0), (float("nan"), 1), (1, 1)]]), (1, [box(0, 0, 2, 2)])], "id long")
    got = [(r.id, r.part, r.area_m2, r.error) for r in overlay.repaired(rows, ["id"]).collect()]
    assert sorted(got, key=repr) == sorted([(1, 0, 4.0, None), (1, 1, 4.0, None), (1, 0, 4.0, None), (2, None, None, "no area"), (3, None, None, "no area"), (4, None, None, "a coordinate is not finite")], key=repr)
    assert overlay.repaired(rows.limit(0), ["id"]).count() == 0


def test_rings_of_different_lengths(spark):
    rows = frame(spark, [(1, [box(0, 0, 10, 10), [(1, 1), (3, 1), (2, 3)]])], "id long")
    r = overlay.repaired(rows, ["id"]).first()
    assert [len(x) for x in r.rings] == [5, 4] and r.area_m2 == 98 and r.loose_edges == 0


def test_overlays_of_tables(spark):
    a = frame(spark, [(1, [box(0, 0, 4, 4)]), (1, [box(2, 0, 4, 4)]), (2, [box(0, 0, 1, 1)])], "k long")
    b = frame(spark, [(1, [box(1, 1, 10, 1)]), (3, [box(0, 0, 2, 2)])], "k long")
    size = lambda how: {r.k: r.s for r in overlay.overlay(a, b, ["k"], how).groupBy("k").agg(F.sum("area_m2").alias("s")).collect()}
    assert size("union") == {1: 29, 2: 1, 3: 4} and size("intersection") == {1: 5} and size("difference") == {1: 19, 2: 1} and size("difference_both_ways") == {1: 24, 2: 1, 3: 4}
    with pytest.raises(ValueError):
        overlay.overlay(a, b, ["k"], "xor")


def test_outlines_are_cut_at_the_footprints_border(spark):
    mask = spark.createDataFrame([(7, r, c) for r in range(4) for c in range(4)] + [(8, 0, 0)], "object_id long, row long, col long")
    parts = masks.outlines(mask, 0.0, 4.0, 1.0)
    prints = frame(spark, [(1, [[(0.5, 0.25), (9, 0.25), (9, 2), (0.5, 2)], [(1, 1), (2, 1), (2, 1.5), (1, 1.5)]])], "building_id long")
    got = overlay.clipped_outlines(parts, spark.createDataFrame([(7, 1), (8, 1), (9, 1)], "object_id long, building_id long"), prints).collect()
    assert [(r.object_id, r.part, r.area_m2) for r in got] == [(7, 0, 3.5 * 1.75 - 0.5)]


BUILDING = "building_id string, reference string, local_id string, namespace string, current_use string"


def test_cadastral_documents(spark):
    ring = [(724_700, 4_373_300), (724_710, 4_373_300), (724_710, 4_373_310), (724_700, 4_373_310)]
    rows = frame(spark, [("ES.1/a", "r", "1", "ES", "1_residential", [ring]), ("..", "r", "2", "", None, [ring]), ("ES.3", "r", "3", "ES", None, []), ("ES.4", "r", "4", "ES", None, [ring, [(x + 20, y + 20) for x, y in ring]])], BUILDING)
    parts = frame(spark, [("ES.1/a", 0, "p1", 10, [ring])], "building_id string, part int, local_id string, floors_above_ground int")
    got = {(r.building_id, r.file): r for r in cadastre.artefacts(rows, parts).collect()}
    one = json.loads(got["ES.1/a", "building.geojson"].value)
    assert one["geometry"]["type"] == "Polygon" and one["id"] == "ES.1/a" and one["properties"]["current_use"] == "1_residential" and "rings" not in one["properties"]
    lon, lat = one["geometry"]["coordinates"][0][0]
    assert lon == pytest.approx(-0.3913, abs=0.01) and lat == pytest.approx(39.4767, abs=0.02) and got["ES.1/a", "identity.json"].folder == "ES.1_a"
    features = json.loads(got["ES.1/a", "building_parts.geojson"].value)["features"]
    assert len(features) == 1 and features[0]["properties"] == {"local_id": "p1", "floors_above_ground": 10}
    two = json.loads(got["ES.4", "building.geojson"].value)["geometry"]
    assert two["type"] == "MultiPolygon" and len(two["coordinates"]) == 2
    assert got["..", None].error == "no folder can be named after the building" and got["ES.3", None].error == "the footprint has no area"
    assert json.loads(got["ES.4", "building_parts.geojson"].value)["features"] == [] and json.loads(got["ES.4", "identity.json"].value)["reference"] == "r"


def test_documents_are_written_and_footprints_projected_again(spark, tmp_path):
    ring = [(724_700, 4_373_300), (724_710, 4_373_300), (724_710, 4_373_310), (724_700, 4_373_310)]
    rows, parts = frame(spark, [("ES.1", "r", "1", "ES", "x", [ring])], BUILDING), frame(spark, [], "building_id string, part int, local_id string")
    cadastre.write_artefacts(cadastre.artefacts(rows, parts), f"{tmp_path}/out")
    text = spark.read.text(f"{tmp_path}/out/folder=ES.1/file=building.geojson").first().value
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "b.json").write_text(text)
    r = cadastre.projected(registry.building_features(spark, str(tmp_path / "f"))).first()
    again = json.loads(r.value)
    assert again["crs"]["properties"]["name"] == "urn:ogc:def:crs:EPSG::25830" and again["features"][0]["properties"] == {"building_id": "ES.1"}
    assert np.allclose(sorted(map(tuple, again["features"][0]["geometry"]["coordinates"][0][:-1])), sorted(ring), atol=1e-3)


# Archives


def test_directories_and_members_of_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(700):
            z.writestr(f"d/{k}.txt", f"text {k}" * 50)
        z.writestr("../out.txt", "x")
    whole = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "cut.zip").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "no.zip").write_bytes(b"not an archive")
    listed = archives.directory(spark, str(tmp_path))
    errors = {r.archive: r.error for r in listed.where("member is null").collect()}
    assert errors.keys() == {"cut.zip", "no.zip"} and listed.where("error = 'outside the archive'").count() == 1
    read = archives.contents(listed)
    assert read.count() == 703 and read.rdd.getNumPartitions() > 1
    assert {(r.member, bytes(r.content).decode()) for r in read.where("error is null").collect()} == {(f"d/{k}.txt", f"text {k}" * 50) for k in range(700)}
    assert archives.contents(listed.where("ordinal = 3"), most=10).first().error == "more than 10 bytes"


def test_a_damaged_member_is_a_row(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("good", "aaaa" * 100)
        z.writestr("bad", "bbbb" * 100)
    data = bytearray((tmp_path / "a.zip").read_bytes())
    data[data.index(b"bbbb") + 5] ^= 1
    (tmp_path / "a.zip").write_bytes(data)
    got = {r.member: (r.content, r.error) for r in archives.contents(archives.directory(spark, str(tmp_path / "a.zip"))).collect()}
    assert got["good"] == (bytearray(b"aaaa" * 100), None) and got["bad"][0] is None and "CRC" in got["bad"][1]


def test_an_archive_becomes_a_training_set(spark, tmp_path):
    shape = lambda rings: {"type": "Polygon", "coordinates": [[*map(list, r), list(r[0])] for r in rings]}
    images = [{"properties": {"id": f"t{k}"}, "geometry": shape([box(100 * k, 0, 100, 100)])} for k in range(4)]
    u = [(90, 10), (110, 10), (110, 20), (95, 20), (95, 60), (110, 60), (110, 70), (90, 70)]  # two pieces in the second tile
    objects = [(u, "Dormer"), (box(20, 20, 10, 10), "pv"), (box(250, 50, 10, 10), "tree"), ([(310, 10), (330, 30), (330, 10), (310, 30)], "pv")]
    with zipfile.ZipFile(tmp_path / "rid.zip", "w") as z:
        z.writestr(conversion.TRAINING, "﻿n,image_names\n1,t0.png\n2,t1.png\n")
        z.writestr(conversion.TEST, "image_names\nt3.png\n")
        z.writestr(conversion.IMAGES, json.dumps({"features": images}))
        z.writestr(conversion.OBJECTS, json.dumps({"features": [{"properties": {"label": n}, "geometry": shape([r])} for r, n in objects]}))
        for k in (0, 3):
            z.writestr(f"images/t{k}.png", bytes([k]) * 10)
    out = tmp_path / "set"
    rows, manifest = conversion.convert(spark, str(tmp_path / "rid.zip"), str(out), {"Dormer": "dormer", "pv": "pv_panel"}, {"pv_panel": 0, "dormer": 1}, {"version": "1", "record_url": "u", "archive_md5": "m"}, "tax-1")
    assert {r.tile: r.error for r in rows.collect()} == {"t0": None, "t1": "no image in the archive", "t2": "in no split list", "t3": None}
    own = json.loads((out / "manifest.json").read_text())
    assert (own["train_images"], own["validation_images"], own["instance_counts"], own["ignored_instance_counts"], own["licence"]) == (2, 1, {"dormer": 3, "pv_panel": 3}, {}, None)
    assert json.loads(manifest.first().value) == own
    assert (out / "dataset.yaml").read_text() == "train: images/train\nval: images/val\nnames:\n  0: pv_panel\n  1: dormer\n"
    lines = (out / "labels" / "train" / "t1.txt").read_text().splitlines()
    assert len(lines) == 2 and all(x.startswith("1 ") for x in lines) and (out / "images" / "val" / "t3.png").read_bytes() == b"\3" * 10
    assert len((out / "labels" / "val" / "t3.txt").read_text().splitlines()) == 2 and not (out / "labels" / "val" / "t2.txt").exists()
    assert (out / "labels" / "train" / "t0.txt").read_text().splitlines()[1] == "0 0.200000 0.800000 0.300000 0.800000 0.300000 0.700000 0.200000 0.700000"


def test_an_archive_without_its_lists_is_refused(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x", "y")
    with pytest.raises(ValueError, match="training_split"):
        conversion.tables(spark, str(tmp_path / "a.zip"))


@pytest.mark.parametrize("xml", ["<a><b></a>", "", "no xml", None])
def test_broken_documents_are_rows(spark, xml):
    d = spark.createDataFrame([(1, xml), (2, "<c/>")], "id long, xml string")
    for read in (registry.buildings, registry.coordinates):
        errors = {r.id: r.error for r in read(d).collect()}
        assert errors[1].startswith("no XML") and errors[2] and not errors[2].startswith("no XML")
    got = registry.parts(d, "id").collect()
    assert [(r.id, r.part) for r in got] == [(1, None)] and got[0].error.startswith("no XML")


def test_numbers_that_are_none_are_named(spark):
    part = '<c><BuildingPart><localId>p</localId><numberOfFloorsAboveGround>two</numberOfFloorsAboveGround><posList>0 0</posList></BuildingPart></c>'
    r = registry.parts(spark.createDataFrame([(1, part)], "id long, xml string"), "id").first()
    assert (r.local_id, r.floors_above, r.error) == ("p", None, "numberOfFloorsAboveGround is no number")


def test_few_bytes_of_rings_are_dealt_to_many_tasks(spark):
    square = [[{"x": 0.0, "y": 0.0}, {"x": 1.5, "y": 0.0}, {"x": 1.5, "y": 1.0}, {"x": 0.0, "y": 1.0}]]
    rows = spark.createDataFrame([(k, square) for k in range(64)], f"id long, rings {overlay.RINGS}").coalesce(1)
    found = overlay.repaired(rows, ["id"])
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert {r.area_m2 for r in found.collect()} == {1.5}


def test_coordinates_are_whole_numbers_of_one_scale():
    layers, scale = arrangement._scaled([[[(0.5, 3.0), (0.1, -2.0)]]])
    assert layers == [[[(scale // 2, 3 * scale), (int(0.1 * scale), -2 * scale)]]] and int(0.1 * scale) / scale == 0.1
