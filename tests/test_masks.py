import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablestone.operators import benchmarks, masks, tiles


def mask(spark, text, name="a"):
    return spark.createDataFrame([(name, r, c) for r, line in enumerate(text.split()) for c, x in enumerate(line) if x == "#"], "object_id string, row long, col long")


def cells(df):
    return sorted((r.row, r.col) for r in df.collect())


def test_binary_resize_and_area(spark):
    soft = spark.createDataFrame([("a", 0, 0, 0.5), ("a", 0, 1, 0.49), ("a", 1, 1, 0.9)], "object_id string, row long, col long, value double")
    own = masks.binary(soft)
    assert cells(own) == [(0, 0), (1, 1)]
    assert cells(masks.resized(own, (2, 2), (4, 4))) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (2, 3), (3, 2), (3, 3)]
    rng = np.random.default_rng(0)
    for old, new in (((5, 7), (3, 4)), ((3, 4), (8, 9)), ((6, 6), (6, 5))):
        full = rng.random(old) < 0.5
        df = spark.createDataFrame([("a", int(r), int(c)) for r, c in np.argwhere(full)], "object_id string, row long, col long")
        want = [(r, c) for r in range(new[0]) for c in range(new[1]) if full[(2 * r + 1) * old[0] // (2 * new[0]), (2 * c + 1) * old[1] // (2 * new[1])]]
        assert cells(masks.resized(df, old, new)) == want
    r = masks.areas(own, 0.25, -0.25).first()
    assert (r.pixel_area, r.area_m2) == (2, 0.125)


def test_clip_to_the_footprint(spark):
    ring = [(0, 0), (2, 0), (2, 2), (0, 2)]
    edges = spark.createDataFrame([(7, 0, 0, i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(ring, ring[1:] + ring[:1]))], "building_id long, polygon_id long, ring_id long, edge_id long, x1 double, y1 double, x2 double, y2 double")
    grid = spark.createDataFrame([(7, 0.0, 4.0, 1.0, 4, 4)], "building_id long, west double, north double, pixel double, height int, width int")
    pixels = masks.footprint_pixels(edges, grid)
    assert cells(pixels) == [(2, 0), (2, 1), (3, 0), (3, 1)]  # row 0 is the northern one
    own = mask(spark, "#### #### #### ####")
    assert cells(masks.clipped(own, spark.createDataFrame([("a", 7)], "object_id string, building_id long"), pixels)) == [(2, 0), (2, 1), (3, 0), (3, 1)]
    a, b = mask(spark, "##."), mask(spark, ".##")
    assert [cells(f(a, b)) for f in (masks.union, masks.both, masks.difference)] == [[(0, 0), (0, 1), (0, 2)], [(0, 1)], [(0, 0)]]


def area(ring):
    return sum(p.x * q.y - q.x * p.y for p, q in zip(ring, ring[1:])) / 2


def test_outlines(spark):
    parts = masks.outlines(mask(spark, "####. #..#. ####. ....# ...##"), 100.0, 50.0, 2.0).orderBy("part").collect()
    assert [(p.area_m2, len(p.rings)) for p in parts] == [(40, 2), (12, 1)]
    assert [area(r) for r in parts[0].rings] == [48, -8] and parts[0].rings[0][0] == parts[0].rings[0][-1]
    assert {(p.x, p.y) for p in parts[0].rings[0]} == {(100, 50), (108, 50), (108, 44), (100, 44)}
    corner = masks.outlines(mask(spark, "#.# .#. #.#"), 0.0, 3.0, 1.0).collect()  # pixels that meet at corners only
    assert len(corner) == 5 and all(area(p.rings[0]) == 1 and len(p.rings) == 1 for p in corner)
    rng = np.random.default_rng(3)
    noise = spark.createDataFrame([(f"m{k}", int(r), int(c)) for k in range(5) for r, c in np.argwhere(rng.random((12, 12)) < 0.6)], "object_id string, row long, col long")
    for p in masks.outlines(noise, 0.0, 0.0, 1.0).collect():
        assert sum(map(area, p.rings)) == pytest.approx(p.area_m2) and area(p.rings[0]) > 0 and all(area(r) < 0 for r in p.rings[1:])


def test_largest_part_and_collection(spark):
    parts = masks.outlines(mask(spark, "##.# ....", "x").union(mask(spark, "#.# ...", "tie")), 0.0, 2.0, 1.0)
    best = masks.largest_part(parts)
    got = {r.object_id: r for r in best.collect()}
    assert got["x"].area_m2 == 2 and got["x"].quality_flags == [masks.REDUCED] and min(p.x for p in got["tie"].rings[0]) == 0
    rows = best.withColumn("building_id", F.lit(1)).withColumn("class_name", F.lit("chimney")).withColumn("confidence", F.lit(0.5))
    c = json.loads(masks.collection(rows).first().value)
    assert c["crs"]["properties"]["name"] == "EPSG:25830" and [f["id"] for f in c["features"]] == ["tie", "x"] and c["features"][1]["properties"]["area_m2"] == 2


RINGS = "array<array<struct<x double, y double>>>"


def ring(*points):
    return [tuple(map(float, p)) for p in points]


def test_objects_are_cut_to_their_tiles(spark):
    t = spark.createDataFrame([("t1", 0.0, 0.0, 100.0, 100.0), ("t2", 100.0, 0.0, 200.0, 100.0), ("t3", 500.0, 500.0, 600.0, 600.0)], "tile string, x1 double, y1 double, x2 double, y2 double")
    o = spark.createDataFrame([
        (1, "PV", 0, [ring((90, 10), (110, 10), (110, 20), (90, 20), (90, 10))]), (2, "tree", 0, [ring((1, 1), (2, 1), (2, 2), (1, 1))]), (3, "PV", 0, [ring((-50, 50), (50, 150), (150, 50), (50, -50), (-50, 50))]),
        (4, "PV", 0, [ring((100, 90), (100, 95), (100, 90))]),
    ], f"object_id long, label string, part int, rings {RINGS}")
    cut = tiles.cut_objects(t, o, {"PV": "pv_panel"})
    size = lambda r: abs(sum(p.x * q.y - q.x * p.y for p, q in zip(r, r[1:] + r[:1]))) / 2
    got = {(r.tile, r.object_id): size(r.ring) for r in cut.collect()}
    assert got == {("t1", 1): 100, ("t2", 1): 100, ("t1", 2): 0.5, ("t1", 3): 10_000, ("t2", 3): 2500, ("t1", 4): 0, ("t2", 4): 0}
    lines = {r.tile: r.value for r in tiles.label_lines(cut, {"pv_panel": 3}).collect()}
    assert lines["t2"].splitlines()[0].startswith("3 ") and len(lines["t1"].splitlines()) == 2
    back = tiles.read_labels(spark.createDataFrame([("t1", lines["t1"])], "tile string, value string"), 100, 100).orderBy("line").collect()
    assert back[0].class_id == 3 and size(back[0].ring) == pytest.approx(100)
    counts, splits = tiles.label_counts(cut, spark.createDataFrame([("t1", "train"), ("t2", "val"), ("t3", "train")], "tile string, split string"))
    assert {(r.name, r.ignored, r.instances) for r in counts.collect()} == {("pv_panel", False, 4), ("tree", True, 1)}
    assert {(r.split, r.images) for r in splits.collect()} == {("train", 2), ("val", 1)}


def test_clip_against_random_triangles(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [ring(*(q := rng.uniform(-1, 2, (3, 2)))[[0, 1, 2, 0]].tolist())]) for k in range(40)]
    o = spark.createDataFrame([(k, "a", 0, r) for k, r in rows], f"object_id long, label string, part int, rings {RINGS}")
    t = spark.createDataFrame([("t", 0.0, 0.0, 1.0, 1.0)], "tile string, x1 double, y1 double, x2 double, y2 double")
    got = {r.object_id: abs(sum(p.x * q.y - q.x * p.y for p, q in zip(r.ring, r.ring[1:] + r.ring[:1]))) / 2 if r.ring else 0.0 for r in tiles.cut_objects(t, o, {"a": "a"}).collect()}
    g = (np.arange(400) + 0.5) / 400
    x, y = np.meshgrid(g, g)
    for k, r in rows:
        a, b, c = map(np.array, r[0][:3])
        side = lambda p, q: (q[0] - p[0]) * (y - p[1]) - (q[1] - p[1]) * (x - p[0])  # noqa: B023, E731
        s = np.stack([side(a, b), side(b, c), side(c, a)])
        assert got.get(k, 0.0) == pytest.approx(((s >= 0).all(0) | (s <= 0).all(0)).mean(), abs=0.01)


def test_polygons_of_collections(spark):
    rows = spark.createDataFrame([(1, ("MultiPolygon", "[[[[0,0],[1,0],[0,0]]],[[[2,2],[3,3],[2,2]]]]")), (2, ("Polygon", "[[[0,0],[1,0],[0,0]]]")), (3, ("Point", "[1,2]"))], "id long, geometry struct<type string, coordinates string>")
    assert [(r.id, r.part, r.rings[0][0].x) for r in tiles.polygons(rows).orderBy("id", "part").collect()] == [(1, 0, 0), (1, 1, 2), (2, 0, 0)]


def test_summaries(spark):
    q = spark.createDataFrame([("high",), ("low",), ("low",)], "priority string")
    r = benchmarks.queue_summary(q).first()
    assert (r.high, r.medium, r.low, r.buildings) == (1, 0, 2, 3) and not math.isnan(r.high)
