from gablestone.operators import lifecycle


def test_requests(spark):
    d = spark.createDataFrame([("force_experimental", "auto", "normal"), ("strict", "roofer", "research"), ("fallback", "auto", "normal")], "policy string, backend_request string, priority string")
    assert [r.request_error is None for r in lifecycle.valid_request(d).collect()] == [False, False, True]


def test_outcomes(spark):
    plans = spark.createDataFrame([(1, "2.2", "roofer", "1.2", "execute"), (2, "2.2", "roofer", None, "execute"), (3, None, None, None, "no_lod"), (4, "1.2", "roofer", None, "execute"), (5, "1.3", "roofer", "1.2", "execute")], "building_id long, target_lod string, selected_backend string, fallback_lod string, decision string")
    results = spark.createDataFrame([(1, "roofer", "2.2", True, False), (1, "roofer", "1.2", True, True), (2, "roofer", "2.2", True, False), (4, "roofer", "1.2", True, True)], "building_id long, backend string, lod string, succeeded boolean, accepted boolean")
    got = {r.building_id: (r.status, r.delivered_lod) for r in lifecycle.outcomes(plans, results).collect()}
    assert got == {1: ("SUCCEEDED", "1.2"), 2: ("ABSTAINED", None), 3: ("ABSTAINED", None), 4: ("SUCCEEDED", "1.2"), 5: ("FAILED", None)}


def test_a_fallback_result_stands_as_it_is(spark):
    plans = spark.createDataFrame([(1, "2.2", "roofer", "1.2", "execute"), (2, "2.2", "roofer", "1.2", "execute")], "building_id long, target_lod string, selected_backend string, fallback_lod string, decision string")
    results = spark.createDataFrame([(1, "roofer", "2.2", True, False), (1, "roofer", "1.2", True, False), (2, "roofer", "2.2", True, False), (2, "roofer", "1.2", False, False)], "building_id long, backend string, lod string, succeeded boolean, accepted boolean")
    got = {r.building_id: (r.status, r.delivered_lod, r.warning is None) for r in lifecycle.outcomes(plans, results).collect()}
    assert got == {1: ("SUCCEEDED", "1.2", False), 2: ("FAILED", None, False)}


def test_gates(spark):
    points = spark.createDataFrame([(1, 20.0, 2), (1, 21.0, 2), (2, 5.0, 6)], "building_id long, z double, classification int")
    rings = spark.createDataFrame([(1, 0, 0, 4, True, "EPSG:25830"), (2, 0, 0, 4, True, "EPSG:25830"), (2, 0, 1, 4, False, "EPSG:25830")], "building_id long, polygon_id int, ring_id int, corners int, closed boolean, crs string")
    got = {r.building_id: r for r in lifecycle.input_gates(points, rings).collect()}
    assert got[1].ready and got[1].ground_p50 == 20.5 and got[2].errors == "no ground points; holes; ring is not closed"


def test_exports(spark):
    v = spark.createDataFrame([(1, i, float(i), 0.0, 1.5) for i in range(3)], "model_id long, vertex_idx long, x double, y double, z double")
    f = spark.createDataFrame([(1, k, o, o, s) for k, s in enumerate(["Roof", "Roof", "Wall"]) for o in range(3)], "model_id long, face_id long, ordinal long, vertex_idx long, semantic string")
    assert lifecycle.obj_text(v, f).first().value == "v 0.000 0.000 1.500\nv 1.000 0.000 1.500\nv 2.000 0.000 1.500\ng Roof\nusemtl Roof\nf 1 2 3\nf 1 2 3\ng Wall\nusemtl Wall\nf 1 2 3\n"
    o = spark.createDataFrame([("t", 2, "a", [(1.0, 2.0)]), ("t", 1, "b", [(4.0, 4.0)]), ("t", 3, "unknown", [(0.0, 0.0)])], "tile string, object_id int, class_name string, ring array<struct<x double, y double>>")
    assert lifecycle.label_lines(o, {"a": 0, "b": 1}, 4.0, 8.0).first().value == "1 1.000000 0.500000\n0 0.250000 0.250000"


def test_dataset_audit(spark):
    s = spark.createDataFrame([("d", "open", True, "CC-BY", "Merged classes"), ("e", "closed", False, None, None)], "dataset string, access string, reviewed boolean, licence string, note string")
    m = spark.createDataFrame([("d", "x", "pv"), ("d", "y", None)], "dataset string, class_name string, canonical string")
    t = spark.createDataFrame([("pv",), ("chimney",)], "canonical string")
    got = {r.dataset: r for r in lifecycle.dataset_audit(s, m, t).collect()}
    assert (got["d"].ready, got["d"].reuse_confirmed, got["d"].classes, got["d"].mapped, got["d"].missing, got["d"].mixed_classes) == (True, True, 2, 1, "chimney", True)
    assert (got["e"].ready, got["e"].missing) == (False, "chimney,pv")


def test_comparisons_refuse_what_cannot_be_compared(spark):
    from gablestone.operators import benchmarks

    rows = [(1, "roofer", 0, True, 0.5, 1.0), (1, "city3d", 1, True, 0.2, 1.0), (2, "roofer", 0, True, 0.5, 1.0), (2, "roofer", 1, False, 0.1, 0.1), (3, "auto", 0, True, 0.1, 0.1), (4, "roofer", 0, False, 9.0, 9.0)]
    entries = spark.createDataFrame(rows, "building_id long, backend string, input_ord long, accepted boolean, rmse_m double, p95_m double")
    got = {r.building_id: (r.backends, r.accepted_ranking, r.error) for r in benchmarks.compared(spark.range(1, 6).toDF("building_id"), entries).collect()}
    assert got == {1: (["city3d", "roofer"], ["city3d", "roofer"], None), 2: (["roofer", "roofer"], None, benchmarks.DUPLICATES), 3: (["auto"], None, benchmarks.AUTOMATIC), 4: (["roofer"], [], None), 5: ([], None, benchmarks.NO_ENTRIES)}


def test_reports_become_entries(spark):
    from gablestone.operators import benchmarks

    key = "building_id long, backend string, lod string"
    geometry = spark.createDataFrame([(1, "roofer", "2.2", True, True, 8, 6, 0.9), (2, "auto", "2.2", True, True, 8, 6, 0.9)], f"{key}, geometry_valid boolean, watertight boolean, vertices long, faces long, iou double")
    fits = spark.createDataFrame([(1, "roofer", "2.2", 0.1, 0.2, 0.9), (2, "auto", "2.2", 0.1, 0.2, 0.9), (3, "city3d", "2.2", 0.1, 0.2, 0.9)], f"{key}, rmse_m double, p95_m double, within_050m double")
    gates = spark.createDataFrame([(1, "roofer", "2.2", True, "HIGH", ["x"]), (2, "auto", "2.2", True, "HIGH", [])], f"{key}, accepted boolean, confidence string, failures array<string>")
    got = {r.building_id: (r.vertices, r.rmse_m, r.failures, r.entry_error) for r in benchmarks.flattened(geometry, fits, gates).collect()}
    assert got == {1: (8, 0.1, ["x"], None), 2: (8, 0.1, [], benchmarks.AUTOMATIC), 3: (None, 0.1, None, "no report of geometry, quality")}


def test_taxonomies_are_checked_where_they_are_used(spark):
    from gablestone.operators import benchmarks

    taxonomy = spark.createDataFrame([("1", 0, "a"), ("1", 1, "b"), ("2", 0, "a"), ("2", 2, "b"), ("3", 0, "a"), ("3", 1, "a")], "version string, class_id int, canonical string")
    uses = spark.createDataFrame([("ok", "1", True, 0.2), ("none", "9", True, 0.2), ("gap", "2", True, 0.2), ("twice", "3", True, 0.2), ("flat", "1", False, 0.2), ("wide", "1", True, 1.0), ("plain", "1", False, 0.0)], "name string, version string, tiling boolean, overlap double")
    got = {r.name: r.error for r in benchmarks.taxonomy_checks(taxonomy, uses).collect()}
    assert got["ok"] is got["plain"] is None and got["none"] == "unknown taxonomy version" and "contiguous" in got["gap"] and "unique" in got["twice"] and "zero" in got["flat"] and "between" in got["wide"]
    mapping = spark.createDataFrame([("1", "x", "a"), ("1", "y", None), ("2", "x", "b")], "version string, class_name string, canonical string")
    assert {tuple(r) for r in benchmarks.missing_of(taxonomy, mapping).collect()} == {("1", "b"), ("2", "a"), ("3", "a")}


def test_files_are_gates_too(spark):
    points = spark.createDataFrame([(b, 1.0, 2) for b in range(1, 6)], "building_id long, z double, classification long")
    rings = spark.createDataFrame([(b, 0, 0, 5, True, "EPSG:25830") for b in range(1, 6)], "building_id long, polygon_id long, ring_id long, corners long, closed boolean, crs string")
    files = spark.createDataFrame([(1, "a/b.LAS", 10), (2, "a/b.txt", 10), (3, "a/b.laz", 0), (5, "x.laz", 5)], "building_id long, path string, bytes long")
    got = {r.building_id: r.errors for r in lifecycle.input_gates(points, rings, files).collect()}
    assert got == {1: "", 2: "not a point cloud file", 3: "empty file", 4: "no point cloud", 5: ""}


def test_models_are_written_with_their_materials(spark):
    v = spark.createDataFrame([(m, i, float(i), 0.0, 1.5) for m in (1, 2) for i in range(3)], "model_id long, vertex_idx long, x double, y double, z double")
    f = spark.createDataFrame([(m, 0, k, k, "RoofSurface", 0) for m in (1, 2) for k in range(3)] + [(2, 1, k, k, "RoofSurface", 1) for k in range(3)], "model_id long, face_id long, ordinal long, vertex_idx long, semantic string, ring_id long")
    got = {(r.model_id, r.file): (r.value, r.error) for r in lifecycle.obj_files(v, f).collect()}
    assert got.keys() == {(1, "1.obj"), (1, "1.mtl"), (2, None)} and got[2, None][1] == "interior rings cannot be written"
    assert got[1, "1.obj"][0].startswith("mtllib 1.mtl\no 1\nv 0.000 0.000 1.500\n") and got[1, "1.mtl"][0].startswith("newmtl RoofSurface\nKd 0.839 0.153 0.157\n\nnewmtl WallSurface")
