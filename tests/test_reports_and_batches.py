"""Typed reports there and back, what strict reading refuses, and batches with failed rows."""

import json

import pytest
from pyspark.sql import functions as F

from gablestone.operators import batch
from gablestone.sources import reports

PLANE = {"plane": 0, "support": 40, "nx": 0.0, "ny": 0.5, "nz": 1, "slope_deg": 1.0, "aspect_deg": None, "median_m": 0.1, "p95_m": 0.2}
VALUES = {"boolean": True, "integer": 3, "long": 4, "double": 2.5, "string": "x"}


def example(kind):
    """A value of a type, as StructType.jsonValue() has it."""
    if isinstance(kind, str):
        return VALUES[kind]
    if kind["type"] == "struct":
        return {f["name"]: example(f["type"]) for f in kind["fields"]}
    return [example(kind["elementType"])] if kind["type"] == "array" else {"k": example(kind["valueType"])}


def document(name, **change):
    return json.dumps(example(reports.schema(name).jsonValue()) | {"schema_version": 1, "kind": name, "building_id": "b"} | change)


@pytest.mark.parametrize("kind", reports.KINDS)
def test_every_kind_goes_there_and_back(spark, kind):
    text = document(kind)
    got = reports.decode(spark.createDataFrame([(text,)], "value string"), kind)
    assert got.first().report_error is None
    again = reports.encode(got, kind).first()
    assert again.building_id == "b" and json.loads(again.value) == json.loads(text)


def test_fields_that_may_be_null_may_be_absent(spark):
    text = json.loads(document("lod_feasibility"))
    del text["highest_lod"]
    got = reports.decode(spark.createDataFrame([(json.dumps(text),)], "value string"), "lod_feasibility").first()
    assert got.report_error is None and got.highest_lod is None and json.loads(reports.encode(spark.createDataFrame([got], "building_id string, lod12 boolean, lod13 boolean, lod22 boolean, lod12_score double, lod13_score double, lod22_score double, highest_lod string, lod12_reasons array<string>, lod13_reasons array<string>, lod22_reasons array<string>, report_error string"), "lod_feasibility").first().value)["highest_lod"] is None


@pytest.mark.parametrize("change, error", [
    ({"extra": 1}, "extra: unknown field"), ({"explained": "1"}, "explained: not a double"), ({"explained": True}, "explained: not a double"), ({"explained": None}, "explained: missing"), ({"kind": "lidar_fit"}, "kind: lidar_fit, not roof_planes"),
    ({"schema_version": 2}, "schema_version: 2, not 1"), ({"schema_version": None}, "schema_version: missing"), ({"planes": {}}, "planes: not a list"), ({"planes": [3]}, "planes[0]: not an object"), ({"building_id": 7}, "building_id: not a string"),
    ({"planes": [PLANE | {"nx": "a"}]}, "planes[0].nx: not a double"),
    ({"planes": [PLANE | {"colour": 1}]}, "planes[0].colour: unknown field"),
    ({"planes": [PLANE | {"plane": 2.5}]}, "planes[0].plane: not an integer"),
])
def test_what_is_wrong_is_named_by_its_path(spark, change, error):
    rows = spark.createDataFrame([(1, document("roof_planes", **change)), (2, document("roof_planes"))], "line long, value string")
    got = {r.line: r for r in reports.decode(rows, "roof_planes").collect()}
    assert got[1].report_error == error and got[1].planes is None and got[2].report_error is None and len(got[2].planes) == 1


@pytest.mark.parametrize("text", [None, "", "{", "[]", "3", '{"explained": NaN}'])
def test_what_is_no_document_is_a_row(spark, text):
    error = reports.decode(spark.createDataFrame([(text,)], "value string"), "roof_planes").first().report_error
    assert error.startswith("no JSON") or error == ": not an object"
    with pytest.raises(ValueError):
        reports.schema("no_such_kind")


def test_reports_are_written_by_kind(spark, tmp_path):
    rows = spark.createDataFrame([(1, "b", True, "HIGH", ["x"])], "n long, building_id string, accepted boolean, confidence string, failures array<string>")
    for _ in range(2):
        reports.write(rows, "quality_gate", str(tmp_path / "r"))
    got = reports.read(spark, str(tmp_path / "r"), "quality_gate").collect()
    assert [(r.building_id, r.accepted, r.failures, r.report_error) for r in got] == [("b", True, ["x"], None)] * 2


def test_batches_keep_failed_buildings(spark):
    selection = spark.createDataFrame([(b, "p") for b in range(1, 7)], "building_id long, profile string")
    inputs = spark.createDataFrame([(1, True, True), (2, False, True), (3, True, False), (4, True, True), (5, True, True)], "building_id long, footprint boolean, image boolean")
    raw = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (4, "a")], "building_id long, class_name string")
    kept = spark.createDataFrame([(1, "b"), (1, "b"), (1, "a"), (4, "a")], "building_id long, class_name string")
    entries = batch.roof_objects(selection, inputs, raw, kept, spark.createDataFrame([(4, "OSError: x"), (4, "later")], "building_id long, error string"))
    got = {r.building_id: (r.status, r.raw_candidates, r.retained_objects, r.retained_classes, r.error) for r in entries.collect()}
    assert got == {1: ("completed", 2, 3, '{"a":1,"b":2}', None), 2: ("failed", 0, 0, "{}", batch.NO_FOOTPRINT), 3: ("failed", 0, 0, "{}", batch.NO_IMAGE), 4: ("failed", 0, 0, "{}", "OSError: x"), 5: ("completed", 0, 0, "{}", None), 6: ("failed", 0, 0, "{}", batch.NO_FOOTPRINT)}
    assert tuple(batch.roof_object_summary(entries).first()) == (6, 2, 4, 2, 3)
    assert batch.roof_objects(selection, inputs, raw, kept).where("status = 'completed'").count() == 3
    assert tuple(batch.roof_object_summary(entries.limit(0)).first()) == (0, 0, 0, 0, 0)


def test_catalogue_audit_keeps_failed_cells(spark):
    cells = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (3, "c"), (4, "a"), (4, "a")], "building_id long, cell_id string")
    found = spark.createDataFrame([("a", "u/a", 2016, 0.5, None), ("b", None, None, None, "TimeoutError: x")], "cell_id string, url string, year int, density double, error string")
    rows = batch.catalogue(cells, found)
    got = {r.building_id: (r.status, r.grid_cells, r.asset_urls, r.flight_years, r.failed_cells) for r in rows.collect()}
    assert got == {1: ("partial_coverage", ["a", "b"], ["u/a"], [2016], ["b"]), 2: ("catalog_unavailable", ["b"], [], [], ["b"]), 3: ("catalog_unavailable", ["c"], [], [], ["c"]), 4: ("catalog_verified", ["a"], ["u/a"], [2016], [])}
    r = batch.catalogue_summary(rows).first()
    assert (r.selected_buildings, r.catalog_verified_buildings, r.partial_coverage_buildings, r.catalog_unavailable_buildings, r.unique_grid_cells, r.verified_cells, r.failed_cells) == (4, 1, 1, 2, 3, 1, 2)
    assert rows.where(F.col("status").isNull()).isEmpty()
