import json

import pytest
from pyspark.sql import functions as F

from gablestone.sources import registry

BUILDING = """<c xmlns:g="urn:g" xmlns:b="urn:b"><g:member><b:Building>
<b:externalReference><b:ExternalReference><b:reference>9876543ZZ</b:reference></b:ExternalReference></b:externalReference><b:localId>9876543ZZ.1</b:localId><b:namespace>XX.TEST</b:namespace>
<b:conditionOfConstruction>functional</b:conditionOfConstruction><b:numberOfDwellings>7</b:numberOfDwellings>{dates}
<b:officialArea><b:OfficialArea><b:officialAreaReference>gross</b:officialAreaReference><b:value>512.5</b:value></b:OfficialArea></b:officialArea>
<g:Surface srsName="{crs}"><g:LinearRing><g:posList{dim}>{ring}</g:posList></g:LinearRing></g:Surface></b:Building></g:member></c>"""
DATES = "<b:dateOfConstruction><b:DateOfEvent><b:beginning>1961-01-01T00:00:00</b:beginning>{end}</b:DateOfEvent></b:dateOfConstruction>"
GOOD = {"dates": DATES.format(end="<b:end>1963-01-01T00:00:00</b:end>"), "crs": "urn:ogc:def:crs:EPSG::25830", "dim": "", "ring": "0 0 4 0 4 3 0 0"}


@pytest.mark.parametrize("change, error", [
    ({}, None), ({"dates": DATES.format(end="")}, "construction period is incomplete"), ({"dates": ""}, None), ({"crs": "local"}, "unknown coordinate system"), ({"dim": ' srsDimension="3"'}, "rings are not flat"), ({"ring": "0 0 4"}, "a ring has an odd count of numbers"),
])
def test_buildings(spark, change, error):
    r = registry.buildings(spark.createDataFrame([(1, BUILDING.format(**{**GOOD, **change}))], "id long, xml string")).first()
    assert r.error == error
    if error is None:
        assert (r.building_id, r.reference, r.condition, r.dwellings, r.official_area_m2, r.crs, r.current_use) == ("XX.TEST.9876543ZZ.1", "9876543ZZ", "functional", 7, 512.5, "EPSG:25830", None)
        assert [(p.x, p.y) for p in r.rings[0]] == [(0, 0), (4, 0), (4, 3), (0, 0)] and (r.beginning is None) == (change.get("dates") == "")


def test_none_or_two_buildings(spark):
    two = BUILDING.format(**GOOD)
    inner = two[two.index("<g:member>") : two.index("</c>")]
    d = spark.createDataFrame([(1, "<c/>"), (2, two.replace("</c>", inner + "</c>"))], "id long, xml string")
    assert [r.error for r in registry.buildings(d).orderBy("id").collect()] == ["buildings: 0", "buildings: 2"]


def test_parts(spark):
    part = '<b:BuildingPart><b:localId>p{0}</b:localId><b:numberOfFloorsAboveGround>{0}</b:numberOfFloorsAboveGround><g:posList>0 0 1 1</g:posList></b:BuildingPart>'
    xml = f'<c xmlns:g="urn:g" xmlns:b="urn:b">{part.format(1)}{part.format(2)}</c>'
    got = registry.parts(spark.createDataFrame([(5, xml), (6, "<c/>")], "id long, xml string"), "id").orderBy("part").collect()
    assert [(r.id, r.part, r.local_id, r.floors_above, r.floors_below, r.rings) for r in got] == [(5, 0, "p1", 1, None, ["0 0 1 1"]), (5, 1, "p2", 2, None, ["0 0 1 1"])]


def test_coordinates(spark):
    xml = ["<r><n:cuerr xmlns:n='u'>0</n:cuerr><pc1>AAA</pc1><pc2>BBB</pc2><ldt> Main St 1 </ldt></r>", "<r><cuerr>1</cuerr><err><des>no such place</des><des>try again</des></err></r>", "<r/>", "<r><cuerr>0</cuerr><pc1>AAA</pc1></r>"]
    got = registry.coordinates(spark.createDataFrame(list(enumerate(xml)), "id long, xml string")).orderBy("id").collect()
    assert [(r.reference, r.address, r.error) for r in got] == [("AAABBB", "Main St 1", None), (None, None, "resolution failed: no such place; try again"), (None, None, "no error count"), (None, None, "no reference")]


def test_listing_and_asset_page(spark):
    row = "<TR class=x><td>{0}</td><td><a href='detalleArchivo?sec={1}'>x</a></td></TR>"
    name = "PNOA-2031-XYZ-500-4001-H30-NPC02.laz"
    pages = [row.format(name, 12) + row.format(name, 12) + row.format("other.laz", 13), row.format(name, 12) + row.format(name, 14), "nothing"]
    got = registry.listing(spark.createDataFrame(list(enumerate(pages)), "id long, html string"), "id").orderBy("id").collect()
    assert [(r.file, r.number, r.error) for r in got] == [(name, "12", None), (None, None, "assets found: 2"), (None, None, "assets found: 0")]
    page = "<p>secuencial = '77'</p><b>PNOA_2031_XYZ_500-4001_H30_npc02.LAZ</b> Densidad: <i>5,25&nbsp;ptos/m2</i> Tama&ntilde;o: 61.5 (Mb)"
    r = registry.asset_page(spark.createDataFrame([(1, page), (2, page.replace("ptos", "px"))], "id long, html string")).orderBy("id").collect()
    assert (r[0].number, r[0].flight_year, r[0].density_m2, r[0].size_mb, r[0].grid_cell, r[0].level, r[0].error) == ("77", 2031, 5.25, 61.5, "500-4001-H30", "NPC02", None)
    assert r[1].error == "no density" and r[1].file is None


def test_features_and_guards(spark, tmp_path):
    for i, g in enumerate([{"type": "Polygon", "coordinates": [[[1, 2], [3, 4], [1, 2]]]}, {"type": "MultiPolygon", "coordinates": [[[[1, 2]]], [[[5, 6]]]]}, {"type": "Point", "coordinates": [1, 2]}]):
        (tmp_path / f"{i}.geojson").write_text(json.dumps({"type": "Feature", "id": str(i), "geometry": g}, indent=1))
    got = registry.building_features(spark, str(tmp_path)).orderBy("building_id", "polygon_id", "ordinal").collect()
    assert [(r.building_id, r.polygon_id, r.ordinal, r.lon, r.error) for r in got] == [("0", 0, 0, 1, None), ("0", 0, 1, 3, None), ("0", 0, 2, 1, None), ("1", 0, 0, 1, None), ("1", 1, 0, 5, None), ("2", None, None, None, "not a polygon")]
    d = spark.createDataFrame([("R", None, None), ("R", 1.0, None), (None, 1.0, 2.0), (None, None, 2.0), (None, 1.0, 95.0)], "r string, lon double, lat double")
    assert [r[0] is None for r in d.select(registry.query_error(F.col("r"), F.col("lon"), F.col("lat"))).collect()] == [True, False, True, False, False]
    d = spark.createDataFrame([(1.0, "a.OBJ"), (float("nan"), "b.city.jsonl"), (float("inf"), "c.LAZ"), (None, "d.txt")], "v double, p string")
    assert [tuple(r) for r in d.select(registry.finite("v"), registry.file_kind(F.col("p"))).collect()] == [(True, "mesh"), (False, "city"), (False, "cloud"), (False, None)]
