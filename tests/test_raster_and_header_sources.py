"""Raster files, numpy grids and tables of LAS headers."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablestone.sources import grids, las, tiff


def written(spark, tmp_path, kind="f4", nodata=-9999.0, width=600, height=300):
    rows = [("a", r, c, float((r * 7 + c * 3) % 200)) for r in range(0, height, 3) for c in range(0, width, 2)] + [("b", 0, 0, 5.0), ("b", 99, 99, 1.0)]
    values = spark.createDataFrame(rows, "raster string, row long, col long, value double")
    own = spark.createDataFrame([("a", 1000.0, 5000.0, 2.0, width, height), ("b", 0.0, 10.0, 1.0, 4, 3), ("c", 0.0, 10.0, 1.0, 2, 2)], "raster string, west double, north double, pixel double, width int, height int")
    return rows, tiff.write(values, own, str(tmp_path / "out"), kind, 25830, nodata)


@pytest.mark.parametrize("kind, nodata", [("f4", -9999.0), ("u1", None), ("i2", -1.0), ("f8", -9999.0)])
def test_rasters_go_there_and_back(spark, tmp_path, kind, nodata):
    rows, files = written(spark, tmp_path, kind, nodata)
    assert {r.raster for r in files.collect()} == {"a", "b", "c"}
    heads = {r.file: r for r in tiff.headers(spark, str(tmp_path / "out")).collect()}
    a = heads["a.tif"]
    assert (a.width, a.height, a.bands, a.kind, a.west, a.north, a.pixel_x, a.epsg, a.nodata, a.error) == (600, 300, 1, kind, 1000.0, 5000.0, 2.0, 25830, nodata, None)
    got = tiff.cells(tiff.tiles(spark, str(tmp_path / "out"))).where("value is not null" if nodata is not None else "value <> 0")
    want = {(f"{n}.tif", r, c): v for n, r, c, v in rows if (n != "b" or r < 3) and (v != 0 or nodata is not None)}
    assert {(r.file, r.row, r.col): r.value for r in got.collect()} == want
    one = tiff.cells(tiff.tiles(spark, str(tmp_path / "out"))).where("file = 'a.tif' and row = 3 and col = 4").first()
    assert (one.x, one.y) == (1000 + 4.5 * 2, 5000 - 3.5 * 2)


def test_only_tiles_that_are_met_are_read(spark, tmp_path):
    rows, _ = written(spark, tmp_path)
    path, box = str(tmp_path / "out"), (1600.0, 4700.0, 1700.0, 4760.0)
    met = tiff.tiles(spark, path, box)
    assert tiff.tiles(spark, path).where("file = 'a.tif'").count() == 6 and [(r.trow, r.tcol) for r in met.collect()] == [(0, 1)]
    got = {(r.row, r.col) for r in tiff.cells(met, box).collect()}
    assert got == {(r, c) for r in range(300) for c in range(600) if box[0] <= 1000 + (c + 0.5) * 2 <= box[2] and box[1] <= 5000 - (r + 0.5) * 2 <= box[3]}
    # The bytes of the other tiles can be anything.
    file = tmp_path / "out" / "a.tif"
    data, keep = bytearray(file.read_bytes()), met.first()
    for t in tiff.tiles(spark, path).where("file = 'a.tif'").collect():
        if t["at"] != keep["at"]:
            data[t["at"] : t["at"] + t["size"]] = b"\1" * t["size"]
    file.write_bytes(data)
    assert {(r.row, r.col) for r in tiff.cells(met, box).collect()} == got
    with pytest.raises(Exception):
        tiff.cells(tiff.tiles(spark, path)).count()


def test_points_are_sampled(spark, tmp_path):
    written(spark, tmp_path)
    points = spark.createDataFrame([(1, 1000.5, 4999.5), (2, 1009.0, 4993.0), (3, 1003.0, 4999.0), (4, 0.0, 0.0), (5, None, 1.0), (6, 2199.9, 4400.1)], "k long, x double, y double")
    wanted = tiff.tiles(spark, str(tmp_path / "out")).where("file = 'a.tif'")
    got = {r.k: r.value for r in tiff.sampled(points, wanted, 25830).collect()}
    assert got == {1: 0.0, 2: float((3 * 7 + 4 * 3) % 200), 3: None, 4: None, 5: None, 6: None}
    with pytest.raises(ValueError, match="EPSG:25830, points in EPSG:4326"):
        tiff.sampled(points, wanted, 4326)


def hand_made(order, kind, cells, predictor=1, compression=1, planar=False, rows_per_strip=2, big=False):
    """A striped file, written from the format's description; cells: rows, columns, bands."""
    h, w, n = cells.shape
    planes = [cells[:, :, [k]] for k in range(n)] if planar else [cells]
    strips = []
    for plane in planes:
        for r in range(0, h, rows_per_strip):
            part = plane[r : r + rows_per_strip]
            if predictor == 2:
                part = np.concatenate([part[:, :1], np.diff(part, axis=1)], 1)
            raw = part.astype(order + kind).tobytes()
            if predictor == 3:
                b = np.frombuffer(part.astype(">" + kind).tobytes(), np.uint8).reshape(len(part), -1, int(kind[1]))
                b = np.ascontiguousarray(b.transpose(0, 2, 1)).reshape(len(part), -1, plane.shape[2])
                raw = np.concatenate([b[:, :1], np.diff(b, axis=1)], 1).astype(np.uint8).tobytes()
            strips.append(zlib.compress(raw) if compression != 1 else raw)
    sample = {"u": 1, "i": 2, "f": 3}[kind[0]]
    head = 16 if big else 8
    at, places = head, []
    for s in strips:
        places.append(at)
        at += len(s)
    entries = [
        (256, 4, [w]), (257, 4, [h]), (258, 3, [8 * int(kind[1])] * n), (259, 3, [compression]), (273, 4, places), (277, 3, [n]), (278, 4, [rows_per_strip]), (279, 4, [len(s) for s in strips]), (284, 3, [2 if planar else 1]), (317, 3, [predictor]), (339, 3, [sample] * n),
        (33550, 12, [0.5, 0.25, 0.0]), (33922, 12, [1.0, 2.0, 0.0, 10.0, 20.0, 0.0]), (34735, 3, [1, 1, 0, 1, 2048, 0, 1, 4326]),
    ]
    directory, code = at, {3: "H", 4: "I", 12: "d"}
    count, wide, inline = ("Q", "Q", 8) if big else ("H", "I", 4)
    size = struct.calcsize(order + count) + len(entries) * (20 if big else 12) + inline
    body, extra = struct.pack(order + count, len(entries)), b""
    for tag, t, v in entries:
        packed = struct.pack(f"{order}{len(v)}{code[t]}", *v)
        field = packed.ljust(inline, b"\0") if len(packed) <= inline else struct.pack(order + wide, directory + size + len(extra))
        extra += packed if len(packed) > inline else b""
        body += struct.pack(f"{order}HH{wide}", tag, t, len(v)) + field
    begin = struct.pack(order + "2sHHHQ", b"II" if order == "<" else b"MM", 43, 8, 0, directory) if big else struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, directory)
    return begin + b"".join(strips) + body + b"\0" * inline + extra


@pytest.mark.parametrize("order, kind, predictor, compression, planar, big", [("<", "u2", 2, 8, False, False), (">", "i2", 1, 1, False, False), (">", "f4", 3, 32946, False, False), ("<", "f8", 3, 8, False, True), ("<", "u1", 2, 8, True, False), (">", "u4", 2, 8, False, True)])
def test_files_of_all_kinds(spark, tmp_path, order, kind, predictor, compression, planar, big):
    rng = np.random.default_rng(2)
    cells = rng.integers(0, 100, (5, 7, 2)).astype(kind)
    (tmp_path / "x.tif").write_bytes(hand_made(order, kind, cells, predictor, compression, planar, big=big))
    h = tiff.headers(spark, str(tmp_path)).first()
    assert (h.error, h.bands, h.epsg, h.west, h.north) == (None, 2, 4326, 9.5, 20.5)
    got = tiff.cells(tiff.tiles(spark, str(tmp_path))).collect()
    assert {(r.row, r.col, r.band): r.value for r in got} == {(r, c, b + 1): float(cells[r, c, b]) for r in range(5) for c in range(7) for b in range(2)}


def test_what_cannot_be_read_is_a_row(spark, tmp_path):
    good = hand_made("<", "u1", np.ones((2, 2, 1), "u1"))
    for name, data in (("lzw", hand_made("<", "u1", np.ones((2, 2, 1), "u1"), compression=5)), ("text", b"hello there, no raster"), ("cut", good[: len(good) - 160]), ("good", good)):
        (tmp_path / f"{name}.tif").write_bytes(data)
    got = {r.file: r.error for r in tiff.headers(spark, str(tmp_path)).collect()}
    assert got["good.tif"] is None and got["lzw.tif"] == "compression 5 is not read" and "not a TIFF" in got["text.tif"] and got["cut.tif"]
    assert {r.file for r in tiff.cells(tiff.tiles(spark, str(tmp_path))).collect()} == {"good.tif"}


def test_grids_go_there_and_back(spark, tmp_path):
    cells = spark.createDataFrame([("b1", 0, 0, 5.5, 2, 10.0, 20.0, 0.5), ("b1", 2, 1, None, 0, 10.0, 20.0, 0.5), ("b2", 0, 0, 1.0, 1, 0.0, 0.0, 1.0)], "building_id string, row long, col long, height double, points long, ox double, oy double, resolution double")
    assert grids.write(cells, str(tmp_path / "g"), height_percentile=90.0).count() == 2
    with np.load(tmp_path / "g" / "b1.npz") as data:
        assert data["elevation_m"].shape == (3, 2) and data["footprint_mask"].sum() == 2 and data["valid_mask"].sum() == 1 and float(data["height_percentile"]) == 90 and str(data["crs"]) == "EPSG:25830"
    (tmp_path / "g" / "bad.npz").write_bytes(b"nothing")
    got = {(r.building_id, r.row, r.col): (r.height, r.points, r.valid, r.ox, r.oy, r.resolution, r.crs) for r in grids.read(spark, str(tmp_path / "g")).where("error is null").collect()}
    assert got == {("b1", 0, 0): (5.5, 2, True, 10, 20, 0.5, "EPSG:25830"), ("b1", 2, 1): (None, 0, False, 10, 20, 0.5, "EPSG:25830"), ("b2", 0, 0): (1, 1, True, 0, 0, 1, "EPSG:25830")}
    assert [r.building_id for r in grids.read(spark, str(tmp_path / "g")).where("error is not null").collect()] == ["bad"]
    deep = cells.selectExpr("building_id", "row", "col", "height as above_ground", "height - 1 as elevation", "ox", "oy", "resolution")
    grids.write(deep, str(tmp_path / "n"), grids.NORMALIZED, terrain_source="t")
    assert grids.read(spark, str(tmp_path / "n"), grids.NORMALIZED).where("elevation = 4.5 and above_ground = 5.5").count() == 1


def test_headers_are_a_table_that_plans_the_ranges(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(7)
    for k in range(6):
        folder = tmp_path / f"d{k % 2}"
        folder.mkdir(exist_ok=True)
        xyz = rng.uniform(100 * k, 100 * k + 50, (500, 3))
        las.write(str(folder / f"{k}.las"), *xyz.T, np.full(500, 6))
    (tmp_path / "bad.las").write_bytes(b"no points here")
    whole = (tmp_path / "d0" / "0.las").read_bytes()
    (tmp_path / "short.LAS").write_bytes(whole[:-100])
    heads = las.headers(spark, str(tmp_path)).cache()
    errors = {r.file: r.error for r in heads.where("error is not null").collect()}
    assert errors.keys() == {"bad.las", "short.LAS"} and errors["short.LAS"] == "shorter than its points" and heads.count() == 8
    r = heads.where("file = '3.las'").first()
    assert (r.version, r.point_format, r["count"], r.crs) == ("1.4", 6, 500, None) and r.dimensions[:4] == ["X", "Y", "Z", "intensity"] and r.min[0] >= 300 and r.scale == [0.001] * 3
    monkeypatch.setattr(las, "_head", None)  # the driver opens no file
    every = las.scan(spark, str(tmp_path), range_points=200)
    assert every.count() == 3000 and every.groupBy("tile").count().where("count = 500").count() == 6
    box = (300.0, 300.0, 320.0, 350.0)
    some = las.scan(spark, str(tmp_path), box, heads)
    assert some.select("tile").distinct().collect()[0].tile == "3.las" and some.count() == every.where(F.col("x").between(300, 320) & F.col("y").between(300, 350)).count()


def test_coordinate_systems_of_point_files(tmp_path):
    def head(records):
        body = b"".join(struct.pack("<H16sHH32s", 0, b"LASF_Projection", k, len(v), b"") + v for k, v in records)
        data = bytearray(375) + body
        data[:4] = b"LASF"
        struct.pack_into("<HII", data, 94, 375, 375 + len(body), len(records))
        return bytes(data)

    keys = struct.pack("<12H", 1, 1, 0, 2, 2048, 0, 1, 4258, 3072, 0, 1, 25830)
    text = b'PROJCS["x",GEOGCS["y",AUTHORITY["EPSG","4258"]],AUTHORITY["EPSG","25831"]]'
    assert las.coordinate_system(head([(34735, keys)])) == "EPSG:25830" and las.coordinate_system(head([(34735, keys), (2112, text)])) == "EPSG:25831"
    assert las.coordinate_system(head([])) is None and las.coordinate_system(head([(2112, b"LOCAL_CS")])) is None
    assert las.dimensions(8)[-4:] == ["red", "green", "blue", "nir"] and "gps_time" in las.dimensions(3)


def test_cells_and_points_are_not_broadcast(spark, tmp_path):
    """Sizes of what comes out of Python are not known beforehand; only the list of files may pass the driver."""
    written(spark, tmp_path)
    points = spark.range(50).selectExpr("id as k", "1000D + id as x", "4999D - id as y")
    plan = tiff.sampled(points, tiff.tiles(spark, str(tmp_path / "out")), 25830)._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [" in line and " row#" in line]
    assert joins and all("SortMergeJoin" in j for j in joins)
