"""Raster files: tiled or striped TIFFs as tables of headers, tiles and cells, and written again.

Headers are read in tasks and are a table: which tiles a box or some points need is a filter on rows, and only those tiles
are read, each by its own range of bytes. Cells are long: file, band, row, col, the centre x, y and the value, NULL where the file
says that there is none. Read: byte order of both kinds, classic and big files, integers and floats, no compression or deflate,
horizontal and floating-point prediction, bands side by side or in planes. Anything else is a row with an error. Written: classic
files, one band, deflate, 256-cell tiles, with place and coordinate system."""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablestone.operators.shared import cut, uri

TILE = 256
#: Tiles of a task.
DEALT = 64
_SIZES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("2I", 8), 6: ("b", 1), 8: ("h", 2), 9: ("i", 4), 10: ("2i", 8), 11: ("f", 4), 12: ("d", 8), 13: ("I", 4), 16: ("Q", 8), 17: ("q", 8), 18: ("Q", 8)}
_KINDS = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (1, 64): "u8", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (2, 64): "i8", (3, 32): "f4", (3, 64): "f8"}
HEADER = (
    "file string, path string, width long, height long, bands int, kind string, order string, tile_width long, tile_height long, compression int, predictor int, planar boolean, west double, north double, pixel_x double, pixel_y double, epsg int, nodata double, error string"
)
INDEX = "plane int, trow long, tcol long, at long, size long"


def _open(path: str):
    from urllib.parse import unquote

    from pyarrow import fs

    where, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    return where.open_input_file(unquote(inner) if where.type_name == "local" else inner)


def _tags(f) -> tuple[str, dict]:
    """(byte order, values by tag) of the first directory."""
    head = f.read_at(16, 0)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack_from(f"{order}H", head, 2)[0] if order else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    big = version == 43
    at, = struct.unpack_from(f"{order}{'Q' if big else 'I'}", head, 8 if big else 4)
    wide, entry, inline = (8, 20, 8) if big else (2, 12, 4)
    n, = struct.unpack(f"{order}{'Q' if big else 'H'}", f.read_at(wide, at))
    data, out = f.read_at(n * entry, at + wide), {}
    for k in range(n):
        tag, kind = struct.unpack_from(f"{order}HH", data, k * entry)
        count, = struct.unpack_from(f"{order}{'Q' if big else 'I'}", data, k * entry + 4)
        if kind not in _SIZES:
            continue
        code, size = _SIZES[kind]
        place = k * entry + (12 if big else 8)
        if count * size <= inline:
            raw = data[place : place + count * size]
        else:
            raw = f.read_at(count * size, struct.unpack_from(f"{order}{'Q' if big else 'I'}", data, place)[0])
        out[tag] = raw if kind == 2 else struct.unpack(f"{order}{count * len(code.lstrip('2')) * (2 if code[0] == '2' else 1)}{code[-1]}", raw)
    return order, out


def header(f) -> tuple[dict, list[tuple]]:
    """(columns of HEADER, rows of INDEX) of an open file."""
    order, tags = _tags(f)
    one = lambda tag, default: tags.get(tag, (default,))[0]
    width, height, bands = one(256, 0), one(257, 0), one(277, 1)
    kinds = {_KINDS.get((s, b)) for s, b in zip(tags.get(339, (1,) * bands), tags.get(258, (1,) * bands))}
    tiled = 322 in tags
    tw, th = (one(322, 0), one(323, 0)) if tiled else (width, min(one(278, height), height))
    scale, tie = tags.get(33550), tags.get(33922)
    keys = tags.get(34735, ())
    epsg = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
    compression, predictor, planar = one(259, 1), one(317, 1), one(284, 1) == 2
    kind = kinds.pop() if len(kinds) == 1 else None
    error = None
    if not width or not height or not tw or not th:
        error = "no size"
    elif kind is None:
        error = "cells of this kind are not read"
    elif compression not in (1, 8, 32946):
        error = f"compression {compression} is not read"
    elif predictor not in (1, 2, 3) or (predictor == 3) != (predictor == 3 and kind[0] == "f"):
        error = f"predictor {predictor} is not read"
    elif not scale or not tie:
        error = "no place"
    text = tags.get(42113, b"").split(b"\0")[0].strip()
    west, north = (tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1]) if scale and tie else (None, None)
    h = {
        "width": width, "height": height, "bands": bands, "kind": kind, "order": order, "tile_width": tw, "tile_height": th, "compression": compression, "predictor": predictor, "planar": planar and bands > 1, "west": west, "north": north,
        "pixel_x": scale[0] if scale else None, "pixel_y": scale[1] if scale else None, "epsg": epsg.get(3072, epsg.get(2048)), "nodata": float(text) if text else None, "error": error,
    }
    offsets, sizes = (tags.get(324, ()), tags.get(325, ())) if tiled else (tags.get(273, ()), tags.get(279, ()))
    across, down = -(-width // max(tw, 1)), -(-height // max(th, 1))
    index = [(k // (across * down), k // across % down, k % across, a, n) for k, (a, n) in enumerate(zip(offsets, sizes))]
    return h, index


def _listed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")


def _read_headers(spark: SparkSession, path: str, index: bool) -> DataFrame:
    names = [c.split()[0] for c in HEADER.split(", ")]

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                own = {"file": path.rpartition("/")[2], "path": path}
                try:
                    with _open(path) as f:
                        h, tiles = header(f)
                except Exception as e:  # one broken file is one row
                    h, tiles = {"error": f"{type(e).__name__}: {e}"}, []
                rows += [[(own | h).get(n) for n in names] + list(t) for t in (tiles if index else [()])]
            out = pd.DataFrame(rows, columns=names + [c.split()[0] for c in INDEX.split(", ")] * index, dtype=object)
            yield out

    return _listed(spark, path).mapInPandas(run, HEADER + (f", {INDEX}" if index else ""))


def headers(spark: SparkSession, path: str) -> DataFrame:
    """A row a file: its size, cells, place, coordinate system (EPSG number), and what keeps it from being read."""
    return _read_headers(spark, path, False)


def tiles(spark: SparkSession, path: str, bbox: tuple | None = None) -> DataFrame:
    """A row for each tile of the readable files, with its box (x1, y1, x2, y2); of those that touch a box only, if there is one."""
    rows = _read_headers(spark, path, True).where("error is null and size > 0")
    rows = rows.withColumn("x1", F.expr("west + tcol * tile_width * pixel_x")).withColumn("y2", F.expr("north - trow * tile_height * pixel_y"))
    rows = rows.withColumn("x2", F.expr("least(west + width * pixel_x, x1 + tile_width * pixel_x)")).withColumn("y1", F.expr("greatest(north - height * pixel_y, y2 - tile_height * pixel_y)"))
    return rows if bbox is None else rows.where((F.col("x1") <= bbox[2]) & (F.col("x2") >= bbox[0]) & (F.col("y1") <= bbox[3]) & (F.col("y2") >= bbox[1]))


def _decoded(raw: bytes, t: dict):
    """(rows, columns, bands) of one tile's bytes."""
    import zlib

    import numpy as np

    data = zlib.decompress(raw) if t["compression"] != 1 else raw
    bands = 1 if t["planar"] else t["bands"]
    kind = np.dtype(t["order"] + t["kind"])
    w, n = t["tile_width"], kind.itemsize
    if t["predictor"] == 3:  # bytes of the cells' places in turn, each row differenced
        rows = np.frombuffer(data, np.uint8).reshape(-1, w * bands * n)
        rows = np.add.accumulate(rows.reshape(len(rows), -1, bands), axis=1, dtype=np.uint8).reshape(len(rows), n, w * bands)
        return np.ascontiguousarray(rows.transpose(0, 2, 1)).view(f">{t['kind']}").reshape(len(rows), w, bands)
    cells = np.frombuffer(data[: len(data) // (w * bands * n) * (w * bands * n)], kind).reshape(-1, w, bands)
    return np.add.accumulate(cells.astype(t["kind"]), axis=1, dtype=t["kind"]) if t["predictor"] == 2 else cells


CELLS = "file string, band int, row long, col long, x double, y double, value double"


def cells(wanted: DataFrame, bbox: tuple | None = None) -> DataFrame:
    """The cells of tiles() (all or some), those whose centre is in a closed box only, if there is one; NULL where a file has no value. A tile
    that cannot be decoded ends the job: its file said that it can."""
    tasks = max(1, -(-wanted.count() // DEALT))
    names = ["file", "path", "width", "height", "bands", "kind", "order", "tile_width", "tile_height", "compression", "predictor", "planar", "west", "north", "pixel_x", "pixel_y", "nodata", "plane", "trow", "tcol", "at", "size"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held, at = None, None
        for b in batches:
            for t in b.to_pylist():
                if t["path"] != at:
                    held, at = _open(t["path"]), t["path"]
                tile = _decoded(held.read_at(t["size"], t["at"]), t)
                r0, c0 = t["trow"] * t["tile_height"], t["tcol"] * t["tile_width"]
                tile = tile[: min(t["tile_height"], t["height"] - r0), : t["width"] - c0]
                row, col, band = (x.ravel() for x in np.indices(tile.shape))
                value, row, col, band = tile.ravel().astype(float), row + r0, col + c0, band + t["plane"] + 1
                x, y = t["west"] + (col + 0.5) * t["pixel_x"], t["north"] - (row + 0.5) * t["pixel_y"]
                none = np.isnan(value) | (value == t["nodata"] if t["nodata"] is not None else False)
                columns = [band.astype(np.int32), row, col, x, y, value]
                if bbox is not None:
                    inside = (x >= bbox[0]) & (x <= bbox[2]) & (y >= bbox[1]) & (y <= bbox[3])
                    columns, none = [c[inside] for c in columns], none[inside]
                file = pa.array([t["file"]] * len(none), pa.string())
                yield pa.RecordBatch.from_arrays([file, *map(pa.array, columns[:-1]), pa.array(columns[-1], mask=none)], names=[c.split()[0] for c in CELLS.split(", ")])

    dealt = wanted.select(*names).repartitionByRange(tasks, "path", "at") if tasks > 1 else wanted.select(*names).coalesce(1)
    return dealt.mapInArrow(run, CELLS)


def channels(read: DataFrame) -> DataFrame:
    """file, band, low and high of the values of cells()."""
    return read.groupBy("file", "band").agg(F.min("value").alias("low"), F.max("value").alias("high"))


def sampled(points: DataFrame, wanted: DataFrame, epsg: int) -> DataFrame:
    """points (with x, y) with the value of the first band at each, NULL outside and where there is none; only tiles in which points
    lie are read. wanted: the tiles() of one coverage in the coordinate system of the points; another one is an error."""
    other = [r["epsg"] for r in wanted.where(~F.col("epsg").eqNullSafe(F.lit(epsg))).select("epsg").distinct().limit(3).collect()]
    if other:
        raise ValueError(f"rasters are in {', '.join(f'EPSG:{e}' if e else 'no declared system' for e in other)}, points in EPSG:{epsg}")
    grid = wanted.select("file", "west", "north", "pixel_x", "pixel_y", "width", "height").distinct()  # a row a file
    at = lambda a, b: F.floor(F.expr(a) / F.col(b))
    key = points.withColumn("point_", F.monotonically_increasing_id()) if not {"point_"} & set(points.columns) else points
    key = cut(key)
    placed = key.select("point_", "x", "y").join(F.broadcast(grid) if grid.count() <= 10_000 else grid, F.expr("x >= west and x < west + width * pixel_x and y <= north and y > north - height * pixel_y"))
    placed = placed.select("point_", "file", at("x - west", "pixel_x").alias("col"), at("north - y", "pixel_y").alias("row"))
    need = placed.join(wanted.select("file", "tile_width", "tile_height").distinct(), "file").select("file", F.floor(F.col("row") / F.col("tile_height")).alias("trow"), F.floor(F.col("col") / F.col("tile_width")).alias("tcol")).distinct()
    met = cells(wanted.join(need, ["file", "trow", "tcol"], "left_semi")).where("band = 1").select("file", "row", "col", "value")
    # Spark takes the cells for as many bytes as the list of tiles and would send all of them through the driver.
    values = placed.join(met.hint("merge"), ["file", "row", "col"]).groupBy("point_").agg(F.min_by("value", "file").alias("value"))
    return key.join(values.hint("merge"), "point_", "left").drop("point_")


def _head(width: int, height: int, sizes: list[int], kind: str, west: float, north: float, pixel: float, epsg: int, nodata: float | None) -> bytes:
    """All of a file that stands before its tiles."""
    sample, bits = {"u": 1, "i": 2, "f": 3}[kind[0]], 8 * int(kind[1:])
    keys = (1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, epsg)
    n = len(sizes)
    text = b"" if nodata is None else f"{nodata:.17g}".encode() + b"\0"
    entries = [
        (256, "I", [width]), (257, "I", [height]), (258, "H", [bits]), (259, "H", [8]), (262, "H", [1]), (277, "H", [1]), (322, "I", [TILE]), (323, "I", [TILE]), (324, "I", [0] * n), (325, "I", sizes), (339, "H", [sample]),
        (33550, "d", [pixel, pixel, 0.0]), (33922, "d", [0.0, 0.0, 0.0, west, north, 0.0]), (34735, "H", keys), *([(42113, "s", text)] if text else []),
    ]
    codes = {"H": 3, "I": 4, "d": 12, "s": 2}
    directory = 2 + 12 * len(entries) + 4
    at, extra, body = 8 + directory, b"", []
    for tag, code, values in entries:
        count = len(values)
        packed = values if code == "s" else struct.pack(f"<{count}{code}", *values)
        body.append([tag, codes[code], count, packed, None])
        if len(packed) > 4:
            body[-1][4] = at + len(extra)
            extra += packed + b"\0" * (len(packed) % 2)
    first = at + len(extra)
    places = [first + sum(sizes[:0])]
    for s in sizes[:-1]:
        places.append(places[-1] + s)
    packed = struct.pack(f"<{n}I", *places)
    for e in body:
        if e[0] == 324:
            if e[4] is None:
                e[3] = packed
            else:
                extra = extra[: e[4] - at] + packed + extra[e[4] - at + len(packed) :]
    out = struct.pack("<2sHIH", b"II", 42, 8, len(body))
    for tag, code, count, data, where in body:
        out += struct.pack("<HHI", tag, code, count) + (data.ljust(4, b"\0") if where is None else struct.pack("<I", where))
    return out + struct.pack("<I", 0) + extra


def write(values: DataFrame, grids: DataFrame, path: str, kind: str = "f4", epsg: int = 25830, nodata: float | None = -9999.0) -> DataFrame:
    """A file path/<raster>.tif for each grid (raster, west, north, pixel, width, height) of its cells (raster, row, col, value; the ones that are not
    there have no value); (raster, file, bytes). Tiles are packed each by itself; one task brings a file's tiles to it one after the other."""
    import numpy as np

    empty = 0 if nodata is None else nodata
    base = uri(path)
    type_ = dict(grids.dtypes)["raster"]
    corner = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(c) / TILE) - 1))
    every = grids.withColumn("trow", corner("height")).withColumn("tcol", corner("width")).select("raster", "trow", "tcol")
    dealt = values.join(grids.select("raster", "width", "height"), "raster").where("row >= 0 and col >= 0 and row < height and col < width and value is not null")
    dealt = dealt.select("raster", F.floor(F.col("row") / TILE).alias("trow"), F.floor(F.col("col") / TILE).alias("tcol"), F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("value").cast("double").alias("value"))

    def pack(pdf):
        import zlib

        import pandas as pd

        tile = np.full((TILE, TILE), empty, f"<{kind}")
        given = pdf[pdf["row"].notna()]
        tile[given["row"].to_numpy(int) % TILE, given["col"].to_numpy(int) % TILE] = given["value"]
        return pd.DataFrame({"raster": [pdf["raster"].iloc[0]], "trow": [pdf["trow"].iloc[0]], "tcol": [pdf["tcol"].iloc[0]], "data": [zlib.compress(tile.tobytes(), 6)]})

    packed = cut(every.join(dealt, ["raster", "trow", "tcol"], "left").groupBy("raster", "trow", "tcol").applyInPandas(pack, f"raster {type_}, trow long, tcol long, data binary"))
    sizes = packed.groupBy("raster").agg(F.transform(F.sort_array(F.collect_list(F.struct("trow", "tcol", F.length("data").alias("n")))), lambda x: x["n"]).alias("sizes"))
    heads = grids.join(sizes, "raster").select("raster", F.lit(-1).cast("long").alias("trow"), F.lit(0).cast("long").alias("tcol"), F.lit(None).cast("binary").alias("data"), "west", "north", "pixel", "width", "height", "sizes")
    rows = packed.select("*", *[F.lit(None).cast(t).alias(c) for c, t in heads.dtypes[4:]]).unionByName(heads)

    def save(batches):
        import os
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        out, at, done = None, None, []

        def close():
            nonlocal out
            if out is not None:
                n = out.tell()
                out.close()
                where.move(own, final)
                done.append({"raster": at, "file": f"{base}/{at}.tif", "bytes": n})
                out = None

        for b in batches:
            for r in b.to_pylist():
                if r["trow"] < 0:
                    close()
                    at = r["raster"]
                    where, final = fs.FileSystem.from_uri(f"{base}/{at}.tif")
                    where.create_dir(os.path.dirname(final), recursive=True)
                    own = f"{final}.{uuid.uuid4().hex}.tmp"
                    out = where.open_output_stream(own)
                    out.write(_head(r["width"], r["height"], r["sizes"], kind, r["west"], r["north"], r["pixel"], epsg, nodata))
                else:
                    out.write(r["data"])
        close()
        schema = pa.schema([("raster", pa.string()), ("file", pa.string()), ("bytes", pa.int64())])
        yield pa.RecordBatch.from_pylist([d | {"raster": str(d["raster"])} for d in done], schema=schema)

    placed = rows.repartition("raster").sortWithinPartitions("raster", "trow", "tcol")
    return cut(placed.mapInArrow(save, "raster string, file string, bytes long"))
