"""Uncompressed LAS files as a Spark data source: spark.read.format("las").load(path).

A partition is a range of points of one file; records are decoded by numpy into Arrow batches. Option
bbox ("min_x,min_y,max_x,max_y", closed) leaves out files by the bounds of their headers, and points
before they reach Spark; option records adds each point's record as it is in the file. Such points can
be written again: a folder of files, each of at most RANGE_POINTS points, with another file's header.
Files of failed or repeated tasks are deleted when the write commits."""

from __future__ import annotations

import base64
import struct
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

POINTS = "tile string, point_id long, x double, y double, z double, classification int, overlap boolean"
RANGE_POINTS = 1_000_000


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def header(data: bytes) -> dict:
    """Version, format, counts, scales and bounds from the first 375 bytes of a file."""
    if data[:4] != b"LASF":
        raise ValueError("not a LAS file")
    major, minor = data[24], data[25]
    start, = struct.unpack_from("<I", data, 96)
    kind, length, count = struct.unpack_from("<BHI", data, 104)
    if kind & 0x80:
        raise ValueError("compressed points are not supported")
    if (major, minor) >= (1, 4) and len(data) >= 255:
        count = struct.unpack_from("<Q", data, 247)[0] or count
    box = struct.unpack_from("<6d", data, 179)
    return {
        "version": f"{major}.{minor}", "point_format": kind, "record_length": length, "points_at": start, "count": count, "scale": struct.unpack_from("<3d", data, 131), "offset": struct.unpack_from("<3d", data, 155),
        "min": (box[1], box[3], box[5]), "max": (box[0], box[2], box[4]),
    }


def write(path: str, x, y, z, classification, overlap=None, scale: float = 0.001) -> None:
    """A version 1.4 file of point format 6."""
    xyz = np.stack([x, y, z], 1).astype(float)
    low = xyz.min(0) if len(xyz) else np.zeros(3)
    high = xyz.max(0) if len(xyz) else np.zeros(3)
    head = bytearray(375)
    head[:4], head[24:26] = b"LASF", bytes([1, 4])
    struct.pack_into("<HIIBHI", head, 94, 375, 375, 0, 6, 30, 0)
    struct.pack_into("<3d3d", head, 131, scale, scale, scale, *low)
    struct.pack_into("<6d", head, 179, high[0], low[0], high[1], low[1], high[2], low[2])
    struct.pack_into("<Q", head, 247, len(xyz))
    rows = np.zeros(len(xyz), np.dtype({"names": ["p", "flags", "class"], "formats": ["<3i4", "u1", "u1"], "offsets": [0, 15, 16], "itemsize": 30}))
    rows["p"], rows["class"] = np.round((xyz - low) / scale), classification
    rows["flags"] = 0 if overlap is None else np.asarray(overlap, bool) * 8
    with open(path, "wb") as f:
        f.write(bytes(head) + rows.tobytes())


@dataclass
class _Range(InputPartition):
    file: str
    start: int
    n: int


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.step = int(options.get("range_points", RANGE_POINTS))
        self.box = tuple(map(float, options["bbox"].split(","))) if "bbox" in options else None
        self.records = options.get("records", "false").lower() == "true"

    def partitions(self):
        found = []
        for file in _files(self.path):
            h = header(_head(file))
            b = self.box
            if b is None or (h["min"][0] <= b[2] and h["max"][0] >= b[0] and h["min"][1] <= b[3] and h["max"][1] >= b[1]):
                found += [_Range(file, i, min(self.step, h["count"] - i)) for i in range(0, h["count"], self.step)]
        return found or [_Range("", 0, 0)]

    def read(self, part):
        import pyarrow as pa

        if not part.n:
            return
        where, path = _fs(part.file)
        with where.open_input_file(path) as f:
            h = header(f.read_at(min(375, f.size()), 0))
            size, new = h["record_length"], h["point_format"] >= 6
            spec = np.dtype({"names": ["p", "flags", "class"], "formats": ["<3i4", "u1", "u1"], "offsets": [0, 15 if new else 14, 16 if new else 15], "itemsize": size})
            raw = f.read_at(part.n * size, h["points_at"] + part.start * size)
        rows = np.frombuffer(raw, spec)
        xyz = rows["p"] * np.array(h["scale"]) + np.array(h["offset"])
        point = np.arange(part.start, part.start + len(rows))
        if self.box is not None:
            inside = ((xyz[:, :2] >= self.box[:2]) & (xyz[:, :2] <= self.box[2:])).all(1)
            rows, xyz, point = rows[inside], xyz[inside], point[inside]
        kind = rows["class"].astype(np.int32)
        over = (rows["flags"] & 8) > 0 if new else np.zeros(len(rows), bool)
        columns = [pa.array([path.rsplit("/", 1)[-1]] * len(rows)), pa.array(point), *[pa.array(xyz[:, k]) for k in range(3)], pa.array(kind if new else kind & 31), pa.array(over)]
        names = [c.split()[0] for c in POINTS.split(", ")]
        if self.records:
            columns.append(pa.array([raw[(i - part.start) * size : (i - part.start + 1) * size] for i in point.tolist()], pa.binary()))
            names.append("record")
        yield pa.RecordBatch.from_arrays(columns, names=names)


@dataclass
class _Written(WriterCommitMessage):
    files: list


class _Writer(DataSourceArrowWriter):
    """Columns x, y, z and record; option header has the header to write under."""

    def __init__(self, options, overwrite: bool):
        if overwrite:
            raise ValueError("LAS folders are only appended to")
        self.path, self.head, self.job = options["path"].rstrip("/"), base64.b64decode(options["header"]), uuid.uuid4().hex

    def write(self, iterator):
        from pyspark import TaskContext

        task = TaskContext.get()
        files, held, size = [], [], 0

        def flush():
            nonlocal held, size
            files.append(f"{self.job}-{task.partitionId()}-{task.taskAttemptId()}-{len(files)}.las")
            where, path = _fs(f"{self.path}/{files[-1]}")
            where.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with where.open_output_stream(path) as f:
                f.write(_rewritten(self.head, np.concatenate([x for x, _ in held]), b"".join(r for _, rs in held for r in rs)))
            held, size = [], 0

        for b in iterator:
            for i in range(0, b.num_rows, RANGE_POINTS):
                part = b.slice(i, RANGE_POINTS)
                if size and size + part.num_rows > RANGE_POINTS:
                    flush()
                if part.num_rows:
                    held.append((np.stack([part.column(c).to_numpy() for c in "xyz"], 1), part.column("record").to_pylist()))
                    size += part.num_rows
        if size:
            flush()
        return _Written(files)

    def _clean(self, kept: set) -> None:
        for file in _files(self.path):
            name = file.rsplit("/", 1)[-1]
            if name.startswith(self.job) and name not in kept:
                where, path = _fs(file)
                where.delete_file(path)

    def commit(self, messages):
        self._clean({f for m in messages if m for f in m.files})

    def abort(self, messages):
        self._clean(set())


def _rewritten(head: bytes, xyz: np.ndarray, records: bytes) -> bytes:
    """A file of these records under a header, in its scale, with its counts and bounds put right."""
    h, head = header(head), bytearray(head)
    scale, offset, new = np.array(h["scale"]), np.array(h["offset"]), h["point_format"] >= 6
    steps = np.round((xyz - offset) / scale)
    if (np.abs(steps) > 2**31 - 1).any():
        raise ValueError("points lie beyond the reach of the first file's scale and offset")
    spec = np.dtype({"names": ["p", "returns"], "formats": ["<3i4", "u1"], "offsets": [0, 14], "itemsize": h["record_length"]})
    data = bytearray(records)
    rows = np.frombuffer(data, spec)
    rows["p"] = steps
    xyz = rows["p"] * scale + offset
    low, high = xyz.min(0), xyz.max(0)
    struct.pack_into("<6d", head, 179, high[0], low[0], high[1], low[1], high[2], low[2])
    returns = np.bincount(rows["returns"] & (15 if new else 7), minlength=16)[1:16].tolist()
    struct.pack_into("<6I", head, 107, *([0] * 6 if new else [len(rows), *returns[:5]]))
    if h["version"] >= "1.4":
        struct.pack_into("<QQI", head, 227, 0, 0, 0)  # no waveforms, nothing behind the points
        struct.pack_into("<16Q", head, 247, len(rows), *returns)
    return bytes(head) + bytes(data)


def _files(folder: str) -> list[str]:
    """The LAS files of a folder, or the one file."""
    from pyarrow import fs

    where, path = _fs(folder)
    info = where.get_file_info(path)
    if info.type == fs.FileType.File:
        return [folder]
    base = folder.rstrip("/")
    found = where.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f"{base}/{i.base_name}" for i in found if i.base_name.lower().endswith(".las"))


def _head(file: str, whole: bool = False) -> bytes:
    """A file's header, with the variable records that follow it if whole."""
    where, path = _fs(file)
    with where.open_input_file(path) as f:
        data = f.read_at(min(375, f.size()), 0)
        return f.read_at(header(data)["points_at"], 0) if whole else data


def crop(spark, sources: list[str], destination: str, bbox: tuple[float, float, float, float]) -> int:
    """Write the points of the sources (files or folders) in a closed box to a folder, with all that
    their records say, under the first file's header and in its scale. Returns their number; nothing
    is written if there are none."""
    if not sources:
        raise ValueError("at least one source is needed")
    if bbox[0] >= bbox[2] or bbox[1] >= bbox[3]:
        raise ValueError("the box has no area")
    bare = [x.removeprefix("file://").rstrip("/") for x in (destination, *sources)]
    if bare[0] in bare[1:] or _files(destination):
        raise ValueError("the destination must be a folder of its own")
    files = [f for s in sources for f in _files(s)]
    if not files:
        raise ValueError("the sources have no LAS files")
    kinds = {(h["point_format"], h["record_length"]) for h in map(header, map(_head, files))}
    if len(kinds) > 1:
        raise ValueError("the sources' point formats differ")
    register(spark)
    read = spark.read.format("las").option("records", "true").option("bbox", ",".join(map(repr, map(float, bbox))))
    points = [read.load(s).select("x", "y", "z", "record") for s in sources]
    found = points[0]
    for more in points[1:]:
        found = found.unionByName(more)
    found.write.format("las").option("header", base64.b64encode(_head(files[0], True)).decode()).mode("append").save(destination)
    n = sum(header(_head(f))["count"] for f in _files(destination))
    if not n:
        raise ValueError("the crop has no points")
    return n


#: Names of the dimensions of each point format, beside the coordinates.
_OLD = ["intensity", "return_number", "number_of_returns", "scan_direction_flag", "edge_of_flight_line", "classification", "synthetic", "key_point", "withheld", "scan_angle_rank", "user_data", "point_source_id"]
_NEW = ["intensity", "return_number", "number_of_returns", "synthetic", "key_point", "withheld", "overlap", "scanner_channel", "scan_direction_flag", "edge_of_flight_line", "classification", "user_data", "scan_angle", "point_source_id", "gps_time"]
_COLOURS, _WAVES = ["red", "green", "blue"], ["wavepacket_index", "wavepacket_offset", "wavepacket_size", "return_point_wave_location", "x_t", "y_t", "z_t"]
_MORE = {0: [], 1: ["gps_time"], 2: _COLOURS, 3: ["gps_time", *_COLOURS], 4: ["gps_time", *_WAVES], 5: ["gps_time", *_COLOURS, *_WAVES], 6: [], 7: _COLOURS, 8: [*_COLOURS, "nir"], 9: _WAVES, 10: [*_COLOURS, "nir", *_WAVES]}


def dimensions(point_format: int) -> list[str]:
    return ["X", "Y", "Z", *(_NEW if point_format >= 6 else _OLD), *_MORE.get(point_format, [])]


def coordinate_system(data: bytes) -> str | None:
    """The coordinate system that the variable records of a file's head (all before its points) declare: EPSG:n of the
    projected, else of the geographic system, or what the text of the system names last."""
    import re

    at, = struct.unpack_from("<H", data, 94)
    found = {}
    for _ in range(struct.unpack_from("<I", data, 100)[0]):
        if at + 54 > len(data):
            break
        user, record, n = data[at + 2 : at + 18].rstrip(b"\0"), *struct.unpack_from("<HH", data, at + 18)
        body = data[at + 54 : at + 54 + n]
        if user == b"LASF_Projection" and record == 34735:
            keys = struct.unpack_from(f"<{len(body) // 2}H", body)
            codes = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
            code = codes.get(3072, codes.get(2048))
            found["keys"] = f"EPSG:{code}" if code else None
        if user == b"LASF_Projection" and record == 2112:
            codes = re.findall(r'(?:AUTHORITY\["EPSG",\s*"|ID\["EPSG",\s*)(\d+)', body.decode("utf-8", "replace"))
            found["text"] = f"EPSG:{codes[-1]}" if codes else None
        at += 54 + n
    return found.get("text") or found.get("keys")


HEADERS = (
    "file string, path string, version string, point_format int, record_length int, points_at long, count long, scale array<double>, offset array<double>, min array<double>, max array<double>, dimensions array<string>, crs string, bytes long, error string"
)


def headers(spark, path: str):
    """A row for each LAS file under a path, whatever its depth, read in tasks: version, format, number of points, scales, bounds,
    dimensions, coordinate system, size, and what is wrong with it: no LAS file, compressed, or shorter than its points."""
    names = [c.split()[0] for c in HEADERS.split(", ")]

    def run(batches):
        from urllib.parse import unquote

        import pandas as pd

        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                own = {"file": path.rpartition("/")[2], "path": path}
                try:
                    where, inner = _fs(path)
                    with where.open_input_file(unquote(inner) if where.type_name == "local" else inner) as f:
                        own["bytes"] = f.size()
                        h = header(f.read_at(min(375, f.size()), 0))
                        own |= h | {"dimensions": dimensions(h["point_format"]), "crs": coordinate_system(f.read_at(h["points_at"], 0))}
                        if own["bytes"] < h["points_at"] + h["count"] * h["record_length"]:
                            own["error"] = "shorter than its points"
                except Exception as e:  # one broken file is one row
                    own["error"] = f"{type(e).__name__}: {e}"
                rows.append([own.get(n) for n in names])
            yield pd.DataFrame(rows, columns=names, dtype=object)

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[lL][aA][sS]").load(path).select("path")
    return listed.mapInPandas(run, HEADERS)


def scan(spark, path: str, bbox: tuple | None = None, known=None, records: bool = False, range_points: int = RANGE_POINTS):
    """The points of all readable files under a path, as the data source gives them, planned from a table of headers (known, if it is at hand): the driver
    opens no file, files outside the box are left out by their row, and ranges of points are dealt out as rows."""
    from pyspark.sql import functions as F

    rows = (known if known is not None else headers(spark, path)).where("error is null and count > 0")
    if bbox is not None:
        rows = rows.where((F.col("min")[0] <= bbox[2]) & (F.col("max")[0] >= bbox[0]) & (F.col("min")[1] <= bbox[3]) & (F.col("max")[1] >= bbox[1]))
    ranges = rows.select("path", "count", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1, F.lit(range_points).cast("long"))).alias("start"))
    options = {"path": path, "records": str(records).lower()} | ({"bbox": ",".join(map(repr, map(float, bbox)))} if bbox is not None else {})

    def run(batches):
        from urllib.parse import unquote

        reader = _Reader(options)
        for b in batches:
            for path, count, start in zip(*(b.column(c).to_pylist() for c in ("path", "count", "start")), strict=True):
                yield from reader.read(_Range(unquote(path), start, min(range_points, count - start)))

    return ranges.repartition("path", "start").mapInArrow(run, f"{POINTS}, record binary" if records else POINTS)


class LasSource(DataSource):
    @classmethod
    def name(cls):
        return "las"

    def schema(self):
        return f"{POINTS}, record binary" if self.options.get("records", "false").lower() == "true" else POINTS

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        return _Writer(self.options, overwrite)


def register(spark) -> None:
    spark.dataSource.register(LasSource)
