"""What landed images are: format, size, channels and the extrema of each channel, as rows. A file that is cut short is available with a
warning, one that is no image has an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How files of each format begin and end.
FORMATS = {"JPEG": (b"\xff\xd8\xff", b"\xff\xd9"), "PNG": (b"\x89PNG\r\n\x1a\n", b"IEND\xaeB`\x82")}
TRUNCATED, NO_IMAGE = "the image file is truncated", "not a valid image"
AUDIT = "file string, format string, bytes long, width int, height int, channels int, extrema array<struct<low: int, high: int>>, status string, warning string, error string"


def _ends(batches):
    """Format and wholeness by a file's first and last bytes, which alone are read."""
    from urllib.parse import unquote

    import pandas as pd
    from pyarrow import fs

    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            where, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
            with where.open_input_file(unquote(inner) if where.type_name == "local" else inner) as f:
                size = f.size()
                head, tail = f.read_at(min(8, size), 0), f.read_at(min(64, size), max(0, size - 64))
            kind = next((k for k, (begin, _) in FORMATS.items() if head.startswith(begin)), None)
            # Some writers pad files with zeros.
            rows.append((path, size, kind, kind is not None and not tail.rstrip(b"\0").endswith(FORMATS[kind][1].rstrip(b"\0"))))
        yield pd.DataFrame(rows, columns=["path", "bytes", "format", "cut"])


def _extrema(batches):
    """The least and the greatest value of each channel, red first where there are colours."""
    import numpy as np
    import pyarrow as pa

    pair = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
    for b in batches:
        out = []
        for data, n in zip(b.column("data"), b.column("channels").to_pylist(), strict=True):
            cells = np.frombuffer(data.as_buffer(), np.uint8)
            cells = cells.reshape(-1, n)[:, [2, 1, 0, *range(3, n)] if n >= 3 else range(n)] if n and n > 0 and len(cells) else None
            out.append(None if cells is None else [{"low": int(a), "high": int(z)} for a, z in zip(cells.min(0), cells.max(0), strict=True)])
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("path", "width", "height", "channels")], pa.array(out, pair)], names=["path", "width", "height", "channels", "extrema"])


def audit(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file of a folder. Spark's image source decodes whole files; one that it cannot decode though it begins as an image has
    no size and is available with a warning, if it is cut short, as its beginning may still be shown. Files without a byte are not listed by
    Spark and have no row."""
    ends = spark.read.format("binaryFile").load(path).select("path").mapInPandas(_ends, "path string, bytes long, format string, cut boolean")
    decoded = spark.read.format("image").option("dropInvalid", False).load(path).select(F.col("image.origin").alias("path"), "image.width", "image.height", F.col("image.nChannels").alias("channels"), "image.data")
    decoded = decoded.mapInArrow(_extrema, "path string, width int, height int, channels int, extrema array<struct<low: int, high: int>>")
    name = lambda c: F.regexp_extract(c, r"([^/]+)$", 1)
    rows = ends.withColumn("file", F.url_decode(F.replace(name("path"), F.lit("+"), F.lit("%2B")))).join(decoded.select(F.url_decode(F.replace(name("path"), F.lit("+"), F.lit("%2B"))).alias("file"), "width", "height", "channels", "extrema"), "file")
    whole = F.col("width") > 0
    status = F.when(F.col("format").isNull() | (~whole & ~F.col("cut")), "unavailable").when(F.col("cut"), "available_with_warning").otherwise("available")
    shown = [F.when(whole, F.col(c)).alias(c) for c in ("width", "height", "channels")]
    return rows.select("file", "format", "bytes", *shown, F.when(whole & ~F.col("cut"), F.col("extrema")).alias("extrema"), status.alias("status"), F.when(F.col("cut"), TRUNCATED).alias("warning"), F.when(status == "unavailable", NO_IMAGE).alias("error"))


def advertised(buildings: DataFrame, audited: DataFrame) -> DataFrame:
    """The audit of each building's facade image. buildings: building_id, document_url (NULL or blank: the building advertises none), file (as
    it was landed; NULL: it was not)."""
    rows = buildings.select("building_id", "document_url", "file").join(audited, "file", "left")
    none = F.trim(F.coalesce("document_url", F.lit(""))) == ""
    error = F.when(none, "no advertised image").when(F.col("status").isNull(), "not landed").otherwise(F.col("error"))
    status = F.when(none | F.col("status").isNull(), "unavailable").otherwise(F.col("status"))
    return rows.withColumns({"error": error, "status": status})
