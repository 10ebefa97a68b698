"""Mesh and registry files as vertex, face and record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(model, line, text) of text files, a file at a time so that lines keep their order."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("model_id"), "value")
    return whole.select("model_id", F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))


def read_obj(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vertices, faces) of OBJ files. A corner is what stands before its first slash; a positive one
    counts from 1, any other from the vertices read so far."""
    rows = _lines(spark, path).withColumn("f", F.split(F.trim("text"), r"\s+")).withColumn("kind", F.col("f")[0]).where("kind = 'f' or kind = 'v' and size(f) >= 4")
    rows = rows.withColumn("so_far", F.sum((F.col("kind") == "v").cast("long")).over(Window.partitionBy("model_id").orderBy("line")))
    vertices = rows.where("kind = 'v'").select("model_id", (F.col("so_far") - 1).alias("vertex_idx"), *[F.col("f")[i + 1].cast("double").alias(c) for i, c in enumerate("xyz")])
    faces = rows.where("kind = 'f'").withColumn("face_id", F.row_number().over(Window.partitionBy("model_id").orderBy("line")) - 1)
    corners = faces.select("model_id", "face_id", "so_far", F.posexplode(F.slice("f", F.lit(2), F.size("f") - 1)).alias("ordinal", "corner")).withColumn("k", F.split("corner", "/")[0].cast("long"))
    return vertices, corners.select("model_id", "face_id", "ordinal", F.when(F.col("k") > 0, F.col("k") - 1).otherwise(F.col("so_far") + F.col("k")).alias("vertex_idx"), F.lit(None).cast("string").alias("semantic"))


_FEATURE = (
    "struct<type:string,id:string,transform:struct<scale:array<double>,translate:array<double>>,vertices:array<array<long>>,"
    "CityObjects:map<string,struct<geometry:array<struct<type:string,lod:string,boundaries:array<array<array<array<long>>>>,semantics:struct<surfaces:array<struct<type:string>>,values:array<array<int>>>>>>>>"
)


def read_cityjsonseq(spark: SparkSession, path: str, lod: str = "2.2") -> tuple[DataFrame, DataFrame]:
    """(vertices, faces) of CityJSON text sequences: the first header and the first feature of each
    file; solids of one level of detail, of all objects. Each ring is a face of its own, with the number
    of its surface and its place in it. Files without either give no rows (cityjson_errors() lists them)."""
    rows = _lines(spark, path).where(F.trim("text") != "").withColumn("j", F.from_json("text", _FEATURE))
    first = lambda kind: F.min_by("j", F.when(F.col("j.type") == kind, F.col("line")))
    own = rows.groupBy("model_id").agg(first("CityJSON").alias("h"), first("CityJSONFeature").alias("f"), F.count_if(F.col("j.type") == "CityJSON").alias("nh"), F.count_if(F.col("j.type") == "CityJSONFeature").alias("nf")).where("nh > 0 and nf > 0")
    scaled = lambda i, c: (F.col("v")[i] * F.col("h.transform.scale")[i] + F.col("h.transform.translate")[i]).alias(c)
    vertices = own.select("model_id", "h", F.posexplode("f.vertices").alias("vertex_idx", "v")).select("model_id", F.col("vertex_idx").cast("long").alias("vertex_idx"), *[scaled(i, c) for i, c in enumerate("xyz")])
    # Objects, geometries, shells and surfaces are numbered in the order of the file; a face is a ring.
    objects = own.select("model_id", F.posexplode(F.map_entries("f.CityObjects")).alias("object", "o")).select("model_id", "object", F.posexplode("o.value.geometry").alias("geometry", "g"))
    shells = objects.where((F.col("g.type") == "Solid") & (F.col("g.lod") == lod)).select("model_id", "object", "geometry", "g.semantics", F.posexplode("g.boundaries").alias("shell", "surfaces"))
    place = ["object", "geometry", "shell", "surface"]
    faces = shells.select("model_id", *place[:3], "semantics", F.posexplode("surfaces").alias("surface", "rings")).withColumn("kind", F.expr("semantics.surfaces[semantics.values[shell][surface]].type"))
    order = Window.partitionBy("model_id").orderBy(*place)
    faces = faces.withColumn("surface_id", F.row_number().over(order) - 1)
    rings = faces.select("model_id", F.col("surface_id").cast("long").alias("surface_id"), "kind", F.posexplode("rings").alias("ring_id", "corners"))
    rings = rings.withColumn("face_id", (F.row_number().over(Window.partitionBy("model_id").orderBy("surface_id", "ring_id")) - 1).cast("long"))
    return vertices, rings.select("model_id", "face_id", F.col("kind").alias("semantic"), "surface_id", "ring_id", F.posexplode("corners").alias("ordinal", "vertex_idx"))


def cityjson_errors(spark: SparkSession, path: str) -> DataFrame:
    """(model_id, error) of the sequences without a header or without a feature."""
    rows = _lines(spark, path).withColumn("type", F.get_json_object("text", "$.type"))
    own = rows.groupBy("model_id").agg(F.count_if(F.col("type") == "CityJSON").alias("nh"), F.count_if(F.col("type") == "CityJSONFeature").alias("nf"))
    return own.select("model_id", F.when(F.col("nh") == 0, "no header").when(F.col("nf") == 0, "no feature").alias("error")).where("error is not null")


def write_geojson(rows: DataFrame, path: str, properties: list[str]) -> None:
    """One feature a line: the rings of footprints() as a polygon, with properties."""
    ring = lambda r: F.concat(F.transform(r["edges"], lambda e: F.array(e["x1"], e["y1"])), F.array(F.array(r["edges"][0]["x1"], r["edges"][0]["y1"])))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.transform("rings", ring).alias("coordinates")).alias("geometry"))
    rows.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, ordinal, member, suffix, size, packed, error) of the files in ZIP archives."""
    from gablestone.sources import archives

    return archives.directory(spark, path).drop("path")
