"""Cadastral artefacts: identity, building and parts as documents in geographic coordinates, and footprints in projected
ones. Footprints are made valid first; what has no area is a row with an error and no document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablestone.functions import projection
from gablestone.operators import overlay

#: Fixed value: characters that stay in a folder's name.
SAFE = r"[^A-Za-z0-9._-]"
IDENTITY = ["reference", "local_id", "namespace"]


def folder_name(building_id: Column) -> Column:
    """A safe name of a folder; NULL where none can be made."""
    name = F.regexp_replace(building_id, SAFE, "_")
    return F.when(~name.isin("", ".", ".."), name)


def geometry(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, geometry): the parts of each key as the text of a Polygon or MultiPolygon, in the order of their numbers."""
    pairs = F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    own = parts.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("part", pairs.alias("c")))), lambda x: x["c"]).alias("c"))
    one = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.col("c")[0].alias("coordinates")))
    return own.select(*keys, F.when(F.size("c") == 1, one).otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.col("c").alias("coordinates")))).alias("geometry"))


def _feature(key: Column, properties: list[str]) -> Column:
    """A feature's text around the text of its geometry."""
    own = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"})
    return F.concat(F.lit('{"type":"Feature","id":'), F.to_json(F.array(key)).substr(F.lit(2), F.length(F.to_json(F.array(key))) - 2), F.lit(',"geometry":'), F.col("geometry"), F.lit(',"properties":'), own, F.lit("}"))


def artefacts(buildings: DataFrame, parts: DataFrame) -> DataFrame:
    """(building_id, folder, file, value, error): identity.json, building.geojson and building_parts.geojson of each building.
    buildings: building_id, reference, local_id, namespace, rings (projected) and other columns, which become properties; parts:
    building_id, part, local_id, rings and other columns. A building that cannot be written has one row with an error."""
    near = lambda df, keys: geometry(_geographic_parts(df, keys), keys)
    own = buildings.join(near(buildings, ["building_id"]), "building_id", "left").withColumn("folder", folder_name(F.col("building_id")))
    error = F.when(F.col("folder").isNull(), "no folder can be named after the building").when(F.col("geometry").isNull(), "the footprint has no area")
    own = own.withColumn("error", error)
    properties = [c for c in buildings.columns if c not in ("rings", "error")]
    parts = parts.withColumnRenamed("part", "number")
    found = parts.join(near(parts, ["building_id", "number"]), ["building_id", "number"])
    features = found.withColumn("feature", _feature(F.col("local_id"), [c for c in parts.columns if c not in ("rings", "number", "building_id", "error")]))
    features = features.groupBy("building_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("number", "feature"))), lambda x: x["feature"]).alias("features"))
    rows = own.join(features, "building_id", "left")
    whole = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.coalesce("features", F.array().cast("array<string>")), ","), F.lit("]}"))
    files = F.array(
        F.struct(F.lit("identity.json").alias("file"), F.to_json(F.struct("building_id", *[c for c in IDENTITY if c in buildings.columns]), {"ignoreNullFields": "false"}).alias("value")),
        F.struct(F.lit("building.geojson").alias("file"), _feature(F.col("building_id"), properties).alias("value")), F.struct(F.lit("building_parts.geojson").alias("file"), whole.alias("value")),
    )
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("file"), F.lit(None).cast("string").alias("value")))
    return rows.select("building_id", "folder", F.explode(F.when(F.col("error").isNull(), files).otherwise(nothing)).alias("f"), "error").select("building_id", "folder", "f.file", "f.value", "error")


def _geographic_parts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Valid parts in degrees."""
    place = projection.inline(projection.to_geographic("p.x", "p.y"))
    return overlay.repaired(rows, keys).where("error is null").withColumn("rings", F.expr(f"transform(rings, r -> transform(r, p -> {place}))"))


def projected(features: DataFrame, crs: str = "EPSG:25830", name: str = "roofer_footprint") -> DataFrame:
    """(building_id, value): a feature collection with the footprint of each building in projected coordinates, named by its
    system. features: building_id, polygon_id, ring_id, ordinal, lon, lat (registry.building_features())."""
    at = F.expr(projection.inline(projection.to_utm("lon", "lat")))
    rings = features.where("lon is not null and lat is not null").groupBy("building_id", "polygon_id", "ring_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", at.alias("p")))), lambda q: q["p"]).alias("r"))
    parts = rings.groupBy("building_id", F.col("polygon_id").alias("part")).agg(F.transform(F.sort_array(F.collect_list(F.struct("ring_id", "r"))), lambda x: x["r"]).alias("rings"))
    own = geometry(parts, ["building_id"]).withColumn("feature", _feature(F.col("building_id").cast("string"), ["building_id"]))
    urn = "urn:ogc:def:crs:" + crs.replace(":", "::")
    head = f'{{"type":"FeatureCollection","name":"{name}","crs":{{"type":"name","properties":{{"name":"{urn}"}}}},"features":['
    return own.select("building_id", F.concat(F.lit(head), F.col("feature"), F.lit("]}")).alias("value"))


def write_artefacts(rows: DataFrame, path: str) -> None:
    """One folder a building under path, and in it a folder for each file with its text."""
    rows.where("error is null").select("folder", "file", "value").write.mode("overwrite").partitionBy("folder", "file").text(path)
