"""Requests, execution outcomes and exports, as rows: a failure is a status, never an exception."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablestone.operators.benchmarks import annotation_queue

#: Classes of a taxonomy; it is held whole.
TAXONOMY_BOUND = 1000
#: Texts of outcomes.
FALLBACK_WARNING = "primary reconstruction rejected; executed one LoD fallback"


def valid_request(rows: DataFrame) -> DataFrame:
    """request_error of each request (policy, backend_request, priority); NULL where it is valid."""
    forced = (F.col("policy") == "force_experimental") & (F.col("backend_request") == "auto")
    strict = (F.col("policy") == "strict") & F.col("priority").isin("benchmark", "research")
    return rows.withColumn("request_error", F.when(forced, "a forced run needs a named backend").when(strict, "a strict policy excludes this priority"))


def outcomes(plans: DataFrame, results: DataFrame) -> DataFrame:
    """Status of each plan: ABSTAINED where nothing can run; else what its backend gave (results:
    building_id, backend, lod, succeeded, accepted), FAILED where that is missing or broke. A result
    that is not accepted is run once more at the fallback level, whose result stands as it is; without
    one the plan abstains."""
    run = lambda n: results.select("building_id", F.col("backend").alias("selected_backend"), F.col("lod").alias(n), F.col("succeeded").alias(f"{n}_ok"), F.col("accepted").alias(f"{n}_accepted"))
    rows = plans.join(run("target_lod"), ["building_id", "selected_backend", "target_lod"], "left").join(run("fallback_lod"), ["building_id", "selected_backend", "fallback_lod"], "left")
    first, second = (F.coalesce(f"{n}_ok", F.lit(False)) for n in ("target_lod", "fallback_lod"))
    good = F.coalesce("target_lod_accepted", F.lit(False))
    again = first & ~good & F.col("fallback_lod").isNotNull()
    status = (
        F.when(F.col("decision") != "execute", "ABSTAINED").when(~first, "FAILED").when(good, "SUCCEEDED").when(F.col("fallback_lod").isNull(), "ABSTAINED").when(second, "SUCCEEDED").otherwise("FAILED")
    )
    used = F.when(status == "SUCCEEDED", F.when(good, F.col("target_lod")).otherwise(F.col("fallback_lod")))
    warning = F.when((F.col("decision") == "execute") & again, F.lit(FALLBACK_WARNING))
    return rows.select("building_id", status.alias("status"), used.alias("delivered_lod"), warning.alias("warning"))


#: Colours of surfaces in material files.
MATERIALS = {"RoofSurface": "0.839 0.153 0.157", "WallSurface": "0.498 0.498 0.498", "GroundSurface": "0.549 0.337 0.294"}


def input_gates(points: DataFrame, rings: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """What keeps a building from a backend that takes one closed ring and ground points: points
    (building_id, z, classification), rings (building_id, polygon_id, ring_id, corners, closed, crs); with files (building_id, path, bytes) also
    whether its point cloud is there, is a file of such points and is not empty."""
    ground = points.where("classification = 2").groupBy("building_id").agg(F.percentile("z", F.lit(0.5)).alias("ground_p50"))
    shape = rings.groupBy("building_id").agg(F.count_distinct("polygon_id").alias("polygons"), F.max("ring_id").alias("holes"), F.min("corners").alias("corners"), F.bool_and("closed").alias("closed"), F.max("crs").alias("crs"))
    rows = shape.join(ground, "building_id", "left")
    checks = [
        (F.coalesce(F.col("crs") != "EPSG:25830", F.lit(True)), "coordinate system"), (F.col("ground_p50").isNull(), "no ground points"), (F.col("polygons") != 1, "several polygons"), (F.col("holes") > 0, "holes"),
        (~F.col("closed") | (F.col("corners") < 4), "ring is not closed"),
    ]
    if files is not None:
        rows = rows.join(files.groupBy("building_id").agg(F.min(F.struct("path", "bytes")).alias("f")), "building_id", "left")
        path, size = F.lower("f.path"), F.col("f.bytes")
        checks += [(F.col("f").isNull(), "no point cloud"), (~(path.endswith(".las") | path.endswith(".laz")), "not a point cloud file"), (size == 0, "empty file")]
    errors = F.filter(F.array(*[F.when(c, F.lit(n)) for c, n in checks]), lambda e: e.isNotNull())
    return rows.select("building_id", "ground_p50", F.array_join(errors, "; ").alias("errors"), (F.size(errors) == 0).alias("ready"))


def new_templates(selection: DataFrame, detections: DataFrame, present: DataFrame) -> DataFrame:
    """The annotation queue without the buildings that have a template already, most urgent first."""
    return annotation_queue(selection, detections).join(present.select("building_id"), "building_id", "left_anti").orderBy("priority_rank", "building_id")


def obj_text(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """The OBJ text of each model: vertices to three digits, a group line wherever the semantic changes."""
    points = vertices.groupBy("model_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("vertex_idx", "x", "y", "z"))), lambda v: F.format_string("v %.3f %.3f %.3f", v["x"], v["y"], v["z"])), "\n").alias("points"))
    own = faces.groupBy("model_id", "face_id", "semantic").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "vertex_idx"))), lambda c: (c["vertex_idx"] + 1).cast("string")), " ").alias("corners"))
    before = F.lag("semantic").over(Window.partitionBy("model_id").orderBy("face_id"))
    line = F.concat(F.when(before.eqNullSafe(F.col("semantic")), "").otherwise(F.concat(F.lit("g "), "semantic", F.lit("\nusemtl "), "semantic", F.lit("\n"))), F.lit("f "), "corners")
    lines = own.withColumn("line", line).groupBy("model_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("face_id", "line"))), lambda x: x["line"]), "\n").alias("lines"))
    return points.join(lines, "model_id").select("model_id", F.concat("points", F.lit("\n"), "lines", F.lit("\n")).alias("value"))


def obj_files(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """(model_id, file, value, error): the OBJ text of each model, which names its material file, and that file. Surfaces with interior rings
    (faces with ring_id above 0) cannot be written so: their model has one row that says so."""
    own = faces if "ring_id" in faces.columns else faces.withColumn("ring_id", F.lit(0))
    pierced = own.where("ring_id > 0").select("model_id").distinct()
    key = F.col("model_id").cast("string")
    colours = "\n\n".join(f"newmtl {name}\nKd {kd}" for name, kd in MATERIALS.items()) + "\n"
    text = obj_text(vertices, own.join(pierced, "model_id", "left_anti")).select("model_id", F.concat(F.lit("mtllib "), key, F.lit(".mtl\no "), key, F.lit("\n"), "value").alias("value"))
    pair = F.array(F.struct(F.concat(key, F.lit(".obj")).alias("file"), F.col("value")), F.struct(F.concat(key, F.lit(".mtl")).alias("file"), F.lit(colours).alias("value")))
    rows = text.select("model_id", F.explode(pair).alias("f")).select("model_id", "f.file", "f.value", F.lit(None).cast("string").alias("error"))
    nothing = F.lit(None).cast("string")
    return rows.unionByName(pierced.select("model_id", nothing.alias("file"), nothing.alias("value"), F.lit("interior rings cannot be written").alias("error")))


def label_lines(objects: DataFrame, classes: dict[str, int], width: float, height: float) -> DataFrame:
    """One text for each tile: class number and corner coordinates as shares of the tile, six digits.
    objects: tile, object_id, class_name, ring (array of x, y); classes without a number have no line
    (label_counts() counts them)."""
    dims = objects.sparkSession.createDataFrame(sorted(classes.items()), "class_name string, class_id int")
    share = lambda p: F.format_string("%.6f %.6f", p["x"] / width, p["y"] / height)
    rows = objects.join(F.broadcast(dims), "class_name").withColumn("line", F.concat_ws(" ", "class_id", F.array_join(F.transform("ring", share), " ")))
    return rows.groupBy("tile").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("object_id", "line"))), lambda x: x["line"]), "\n").alias("value"))


def dataset_audit(sources: DataFrame, mapping: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Readiness of each dataset (dataset, access, reviewed, licence, note) and how far its classes
    (dataset, class_name, canonical) cover the taxonomy (canonical)."""
    covered = mapping.groupBy("dataset").agg(F.count("*").alias("classes"), F.count("canonical").alias("mapped"))
    # The taxonomy is one array in every row: no join deals it out.
    every = [r["canonical"] for r in taxonomy.select("canonical").distinct().limit(TAXONOMY_BOUND + 1).collect()]
    if len(every) > TAXONOMY_BOUND:
        raise ValueError(f"a taxonomy has at most {TAXONOMY_BOUND} classes")
    missing = sources.select("dataset", F.explode(F.array(*map(F.lit, every)).cast("array<string>")).alias("canonical")).join(mapping.select("dataset", "canonical"), ["dataset", "canonical"], "left_anti")
    missing = missing.groupBy("dataset").agg(F.array_join(F.array_sort(F.collect_list("canonical")), ",").alias("missing"))
    rows = sources.join(covered, "dataset", "left").join(missing, "dataset", "left")
    return rows.select(
        "dataset", (F.col("access") == "open").alias("ready"), (F.col("reviewed") & F.col("licence").isNotNull()).alias("reuse_confirmed"), F.coalesce("classes", F.lit(0)).alias("classes"), F.coalesce("mapped", F.lit(0)).alias("mapped"),
        F.coalesce("missing", F.lit("")).alias("missing"), F.coalesce(F.col("note").rlike("Merged|Includes"), F.lit(False)).alias("mixed_classes"),
    )
