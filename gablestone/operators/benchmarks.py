"""Comparing reconstructions: ranking, backend summaries, catalogue audits, annotation queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablestone.operators.decisions import annotation_priority


def ranking(entries: DataFrame) -> DataFrame:
    """Accepted entries of each building by RMSE, P95 and then the order in which they came."""
    order = Window.partitionBy("building_id").orderBy("rmse_m", "p95_m", "input_ord")
    return entries.where("accepted").withColumn("rank", F.row_number().over(order))


#: What a comparison refuses.
NO_ENTRIES, DUPLICATES, AUTOMATIC = "a benchmark needs one entry at least", "a benchmark has one entry of each backend", "an entry needs the backend that ran"


def compared(buildings: DataFrame, entries: DataFrame) -> DataFrame:
    """building_id, backends (of its entries, by name), accepted_ranking (the accepted ones by RMSE, P95 and the order in which they came)
    and error of each building: one without entries, with two of one backend or with an automatic one is refused and has no ranking."""
    rank = F.transform(F.array_sort(F.collect_list(F.when(F.col("accepted"), F.struct("rmse_m", "p95_m", "input_ord", "backend")))), lambda e: e["backend"])
    own = entries.groupBy("building_id").agg(F.sort_array(F.collect_list("backend")).alias("backends"), rank.alias("ranking"))
    rows = buildings.select("building_id").distinct().join(own, "building_id", "left")
    error = F.when(F.col("backends").isNull(), NO_ENTRIES).when(F.array_contains("backends", "auto"), AUTOMATIC).when(F.size(F.array_distinct("backends")) < F.size("backends"), DUPLICATES)
    return rows.select("building_id", F.coalesce("backends", F.array().cast("array<string>")).alias("backends"), F.when(error.isNull(), F.col("ranking")).alias("accepted_ranking"), error.alias("error"))


def flattened(geometry: DataFrame, fits: DataFrame, gates: DataFrame) -> DataFrame:
    """Benchmark entries from reports, one for each building, backend and level of all three: validity and size of the geometry (geometry_valid,
    watertight, vertices, faces, iou), distances (rmse_m, p95_m, within_050m) and verdict (accepted, confidence, failures); entry_error where the backend is
    not a concrete one, or where a report is missing."""
    keys = ["building_id", "backend", "lod"]
    rows = geometry.select(*keys, "geometry_valid", "watertight", "vertices", "faces", "iou", F.lit(True).alias("g"))
    rows = rows.join(fits.select(*keys, "rmse_m", "p95_m", "within_050m", F.lit(True).alias("f")), keys, "full").join(gates.select(*keys, "accepted", "confidence", "failures", F.lit(True).alias("q")), keys, "full")
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), n) for c, n in (("g", "geometry"), ("f", "fit"), ("q", "quality"))])
    error = F.when(F.col("backend") == "auto", AUTOMATIC).when(missing != "", F.concat(F.lit("no report of "), missing))
    return rows.withColumn("entry_error", error).drop("g", "f", "q")


def backend_summary(entries: DataFrame, backends: tuple = ("roofer", "city3d")) -> DataFrame:
    """Evaluated and accepted counts and mean errors of each backend; a row for each, even without entries."""
    names = entries.sparkSession.createDataFrame([(b,) for b in backends], "backend string")
    sums = entries.groupBy("backend").agg(F.count("*").alias("evaluated"), F.count_if("accepted").alias("accepted"), F.avg("rmse_m").alias("mean_rmse"), F.avg("p95_m").alias("mean_p95"))
    out = F.broadcast(names).join(sums, "backend", "left")
    return out.select("backend", F.coalesce("evaluated", F.lit(0)).alias("evaluated"), F.coalesce("accepted", F.lit(0)).alias("accepted"), "mean_rmse", "mean_p95")


def building_matrix(buildings: DataFrame, entries: DataFrame, backends: tuple = ("roofer", "city3d")) -> DataFrame:
    """Each building and backend with its best entry, or the reason why there is none."""
    pairs = buildings.select("building_id").distinct().withColumn("backend", F.explode(F.array(*map(F.lit, backends))))
    best = entries.groupBy("building_id", "backend").agg(F.min("rmse_m").alias("best_rmse"), F.count("*").alias("entries"))
    return pairs.join(best, ["building_id", "backend"], "left").withColumn("reason", F.when(F.col("entries").isNull(), "no artifact")).withColumn("entries", F.coalesce("entries", F.lit(0)))


def catalog_audit(cells: DataFrame, assets: DataFrame) -> DataFrame:
    """Status of each building by its cells' assets (cell_id, year, density): verified, partial or
    unavailable; the distinct years and densities in order. Each cell is looked up once."""
    known = cells.select("cell_id").distinct().join(assets, "cell_id", "left")
    met = cells.join(known, "cell_id", "left").groupBy("building_id").agg(
        F.count("*").alias("cells"), F.count("year").alias("found"), F.array_join(F.array_sort(F.collect_set("year")), ",").alias("years"), F.array_join(F.array_sort(F.collect_set("density")), ",").alias("densities")
    )
    return met.withColumn("status", F.when(F.col("found") == F.col("cells"), "verified").when(F.col("found") > 0, "partial").otherwise("unavailable"))


def detection_counts(selection: DataFrame, detections: DataFrame) -> DataFrame:
    """Kept detections of each selected building by class; empty masks do not count. A building
    without any has one row with no class and zeros."""
    kept = detections.where("pixel_area > 0").groupBy("building_id", "class_name").agg(F.count("*").alias("objects"), F.sum("pixel_area").alias("pixels"))
    rows = selection.select("building_id").join(kept, "building_id", "left")
    return rows.select("building_id", "class_name", F.coalesce("objects", F.lit(0)).alias("objects"), F.coalesce("pixels", F.lit(0)).alias("pixels"))


def detection_totals(counts: DataFrame) -> DataFrame:
    """Over all buildings of detection_counts(): a row for each class, and one without a class for all."""
    kept = counts.where("class_name is not null")
    every = counts.agg(F.count_distinct("building_id").alias("buildings"), F.sum("objects").alias("objects"), F.sum("pixels").alias("pixels")).select(F.lit(None).cast("string").alias("class_name"), "buildings", "objects", "pixels")
    return kept.groupBy("class_name").agg(F.count_distinct("building_id").alias("buildings"), F.sum("objects").alias("objects"), F.sum("pixels").alias("pixels")).union(every)


def annotation_queue(selection: DataFrame, detections: DataFrame) -> DataFrame:
    """Selected buildings with their priority: reported panels that no detection shows come first."""
    kept = detections.where("pixel_area > 0").groupBy("building_id").agg(F.count("*").alias("retained"), F.max((F.col("class_name") == "pv_panel").cast("int")).alias("pv"))
    rows = selection.join(kept, "building_id", "left").withColumn("retained", F.coalesce("retained", F.lit(0)))
    reported, predicted = F.coalesce(F.col("photovoltaic_panels") == "user_reported", F.lit(False)), F.coalesce(F.col("pv") == 1, F.lit(False))
    rows = rows.withColumn("priority", annotation_priority(reported, predicted, F.col("retained")))
    return rows.withColumn("priority_rank", F.when(F.col("priority") == "high", 0).when(F.col("priority") == "medium", 1).otherwise(2)).select("building_id", "retained", "priority", "priority_rank")


def map_labels(detections: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Source labels as canonical ones with counts; labels without one are counted as ignored."""
    dims = detections.sparkSession.createDataFrame(sorted(mapping.items()), "class_name string, canonical string")
    return detections.join(F.broadcast(dims), "class_name", "left").groupBy("class_name", "canonical").agg(F.count("*").alias("objects")).withColumn("ignored", F.col("canonical").isNull())


def missing_classes(taxonomy: list[str], mapping: dict[str, str], spark) -> DataFrame:
    """Canonical classes that no source label stands for."""
    all_, mapped = spark.createDataFrame([(c,) for c in taxonomy], "canonical string"), spark.createDataFrame([(c,) for c in mapping.values()], "canonical string")
    return all_.join(mapped, "canonical", "left_anti")


def queue_summary(queue: DataFrame) -> DataFrame:
    """How many buildings of an annotation queue have each priority; one row."""
    return queue.agg(*[F.count_if(F.col("priority") == p).alias(p) for p in ("high", "medium", "low")], F.count("*").alias("buildings"))


def evaluated(selection: DataFrame, evaluations: DataFrame, rasters: DataFrame) -> DataFrame:
    """Selected buildings with a completed evaluation, and with a raster to look at."""
    done = evaluations.where("completed").drop("completed")
    return selection.join(done, "building_id").join(rasters.select("building_id").distinct(), "building_id", "left_semi")


def flat_entries(fits: DataFrame) -> DataFrame:
    """Benchmark entries from results of named backends: an automatic one is an error of its own."""
    return fits.withColumn("entry_error", F.when(F.col("backend") == "auto", "an entry needs the backend that ran"))


def taxonomy_error(taxonomy: DataFrame) -> DataFrame:
    """(version, error): class numbers of a version must be 0 .. n - 1, each once; else the error says so."""
    own = taxonomy.groupBy("version").agg(F.count("*").alias("n"), F.count_distinct("class_id").alias("kinds"), F.min("class_id").alias("low"), F.max("class_id").alias("high"))
    whole = (F.col("kinds") == F.col("n")) & (F.col("low") == 0) & (F.col("high") == F.col("n") - 1)
    return own.select("version", F.when(~whole, "class numbers are not contiguous from zero").alias("error"))


def taxonomy_checks(taxonomy: DataFrame, uses: DataFrame) -> DataFrame:
    """uses (name, version, tiling, overlap: what a model or data set was made with) and what is wrong with each: a version that is not there or
    whose class numbers are not whole, class names that are not unique, tiles that overlap though there is no tiling, or an overlap outside 0 .. 1."""
    names = taxonomy.groupBy("version").agg((F.count_distinct("canonical") < F.count("*")).alias("repeats"))
    known = taxonomy_error(taxonomy).join(names, "version")
    rows = uses.join(known.withColumnRenamed("error", "numbers"), "version", "left")
    error = (
        F.when(F.col("repeats").isNull(), "unknown taxonomy version").when(F.col("numbers").isNotNull(), F.col("numbers")).when(F.col("repeats"), "class names are not unique")
        .when(~F.col("tiling") & (F.col("overlap") != 0), "tile overlap must be zero without tiling").when((F.col("overlap") < 0) | (F.col("overlap") >= 1), "tile overlap is between 0 and 1")
    )
    return rows.select(*uses.columns, error.alias("error"))


def missing_of(taxonomy: DataFrame, mapping: DataFrame) -> DataFrame:
    """(version, canonical): classes of each version that no row of a mapping (version, class_name, canonical) stands for."""
    return taxonomy.select("version", "canonical").distinct().join(mapping.where("canonical is not null").select("version", "canonical"), ["version", "canonical"], "left_anti")


def first_seen(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Distinct keys in the order in which they first come."""
    return rows.groupBy(*keys).agg(F.min(order).alias("first")).orderBy("first")


def best_by(rows: DataFrame, group: str, value: str, keep: list[str]) -> DataFrame:
    """The row of each group with the smallest value; of equal ones the first by the kept columns."""
    return rows.groupBy(group).agg(F.min(F.struct(value, *keep)).alias("b")).select(group, "b.*")


def split_membership(images: DataFrame, train: DataFrame, validation: DataFrame) -> DataFrame:
    """train or val of each image (name), train where it is in both; an error where it is in neither."""
    a, b = (x.select("name").distinct().withColumn(n, F.lit(True)) for x, n in ((train, "t"), (validation, "v")))
    rows = images.join(a, "name", "left").join(b, "name", "left")
    split = F.when(F.col("t"), "train").when(F.col("v"), "val")
    return rows.select(*images.columns, split.alias("split"), F.when(split.isNull(), "absent from both splits").alias("split_error"))


def mean_position(positions: DataFrame, group: str = "building_id") -> DataFrame:
    """Mean of all positions of a ring, the closing one too."""
    return positions.groupBy(group).agg(F.avg("x").alias("x"), F.avg("y").alias("y"))


def digests(files: DataFrame, expected: DataFrame) -> DataFrame:
    """MD5 of each file's content against what is pinned for it (name, md5)."""
    own = files.select("name", F.md5("content").alias("actual"))
    return own.join(expected.select("name", F.lower("md5").alias("expected")), "name", "left").withColumn("matches", F.col("actual") == F.col("expected"))
