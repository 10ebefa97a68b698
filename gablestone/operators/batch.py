"""Batches over selected buildings: each ends in a row, completed or failed with its reason, and in one summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What keeps a building from being evaluated.
NO_FOOTPRINT, NO_IMAGE = "missing resolved footprint", "missing image crop"


def roof_objects(selection: DataFrame, inputs: DataFrame, raw: DataFrame, kept: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """building_id, profile, status, raw_candidates, retained_objects, retained_classes (an object of counts by class, as text, keys in
    order) and error of each selected building. inputs: building_id, footprint, image (whether each is there); raw and kept: building_id,
    class_name of candidates and of what was left of them in the footprint; failures: building_id, error of runs that broke. What a
    failed building left behind does not count."""
    counts = raw.groupBy("building_id").agg(F.count("*").alias("raw"))
    by_class = kept.groupBy("building_id", "class_name").agg(F.count("*").alias("n"))
    whole = by_class.groupBy("building_id").agg(F.sum("n").alias("retained"), F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("class_name", "n"))))).alias("classes"))
    rows = selection.select("building_id", "profile").join(inputs.select("building_id", "footprint", "image"), "building_id", "left").join(counts, "building_id", "left").join(whole, "building_id", "left")
    broken = failures.groupBy("building_id").agg(F.min("error").alias("broken")) if failures is not None else rows.select("building_id").limit(0).withColumn("broken", F.lit(None).cast("string"))
    rows = rows.join(broken, "building_id", "left")
    there = lambda c: F.coalesce(F.col(c), F.lit(False))
    error = F.when(~there("footprint"), NO_FOOTPRINT).when(~there("image"), NO_IMAGE).otherwise(F.col("broken"))
    done = error.isNull()
    count = lambda c: F.when(done, F.coalesce(F.col(c), F.lit(0))).otherwise(F.lit(0)).cast("long")
    return rows.select(
        "building_id", "profile", F.when(done, "completed").otherwise("failed").alias("status"), count("raw").alias("raw_candidates"), count("retained").alias("retained_objects"),
        F.when(done, F.coalesce("classes", F.lit("{}"))).otherwise("{}").alias("retained_classes"), error.alias("error"),
    )


def roof_object_summary(entries: DataFrame) -> DataFrame:
    done = F.col("status") == "completed"
    return entries.agg(
        F.count("*").alias("selected_buildings"), F.count_if(done).alias("completed_buildings"), F.count_if(~done).alias("failed_buildings"), F.coalesce(F.sum("raw_candidates"), F.lit(0)).alias("raw_candidates"), F.coalesce(F.sum("retained_objects"), F.lit(0)).alias("retained_objects"),
    )


def catalogue(cells: DataFrame, found: DataFrame) -> DataFrame:
    """building_id, grid_cells, asset_urls, flight_years, densities, status and failed_cells of each building of cells (building_id,
    cell_id). found: cell_id, url, year, density, error: a row for each cell that was asked for, with its asset or what went wrong; a cell
    that nobody asked for has failed too. A building without cells is not among the rows."""
    one = found.groupBy("cell_id").agg(F.min(F.struct(F.col("error").isNotNull().alias("bad"), "url", "year", "density")).alias("a"))
    met = cells.select("building_id", "cell_id").distinct().join(one, "cell_id", "left").withColumn("ok", F.coalesce(~F.col("a.bad"), F.lit(False)))
    ordered = lambda c: F.transform(F.sort_array(F.collect_list(F.when(F.col("ok"), F.struct("cell_id", F.col(c).alias("v"))))), lambda x: x["v"])
    distinct = lambda c: F.sort_array(F.collect_set(F.when(F.col("ok"), F.col(c))))
    rows = met.groupBy("building_id").agg(
        F.sort_array(F.collect_list("cell_id")).alias("grid_cells"), ordered("a.url").alias("asset_urls"), distinct("a.year").alias("flight_years"), distinct("a.density").alias("densities"),
        F.count_if("ok").alias("n_ok"), F.count("*").alias("n"), F.sort_array(F.collect_list(F.when(~F.col("ok"), F.col("cell_id")))).alias("failed_cells"),
    )
    status = F.when(F.col("n_ok") == F.col("n"), "catalog_verified").when(F.col("n_ok") > 0, "partial_coverage").otherwise("catalog_unavailable")
    return rows.select("building_id", "grid_cells", "asset_urls", "flight_years", "densities", status.alias("status"), "failed_cells")


def catalogue_summary(audited: DataFrame) -> DataFrame:
    """One row of totals over catalogue(): buildings by status, and cells, each counted once."""
    by = audited.agg(F.count("*").alias("selected_buildings"), *[F.count_if(F.col("status") == s).alias(f"{s}_buildings") for s in ("catalog_verified", "partial_coverage", "catalog_unavailable")])
    cells = audited.select(F.explode("grid_cells").alias("cell_id"), F.col("failed_cells")).select("cell_id", F.array_contains("failed_cells", F.col("cell_id")).alias("bad")).distinct()
    return by.crossJoin(cells.agg(F.count("*").alias("unique_grid_cells"), F.count_if(~F.col("bad")).alias("verified_cells"), F.count_if("bad").alias("failed_cells")))  # one row each
