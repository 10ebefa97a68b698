"""From points to a plan: the evidence of each building measured once, then the decisions that rest on it, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.operators import cloud_quality, decisions, evidence, lifecycle, rasters, spatial
from gablestone.operators.shared import cut

#: What the decisions read of a building.
EVIDENCE = [
    "building_id", "available", "roof_points", "density", "coverage", "hole_ratio", "planar", "alignment", "valid_ratio", "gradient_p50", "gradient_p95", "discontinuity", "planes", "normals", "explained", "parts", "vertices", "compactness",
    "footprint_ok", "ground_ok", "height_ok", "quality_class",
]


def heights(points: DataFrame, edges: DataFrame, terrain: DataFrame, resolution: float, placed: bool = False) -> DataFrame:
    """valid_ratio, gradient_p50, gradient_p95 and discontinuity of the heights above ground in each footprint's cells. placed: points are
    those of the footprints already, with the corner (ox, oy) of their building."""
    cells = cut(rasters.normalized(rasters.height_raster(points, edges, resolution, placed=placed), terrain, resolution))
    steps = rasters.height_metrics(cells, resolution, "above_ground", digits=9).drop("pairs").withColumnRenamed("discontinuity_ratio", "discontinuity")
    return evidence.valid_ratio(cells, "above_ground").join(steps.hint("merge"), "building_id", "left")


def measured(points: DataFrame, edges: DataFrame, terrain: DataFrame, keys: list[str], resolution: float = 2.0, threshold: float = 0.20, parts: DataFrame | None = None, limits: evidence.Limits = evidence.Limits()) -> DataFrame:
    """The evidence of each building. terrain: building_id, trow, tcol, elevation, tx, ty; parts: building_id and parts (the number that a
    registry has), if there is one. Buildings that nothing was measured of have their footprint's columns and NULL.
    Buildings and the points inside are found once; measures are cut one by one and meet in the tasks, so that neither plans nor tables
    of the driver grow with what is measured."""
    own = spatial.buildings(edges)
    own = own if own is edges else cut(own)
    inside = evidence.inside_points(points, own, keys)
    report = cut(evidence.quality_report(points, own, keys, limits, inside))
    roof = inside.where(F.col("classification") == spatial.BUILDING).select("building_id", *keys, "x", "y", "z")
    planes = cut(cloud_quality.roof_planes(roof, keys, threshold=threshold))
    found = planes.groupBy("building_id").agg(F.count("*").alias("planes"), F.max("explained").alias("explained"))
    summary = spatial.building_summary(points, own, inside=inside).select("building_id", "ground_p50", "height_p50")
    rows = report
    for more in (heights(inside, own, terrain, resolution, placed=True), found, cloud_quality.dominant_normals(planes).withColumnRenamed("dominant_normals", "normals"), spatial.morphology(own), summary):
        rows = rows.join(cut(more).hint("merge"), "building_id", "left")
    rows = rows.join(parts.select("building_id", "parts").hint("merge"), "building_id", "left") if parts is not None else rows.withColumn("parts", F.lit(None).cast("long"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return rows.select(
        "building_id", "available", F.col("roof_point_count").alias("roof_points"), F.col("density_roof").alias("density"), F.col("coverage_100m").alias("coverage"), F.col("largest_hole_ratio").alias("hole_ratio"), F.col("planar_support").alias("planar"),
        F.col("alignment_score").alias("alignment"), F.coalesce("valid_ratio", F.lit(0.0)).alias("valid_ratio"), "gradient_p50", "gradient_p95", "discontinuity", zero("planes").alias("planes"), zero("normals").alias("normals"), zero("explained").cast("double").alias("explained"), "parts",
        "vertices", "compactness", (zero("area_m2") > 0).alias("footprint_ok"), F.col("ground_p50").isNotNull().alias("ground_ok"), F.coalesce(F.col("height_p50") > 0, F.lit(False)).alias("height_ok"), "quality_class",
    )


def decided(rows: DataFrame, requests: DataFrame, installed: tuple = ("roofer", "city3d")) -> DataFrame:
    """The evidence with roof form, complexity, feasibility and plan of each request (building_id, lod_request, policy, backend_request,
    priority). A request that is not valid has request_error and no plan; one for a building without evidence is planned on none."""
    form = [F.col(c) for c in ("density", "valid_ratio", "planar", "gradient_p50", "gradient_p95", "discontinuity")]
    rows = lifecycle.valid_request(requests).join(rows.hint("merge"), "building_id", "left")
    missing = {"available": False, "footprint_ok": False, "ground_ok": False, "height_ok": False}
    rows = rows.na.fill(missing).na.fill({"roof_points": 0, "planes": 0, "normals": 0, "explained": 0.0, "valid_ratio": 0.0})
    rows = rows.withColumn("roof_form", decisions.roof_form(*form)).withColumn("evidence_score", decisions.evidence_score(*form[:3])).withColumn("roof_form_reasons", decisions.roof_form_reasons(F.col("roof_form"), *form[:3]))
    rows = decisions.with_plan(decisions.with_feasibility(decisions.with_complexity(rows)), installed)
    wrong = F.col("request_error").isNotNull()
    nothing = {c: F.when(~wrong, F.col(c)) for c in ("target_lod", "selected_backend", "fallback_lod", "profile")}
    return rows.withColumns(nothing).withColumn("decision", F.when(wrong, "invalid_request").otherwise(F.col("decision")))
