"""Evidence of one building brought together: the point quality report and heights above ground."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.operators import cloud_quality, rasters, spatial
from gablestone.operators.shared import cut

#: Texts of warnings.
NO_ROOF_POINTS, AT_LIMIT = "no classified building points inside footprint", "alignment optimum reached the bounded search limit"


@dataclass(frozen=True)
class Limits:
    """Parameters of the local planes; what makes no sense is refused."""

    neighbours: int = 16
    residual: float = 0.20
    planarity: float = 0.30

    def __post_init__(self):
        if self.neighbours < 3:
            raise ValueError("planes need three neighbours at least")
        if self.residual <= 0:
            raise ValueError("the residual must be positive")
        if not 0 <= self.planarity <= 1:
            raise ValueError("planarity is between 0 and 1")


def inside_points(points: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """The points of the footprints with the corner (ox, oy) of their building, found once for all that reads them."""
    return cut(spatial.in_footprints(points, edges).where("inside").select("building_id", *keys, "x", "y", "z", "classification", F.col("min_x").alias("ox"), F.col("min_y").alias("oy")))


def quality_report(points: DataFrame, edges: DataFrame, keys: list[str], limits: Limits = Limits(), inside: DataFrame | None = None) -> DataFrame:
    """One row a building: points and densities in its footprint, coverage at half a metre and a metre,
    the largest hole, spacing, local planes, outliers, alignment and warnings; NULL where too few
    points are there to tell. A report is available where the cloud has any point at all. The class is not measured and the score is 0.
    inside: what inside_points gives, where it is there already. Each measure is cut as it is done: none is made in one plan with the
    others, and none goes through the driver."""
    edges = cut(spatial.buildings(edges)) if inside is None else spatial.buildings(edges)
    prints = edges.select("building_id", "area")
    inside = inside_points(points, edges, keys) if inside is None else inside
    some = not points.isEmpty()
    counts = inside.groupBy("building_id").agg(F.count("*").alias("point_count"), F.count_if(F.col("classification") == spatial.BUILDING).alias("roof_point_count"))
    roof = inside.where(F.col("classification") == spatial.BUILDING)
    seen = [
        counts, rasters.coverage(inside, edges, 0.5, placed=True).select("building_id", F.col("coverage").alias("coverage_050m")),
        rasters.occupancy(inside, edges, 1.0, placed=True).select("building_id", (F.col("occupied_cells") / F.col("footprint_cells")).alias("coverage_100m"), (F.col("largest_empty_cells") / F.col("footprint_cells")).alias("largest_hole_ratio")), cloud_quality.spacing(roof, keys),
        cloud_quality.local_planes(roof, keys, k=limits.neighbours, residual=limits.residual, planarity=limits.planarity), cloud_quality.outlier_ratio(roof), spatial.alignment(points, edges),
    ]
    rows = prints
    for more in seen:
        rows = rows.join(cut(more).hint("merge"), "building_id", "left")
    n, r = (F.coalesce(c, F.lit(0)) for c in ("point_count", "roof_point_count"))
    enough = lambda least, c: F.when(r >= least, F.col(c))
    warnings = F.filter(F.array(F.when(r == 0, NO_ROOF_POINTS), F.when(F.coalesce("at_limit", F.lit(False)), AT_LIMIT)), lambda x: x.isNotNull())
    return rows.select(
        "building_id", F.lit(some).alias("available"), n.alias("point_count"), r.alias("roof_point_count"), (n / F.col("area")).alias("density_all"), (r / F.col("area")).alias("density_roof"), "coverage_050m", "coverage_100m", "largest_hole_ratio",
        enough(2, "spacing_p50").alias("spacing_p50"), enough(2, "spacing_p90").alias("spacing_p90"), enough(3, "planar_support").alias("planar_support"), enough(3, "residual_p50").alias("residual_p50"), "outlier_ratio",
        F.col("score").alias("alignment_score"), F.col("sx").alias("shift_x"), F.col("sy").alias("shift_y"), F.lit("UNCLASSIFIED").alias("quality_class"), F.lit(0.0).alias("quality_score"), F.array_join(warnings, "; ").alias("warnings"),
    )


def valid_ratio(cells: DataFrame, value: str = "height") -> DataFrame:
    """Share of each footprint's cells that have a value."""
    return cells.groupBy("building_id").agg((F.count(value) / F.count("*")).alias("valid_ratio"))


def height_statistics(cells: DataFrame, value: str = "above_ground") -> DataFrame:
    """Quantiles of the heights above ground, and the range between the outer two."""
    q = F.percentile(value, F.array(*map(F.lit, (0.05, 0.5, 0.95))))
    rows = cells.where(F.col(value).isNotNull()).groupBy("building_id").agg(q.alias("q"))
    return rows.select("building_id", F.col("q")[0].alias("p05"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p95"), (F.col("q")[2] - F.col("q")[0]).alias("height_range"))


def above_ground(points: DataFrame, group: str = "building_id") -> DataFrame:
    """Points with their height over the median of the ground points of their group; NULL without any."""
    ground = points.where(F.col("classification") == spatial.GROUND).groupBy(group).agg(F.percentile("z", F.lit(0.5)).alias("ground_z"))
    return points.join(ground, group, "left").withColumn("above", F.col("z") - F.col("ground_z")).drop("ground_z")
