"""Decision rules, each a Column expression over a row of evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.functions.geometry import clip01

LODS = ("1.2", "1.3", "2.2")

#: The sentences that results must carry.
FORM_REASONS = {
    "FLAT": "low nDSM gradients and few vertical discontinuities",
    "COMPOUND": "large gradients or frequent height discontinuities indicate multiple roof regimes",
    "PITCHED": "stable local planes and sustained nDSM slope support a pitched form",
    "UNCERTAIN": "available evidence does not separate flat, pitched, and compound forms",
}
FORM_MISSING = ("roof-point density is below the minimum support threshold", "normalized-height coverage is below the minimum threshold", "local planar support is unavailable")
LOD12_CHECKS = ("reliable cadastral footprint", "ground elevation", "representative building height", "building observations")
LOD13_CHECKS = ("LoD1.2 prerequisites", "spatial roof coverage", "major height-part evidence")
LOD22_CHECKS = (
    "LoD1.2 prerequisites", "LiDAR density", "spatial roof coverage", "hole control", "local planar support", "footprint alignment", "dominant-plane explanation", "aggregate evidence score",
)
LOD_SUPPORTED = {
    "1.2": "footprint, ground, and representative height are available",
    "1.3": "building parts or nDSM steps support differentiated height blocks",
    "2.2": "measured geometry supports explicit roof topology",
}
NO_BACKEND = "no available backend supports the target LoD"
FORCED_WARNING = "execution forced beyond measured feasibility"


def _excess(value, base: float, scale: float):
    return clip01((value - base) / scale)


def roof_form(density, valid_ratio, planar, gradient_p50, gradient_p95, discontinuity):
    """FLAT, COMPOUND, PITCHED, UNCERTAIN, or INSUFFICIENT_EVIDENCE."""
    missing = F.coalesce(density < 1.0, F.lit(True)) | (valid_ratio < 0.55) | planar.isNull()
    return (
        F.when(missing, "INSUFFICIENT_EVIDENCE").when((gradient_p95 <= 0.25) & (discontinuity <= 0.05), "FLAT").when((gradient_p95 >= 1.0) | (discontinuity >= 0.15), "COMPOUND")
        .when((planar >= 0.60) & (gradient_p50 >= 0.08), "PITCHED").otherwise("UNCERTAIN")
    )


def roof_form_reasons(form, density, valid_ratio, planar):
    """Why the form was chosen, or what is missing."""
    missing = F.array(*[F.when(c, F.lit(t)) for c, t in zip((F.coalesce(density < 1.0, F.lit(True)), valid_ratio < 0.55, planar.isNull()), FORM_MISSING, strict=True)])
    known = F.create_map(*[F.lit(x) for pair in FORM_REASONS.items() for x in pair])
    return F.when(form == "INSUFFICIENT_EVIDENCE", F.filter(missing, lambda x: x.isNotNull())).otherwise(F.array(F.try_element_at(known, form)))


def evidence_score(density, valid_ratio, planar):
    """Mean of what is available, each within 0 and 1."""
    parts = F.filter(F.array(clip01(valid_ratio), F.when(density.isNotNull(), clip01(density / 4.0)), F.when(planar.isNotNull(), clip01(planar))), lambda x: x.isNotNull())
    return F.aggregate(parts, F.lit(0.0), lambda a, b: a + b) / F.size(parts)


def complexity_parts(compactness, vertices, planes, normals, explained, parts, discontinuity):
    """Array of (name, value, weight) in a fixed order; absent evidence is absent."""
    one = lambda name, value, weight, when=None: F.when(F.lit(True) if when is None else when, F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"), F.lit(weight).alias("weight")))
    found = F.array(
        one("irregular footprint", ((1.0 - compactness) + _excess(vertices, 4, 12.0)) / 2, 0.15), one("multiple preliminary planes", _excess(planes, 1, 5.0), 0.25), one("multiple dominant orientations", _excess(normals, 1, 3.0), 0.15),
        one("roof observations not explained by dominant planes", 1.0 - explained, 0.15), one("multiple cadastral building parts", _excess(parts, 1, 4.0), 0.10, parts.isNotNull()),
        one("frequent nDSM height discontinuities", F.least(discontinuity / 0.20, F.lit(1.0)), 0.20, discontinuity.isNotNull()),
    )
    return F.filter(found, lambda c: c.isNotNull())


def complexity_score(parts):
    total = lambda f: F.aggregate(F.transform(parts, f), F.lit(0.0), lambda a, b: a + b)
    return total(lambda c: c["value"] * c["weight"]) / total(lambda c: c["weight"])


def complexity_class(score):
    return F.when(score < 0.25, "SIMPLE").when(score < 0.50, "MODERATE").when(score < 0.75, "COMPLEX").otherwise("VERY_COMPLEX")


def complexity_reasons(parts):
    """Up to three parts of value 0.25 and more, the heaviest first; of equal ones the earlier."""
    order = F.transform(parts, lambda c, i: F.struct((-(c["value"] * c["weight"])).alias("key"), i.alias("i"), c["name"].alias("name"), c["value"].alias("value")))
    names = F.slice(F.transform(F.filter(F.array_sort(order), lambda c: c["value"] >= 0.25), lambda c: c["name"]), 1, 3)
    return F.when(F.size(names) == 0, F.array(F.lit("all available complexity indicators are low"))).otherwise(names)


def with_complexity(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("_parts", complexity_parts(*[F.col(c) for c in ("compactness", "vertices", "planes", "normals", "explained", "parts", "discontinuity")]))
    rows = rows.withColumn("complexity_score", complexity_score(F.col("_parts"))).withColumn("complexity_reasons", complexity_reasons(F.col("_parts")))
    return rows.withColumn("complexity_class", complexity_class(F.col("complexity_score"))).drop("_parts")


def _reasons(lod: str, prefix: str, checks: tuple):
    """Names of the checks that fail, in order, or the one sentence for a level that is supported."""
    names = {"1.2": LOD12_CHECKS, "1.3": LOD13_CHECKS, "2.2": LOD22_CHECKS}[lod]
    failed = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(prefix + n)) for c, n in zip(checks, names, strict=True)]), lambda x: x.isNotNull())
    return F.when(F.size(failed) == 0, F.array(F.lit(LOD_SUPPORTED[lod]))).otherwise(failed)


def with_feasibility(rows: DataFrame) -> DataFrame:
    """lod12, lod13, lod22 (whether each is supported), their scores and reasons, and the highest
    supported."""
    as_int = lambda c: c.cast("int")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    observed = F.col("available") & (F.col("roof_points") > 0)
    rows = rows.withColumn("lod12", F.col("footprint_ok") & F.col("ground_ok") & F.col("height_ok") & observed)
    rows = rows.withColumn("lod12_score", (as_int(F.col("footprint_ok")) + as_int(F.col("ground_ok")) + as_int(F.col("height_ok")) + as_int(observed)) / 4)
    covered = zero("coverage") >= 0.65
    steps = (F.coalesce("parts", F.lit(0)) > 1) | F.coalesce(F.col("discontinuity") >= 0.05, F.lit(False))
    rows = rows.withColumn("lod13", F.col("lod12") & covered & steps).withColumn("lod13_score", (as_int(F.col("lod12")) + as_int(covered) + as_int(steps)) / 3)
    hole = 1.0 - F.coalesce("hole_ratio", F.lit(1.0))
    support = F.when(F.col("complexity_class") == "SIMPLE", 1.0).when(F.col("complexity_class") == "MODERATE", 0.85).when(F.col("complexity_class") == "COMPLEX", 0.65).otherwise(0.40)
    values = [zero("density") / 5.0, zero("coverage"), hole, zero("planar"), zero("alignment"), F.col("explained"), F.coalesce("valid_ratio", zero("coverage")), support]
    score = sum((clip01(v) for v in values[1:]), clip01(values[0])) / 8
    rows = rows.withColumn("lod22_score", score)
    gates = (
        F.col("lod12") & (zero("density") >= 2.5) & (zero("coverage") >= 0.75) & (hole >= 0.70) & (zero("planar") >= 0.50) & (zero("alignment") >= 0.70) & (F.col("explained") >= 0.40) & (F.col("lod22_score") >= 0.68)
    )
    rows = rows.withColumn("lod22", gates)
    rows = rows.withColumn("lod12_reasons", _reasons("1.2", "missing ", (F.col("footprint_ok"), F.col("ground_ok"), F.col("height_ok"), observed)))
    rows = rows.withColumn("lod13_reasons", _reasons("1.3", "insufficient ", (F.col("lod12"), covered, steps)))
    rows = rows.withColumn("lod22_reasons", _reasons("2.2", "insufficient ", (
        F.col("lod12"), zero("density") >= 2.5, zero("coverage") >= 0.75, hole >= 0.70, zero("planar") >= 0.50, zero("alignment") >= 0.70, F.col("explained") >= 0.40, F.col("lod22_score") >= 0.68,
    )))
    return rows.withColumn("highest_lod", F.when(F.col("lod22"), "2.2").when(F.col("lod13"), "1.3").when(F.col("lod12"), "1.2"))


#: Backends in the order of preference: (name, supported levels, needs points, needs surface model or images).
BACKENDS = (("roofer", ("1.2", "1.3", "2.2"), True, False), ("city3d", ("2.2",), True, False))


def with_plan(rows: DataFrame, installed: tuple = ("roofer", "city3d")) -> DataFrame:
    """target_lod, selected_backend, fallback_lod, profile and forced of each request (lod_request,
    policy, backend_request) over its feasibility; NULL where there is none."""
    request, policy = F.col("lod_request"), F.col("policy")
    supported = F.when(request == "1.2", F.col("lod12")).when(request == "1.3", F.col("lod13")).when(request == "2.2", F.col("lod22"))
    below = lambda lod: F.when((lod == "2.2") & F.col("lod13"), "1.3").when((lod != "1.2") & F.col("lod12"), "1.2")
    forced = (request != "auto") & ~F.coalesce(supported, F.lit(False)) & (policy == "force_experimental")
    rows = rows.withColumn("forced", forced).withColumn(
        "target_lod", F.when(request == "auto", F.col("highest_lod")).when(supported, request).when(policy == "force_experimental", request).when(policy == "fallback", below(request))
    )
    able = [
        F.when(F.lit(name in installed and not extra) & F.col("backend_request").isin("auto", name) & F.col("target_lod").isin(*lods) & (F.lit(not points) | F.col("available")), F.lit(name)) for name, lods, points, extra in BACKENDS
    ]
    rows = rows.withColumn("selected_backend", F.coalesce(*able)).withColumn("fallback_lod", F.when(policy == "fallback", below(F.col("target_lod"))))
    quality = F.col("quality_class") if "quality_class" in rows.columns else F.lit("UNCLASSIFIED")
    calm = quality.isin("EXCELLENT", "GOOD") & F.col("complexity_class").isin("SIMPLE", "MODERATE")
    rows = rows.withColumn("profile", F.when(F.col("selected_backend") == "roofer", F.when(calm, "balanced").otherwise("conservative")))
    rows = rows.withColumn("decision", F.when(F.col("target_lod").isNull(), "no_lod").when(F.col("selected_backend").isNull(), "no_backend").otherwise("execute"))
    target = F.col("target_lod")
    level = (
        F.when((request == "auto") & target.isNotNull(), F.concat(F.lit("automatic target is highest supported LoD "), target)).when(request == "auto", "no LoD is supported by available evidence")
        .when(supported, F.concat(F.lit("requested LoD "), request, F.lit(" is supported"))).when(F.col("forced"), F.concat(F.lit("forced unsupported LoD "), request))
        .when(target.isNotNull(), F.concat(F.lit("downgraded unsupported request to LoD "), target)).otherwise(F.concat(F.lit("requested LoD "), request, F.lit(" is not supported")))
    )
    backend = F.when(F.col("decision") == "no_backend", NO_BACKEND).when(F.col("decision") == "execute", F.concat(F.lit("selected available "), F.col("selected_backend"), F.lit(" backend")))
    rows = rows.withColumn("plan_reasons", F.filter(F.array(level, backend), lambda x: x.isNotNull()))
    return rows.withColumn("plan_warnings", F.when(F.col("forced") & (F.col("decision") == "execute"), F.array(F.lit(FORCED_WARNING))).otherwise(F.array().cast("array<string>")))


def with_quality_gate(rows: DataFrame) -> DataFrame:
    """accepted, confidence and failures from validity and fit to the points."""
    failures = F.filter(
        F.array(
            F.when(~F.col("geometry_valid"), "geometry is not valid"), F.when(~F.col("plausibility_pass"), "geometry is not plausible"), F.when(F.col("rmse_m") > 1.0, "point-to-surface RMSE exceeds acceptance threshold"),
            F.when(F.col("p95_m") > 2.0, "point-to-surface P95 exceeds acceptance threshold"), F.when(F.col("within_050m") < 0.75, "insufficient roof points lie within 0.5 m of the model"),
        ),
        lambda f: f.isNotNull(),
    )
    rows = rows.withColumn("failures", failures).withColumn("accepted", F.size("failures") == 0)
    high = F.col("accepted") & (F.col("rmse_m") <= 0.30) & (F.col("p95_m") <= 0.60) & (F.col("within_050m") >= 0.90)
    return rows.withColumn("confidence", F.when(high, "HIGH").when(F.col("accepted"), "MEDIUM").otherwise("LOW"))


def annotation_priority(reported, predicted, retained):
    """high where a reported panel was not found, medium where anything was kept, else low."""
    return F.when(reported & ~predicted, "high").when(retained > 0, "medium").otherwise("low")
