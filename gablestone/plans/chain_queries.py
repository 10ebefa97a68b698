"""Queries from points to decisions, batches and their totals, with the SQL that checks them."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from gablestone.operators import batch, chain, spatial
from gablestone.operators.shared import cut
from gablestone.plans import spatial_queries, surface_queries
from gablestone.plans.spatial_queries import _r
from gablestone.sources.adapters import prelude, view

K = ["k1", "k2", "k3", "k4"]


def _measured(spark, d):
    points, edges = view(spark, d, "v_points"), cut(spatial.buildings(view(spark, d, "v_edges")))
    own = edges.select("building_id", "min_x", "min_y").hint("merge")
    terrain = view(spark, d, "v_terrain").join(own, "building_id").select("building_id", "trow", "tcol", "elevation", F.col("min_x").alias("tx"), F.col("min_y").alias("ty"))
    return chain.measured(points, edges, terrain, ["src_building", *K], 2.0, 0.6)


def _requests(spark, d):
    return spark.read.parquet(f"{d}/supplier.parquet").selectExpr(
        "cast(s_suppkey as bigint) as building_id", "case s_suppkey % 4 when 0 then 'auto' when 1 then '1.2' when 2 then '1.3' else '2.2' end as lod_request", "case s_suppkey % 3 when 0 then 'strict' when 1 then 'fallback' else 'force_experimental' end as policy",
        "case s_suppkey % 5 when 0 then 'roofer' when 1 then 'city3d' else 'auto' end as backend_request", "case s_suppkey % 7 when 0 then 'benchmark' else 'balanced' end as priority",
    )


def c01_chain(spark, d):
    """Points to roof form and the levels that rest on no planes."""
    rows = chain.decided(_measured(spark, d), _requests(spark, d))
    keep = ["roof_points", "density", "coverage", "hole_ratio", "planar", "alignment", "valid_ratio", "gradient_p50", "gradient_p95", "discontinuity", "vertices", "compactness", "footprint_ok", "ground_ok", "height_ok", "available", "roof_form", "evidence_score", "lod12", "lod13", "request_error"]
    return _r(rows.select("building_id", *keep))


def c02_plans(spark, d):
    """Points to plans: planes are found by sampling, which SQL cannot do."""
    rows = chain.decided(_measured(spark, d), _requests(spark, d))
    return _r(rows.select("building_id", "planes", "normals", "explained", "complexity_score", "complexity_class", "lod22", "highest_lod", "target_lod", "selected_backend", "fallback_lod", "profile", "decision", F.array_join("plan_reasons", "; ").alias("reasons")))


def _batch(spark, d):
    detections = view(spark, d, "v_detections")
    customer = spark.read.parquet(f"{d}/customer.parquet")
    inputs = customer.selectExpr("cast(c_custkey as bigint) as building_id", "c_nationkey <> 3 as footprint", "c_nationkey <> 5 as image")
    failures = customer.where("c_acctbal < -900").selectExpr("cast(c_custkey as bigint) as building_id", "'segmentation failed' as error")
    return batch.roof_objects(view(spark, d, "v_selection"), inputs, detections, detections.where("pixel_area > 0 and confidence >= 0.25"), failures)


def a21_batch(spark, d):
    return _r(_batch(spark, d))


def a21_batch_summary(spark, d):
    return _r(batch.roof_object_summary(_batch(spark, d)))


def _catalogue(spark, d):
    cells = spatial.grid_cells(spatial.footprints(view(spark, d, "v_edges")), 700.0).select("building_id", "cell_id")
    found = cells.select("cell_id").distinct().withColumn("n", F.regexp_extract("cell_id", r"^(\d+)-(\d+)", 1).cast("int") + F.regexp_extract("cell_id", r"^(\d+)-(\d+)", 2).cast("int")).selectExpr(
        "cell_id", "if(n % 3 = 0, null, concat('u/', cell_id)) as url", "if(n % 3 = 0, null, 2015 + n % 4) as year", "if(n % 3 = 0, null, n % 2 + 0.5D) as density", "if(n % 3 = 0, 'TimeoutError: no answer', null) as error")
    return batch.catalogue(cells, found)


def a22_catalogue(spark, d):
    rows = _catalogue(spark, d)
    return rows.select("building_id", "status", *[F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c) for c in ("grid_cells", "asset_urls", "flight_years", "densities", "failed_cells")])


def a22_catalogue_summary(spark, d):
    return _r(batch.catalogue_summary(_catalogue(spark, d)))


def u04_missing_by_building(spark, d):
    """Classes that occur in the table but not among a selected building's own detections, large masks only."""
    seen = view(spark, d, "v_detections").where("pixel_area > 56").select("building_id", "class_name").distinct()
    every = F.broadcast(seen.select("class_name").distinct())  # a row a class
    own = view(spark, d, "v_selection").select("building_id").join(seen.select("building_id").distinct(), "building_id", "left_semi")
    return own.join(every, F.lit(True)).join(seen, ["building_id", "class_name"], "left_anti")


def _unrounded(sql: str) -> str:
    """What rests on other queries' measures takes them as they are before they are rounded for show."""
    inner = r"(?:[^()]|\([^()]*(?:\([^()]*\)[^()]*)*\))"
    return re.sub(rf"round\(({inner}*?)(?: \+ 1e-9::double)?, 6\)", r"(\1)", sql)


_S = {k: _unrounded(s) for k, s in spatial_queries.ORACLES.items()}
_A11, _A09, _NDSM = _unrounded(surface_queries.ORACLES["a11_quality_report"]), _unrounded(surface_queries.ORACLES["a09_local_planes"]), _S["r07_normalized"]
_CATALOGUE = f"""{prelude("v_edges")},
b as (select building_id, cast(floor((min(x1)-700)/1000) as bigint) as e1, cast(ceil((max(x1)+700)/1000) as bigint)-1 as e2, cast(floor((min(y1)-700)/1000) as bigint) as n1, cast(ceil((max(y1)+700)/1000) as bigint)-1 as n2 from v_edges group by building_id),
c as (select building_id, unnest(range(e1, e2+1)) as e, n1, n2 from b), cells as (select building_id, e, unnest(range(n1, n2+1)) + 1 as n from c),
m as (select building_id, e || '-' || n || '-H30' as cell, e + n as s, (e + n) % 3 <> 0 as ok from cells),
a as (select building_id, case when bool_and(ok) then 'catalog_verified' when bool_or(ok) then 'partial_coverage' else 'catalog_unavailable' end as status, string_agg(cell, ',' order by cell) as grid_cells,
  coalesce(string_agg('u/' || cell, ',' order by cell) filter (where ok), '') as asset_urls, coalesce(string_agg(distinct cast(2015 + s % 4 as varchar), ',' order by cast(2015 + s % 4 as varchar)) filter (where ok), '') as flight_years,
  coalesce(string_agg(distinct cast(s % 2 + 0.5::double as varchar), ',' order by cast(s % 2 + 0.5::double as varchar)) filter (where ok), '') as densities, coalesce(string_agg(cell, ',' order by cell) filter (where not ok), '') as failed_cells from m group by building_id)"""
_BATCH = f"""{prelude("v_selection", "v_detections")},
f as (select cast(c_custkey as bigint) as building_id, case when c_nationkey = 3 then '{batch.NO_FOOTPRINT}' when c_nationkey = 5 then '{batch.NO_IMAGE}' when c_acctbal < -900 then 'segmentation failed' end as error from customer),
raw as (select building_id, count(*) as n from v_detections group by building_id),
cl as (select building_id, class_name, count(*) as n from v_detections where pixel_area > 0 and confidence >= 0.25 group by all),
kept as (select building_id, sum(n) as n, '{{' || string_agg('"' || class_name || '":' || n, ',' order by class_name) || '}}' as classes from cl group by building_id),
r as (select s.building_id, s.profile, case when f.error is null then 'completed' else 'failed' end as status, cast(case when f.error is null then coalesce(raw.n, 0) else 0 end as bigint) as raw_candidates, cast(case when f.error is null then coalesce(kept.n, 0) else 0 end as bigint) as retained_objects,
  case when f.error is null then coalesce(kept.classes, '{{}}') else '{{}}' end as retained_classes, f.error from v_selection s join f using (building_id) left join raw using (building_id) left join kept using (building_id))"""

ORACLES = {
    "c01_chain": f"""with q as ({_A11}), pl as ({_A09}), nd as ({_NDSM}),
vr as (select building_id, count(above_ground)/count(*)::double as valid_ratio from nd group by building_id), v as (select building_id, row, col, above_ground as h from nd where above_ground is not null),
st as (select a.building_id, round(abs(a.h-b.h), 9) as d from v a join v b on a.building_id = b.building_id and ((a.row = b.row and a.col = b.col+1) or (a.col = b.col and a.row = b.row+1))),
hm as (select building_id, quantile_cont(d/2, 0.5) as gradient_p50, quantile_cont(d/2, 0.95) as gradient_p95, avg(case when d >= 1 then 1 else 0 end) as discontinuity from st group by building_id),
mo as ({_S["g05_morphology"]}), su as ({_S["a02_building_summary"]}),
e as (select q.building_id, roof_point_count as roof_points, density_roof as density, coverage_100m as coverage, largest_hole_ratio as hole_ratio, case when roof_point_count >= 3 then planar_support end as planar, alignment_score as alignment, coalesce(valid_ratio, 0) as valid_ratio,
  gradient_p50, gradient_p95, discontinuity, vertices, compactness, area_m2 > 0 as footprint_ok, ground_p50 is not null as ground_ok, coalesce(height_p50 > 0, false) as height_ok, available
  from q left join pl using (building_id) left join vr using (building_id) left join hm using (building_id) left join mo using (building_id) left join su using (building_id)),
g as (select *, footprint_ok and ground_ok and height_ok and available and roof_points > 0 as lod12 from e)
select g.building_id, roof_points, round(density, 6) as density, round(coverage, 6) as coverage, round(hole_ratio, 6) as hole_ratio, round(planar, 6) as planar, round(alignment, 6) as alignment, round(valid_ratio, 6) as valid_ratio, round(gradient_p50, 6) as gradient_p50, round(gradient_p95, 6) as gradient_p95,
  round(discontinuity, 6) as discontinuity, vertices, round(compactness, 6) as compactness, footprint_ok, ground_ok, height_ok, available,
  case when coalesce(density < 1.0, true) or valid_ratio < 0.55 or planar is null then 'INSUFFICIENT_EVIDENCE' when gradient_p95 <= 0.25 and discontinuity <= 0.05 then 'FLAT' when gradient_p95 >= 1.0 or discontinuity >= 0.15 then 'COMPOUND' when planar >= 0.60 and gradient_p50 >= 0.08 then 'PITCHED' else 'UNCERTAIN' end as roof_form,
  round((least(greatest(valid_ratio, 0), 1) + coalesce(least(greatest(density/4, 0), 1), 0) + coalesce(least(greatest(planar, 0), 1), 0)) / (1 + (density is not null)::int + (planar is not null)::int), 6) as evidence_score,
  lod12, lod12 and coalesce(coverage, 0) >= 0.65 and coalesce(discontinuity >= 0.05, false) as lod13,
  case when g.building_id % 3 = 2 and g.building_id % 5 > 1 then 'a forced run needs a named backend' when g.building_id % 3 = 0 and g.building_id % 7 = 0 then 'a strict policy excludes this priority' end as request_error from g""",
    "a21_batch": f"{_BATCH} select * from r",
    "a21_batch_summary": f"""{_BATCH} select count(*) as selected_buildings, count(*) filter (where status = 'completed') as completed_buildings, count(*) filter (where status = 'failed') as failed_buildings, cast(sum(raw_candidates) as bigint) as raw_candidates, cast(sum(retained_objects) as bigint) as retained_objects from r""",
    "a22_catalogue": f"{_CATALOGUE} select * from a",
    "a22_catalogue_summary": f"""{_CATALOGUE} select count(*) as selected_buildings, count(*) filter (where status = 'catalog_verified') as catalog_verified_buildings, count(*) filter (where status = 'partial_coverage') as partial_coverage_buildings,
  count(*) filter (where status = 'catalog_unavailable') as catalog_unavailable_buildings, (select count(distinct cell) from m) as unique_grid_cells, (select count(distinct cell) from m where ok) as verified_cells, (select count(distinct cell) from m where not ok) as failed_cells from a""",
    "u04_missing_by_building": f"""{prelude("v_selection", "v_detections")}, s as (select distinct building_id, class_name from v_detections where pixel_area > 56), own as (select distinct building_id from v_selection semi join s using (building_id))
select building_id, class_name from own cross join (select distinct class_name from s) c anti join s using (building_id, class_name)""",
}
_HEAD, _TAIL = ORACLES["c01_chain"].rsplit("select g.building_id, roof_points", 1)
ORACLES["c01_chain"] = _HEAD + "select g.building_id, roof_points" + _TAIL.replace(", 6) as", " + 1e-9::double, 6) as")
QUERIES = {k: globals()[k] for k in (*ORACLES, "c02_plans")}
