"""Queries on decision rules and benchmarks, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from gablestone.operators import benchmarks, decisions, lifecycle, spatial
from gablestone.plans.spatial_queries import _r
from gablestone.sources.adapters import prelude, view

MAPPING = {"pv_panel": "pv_panel", "hvac_unit": "hvac_unit", "chimney": "chimney", "skylight": "skylight"}
TAXONOMY = ["pv_panel", "hvac_unit", "chimney", "elevator_overrun", "skylight"]


QUALITY_CLASS = "case cast(building_id % 5 as int) when 0 then 'EXCELLENT' when 1 then 'GOOD' else 'UNCLASSIFIED' end"


def _evidence(spark, d):
    return view(spark, d, "v_evidence")


def _accepted(spark, d):
    return decisions.with_quality_gate(view(spark, d, "v_entries"))


def d01_roof_form(spark, d):
    c = [F.col(x) for x in ("density", "valid_ratio", "planar", "gradient_p50", "gradient_p95", "discontinuity")]
    form = decisions.roof_form(*c)
    return _r(_evidence(spark, d).select("building_id", form.alias("roof_form"), decisions.evidence_score(*c[:3]).alias("evidence_score"), F.array_join(decisions.roof_form_reasons(form, *c[:3]), "; ").alias("reasons")))


def d03_complexity(spark, d):
    rows = decisions.with_complexity(_evidence(spark, d))
    return _r(rows.select("building_id", "complexity_score", "complexity_class", F.array_join("complexity_reasons", "; ").alias("reasons")))


def d06_feasibility(spark, d):
    rows = decisions.with_feasibility(decisions.with_complexity(_evidence(spark, d)))
    reasons = [F.array_join(f"{x}_reasons", "; ").alias(f"{x}_reasons") for x in ("lod12", "lod13", "lod22")]
    return _r(rows.select("building_id", "lod12", "lod13", "lod22", "lod12_score", "lod13_score", "lod22_score", "highest_lod", *reasons))


def d09_plan(spark, d):
    rows = decisions.with_complexity(_evidence(spark, d)).withColumn("quality_class", F.expr(QUALITY_CLASS))
    rows = decisions.with_plan(decisions.with_feasibility(rows))
    lists = [F.array_join(c, "; ").alias(c) for c in ("plan_reasons", "plan_warnings")]
    return rows.select("building_id", "target_lod", "selected_backend", "fallback_lod", "profile", "forced", "decision", *lists)


def d18_quality_gate(spark, d):
    return _accepted(spark, d).select("building_id", "input_ord", "accepted", "confidence", F.array_join("failures", "; ").alias("failures"))


def w04_ranking(spark, d):
    return _r(benchmarks.ranking(_accepted(spark, d)).select("building_id", "input_ord", "backend", "rank"))


def a20_backend_summary(spark, d):
    return _r(benchmarks.backend_summary(_accepted(spark, d)))


def j13_building_matrix(spark, d):
    return _r(benchmarks.building_matrix(view(spark, d, "v_selection"), view(spark, d, "v_entries")))


def a22_catalog_audit(spark, d):
    cells = spatial.grid_cells(spatial.footprints(view(spark, d, "v_edges")), 25.0)
    assets = cells.where("northing_km % 2 = 0 or easting_km % 2 = 0").select("cell_id", F.expr("2020 + easting_km % 3").alias("year"), F.expr("northing_km % 4 + 1").alias("density")).distinct()
    return benchmarks.catalog_audit(cells, assets)


def a21_detection_counts(spark, d):
    return _r(benchmarks.detection_counts(view(spark, d, "v_selection"), view(spark, d, "v_detections")))


def d21_annotation_queue(spark, d):
    return _r(benchmarks.annotation_queue(view(spark, d, "v_selection"), view(spark, d, "v_detections")))


def a24_queue_summary(spark, d):
    return _r(benchmarks.queue_summary(benchmarks.annotation_queue(view(spark, d, "v_selection"), view(spark, d, "v_detections"))))


def a21_detection_totals(spark, d):
    return _r(benchmarks.detection_totals(benchmarks.detection_counts(view(spark, d, "v_selection"), view(spark, d, "v_detections"))))


def d15_outcomes(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").select(
        F.col("o_orderkey").cast("bigint").alias("building_id"), F.lit("roofer").alias("selected_backend"), F.expr("if(o_orderkey % 2 = 0, '2.2', '1.3')").alias("target_lod"), F.expr("if(o_orderkey % 3 = 0, null, '1.2')").alias("fallback_lod"),
        F.expr("if(o_orderkey % 11 = 0, 'no_lod', 'execute')").alias("decision"), "o_custkey",
    )
    first = o.selectExpr("building_id", "'roofer' as backend", "target_lod as lod", "o_custkey % 5 <> 0 as succeeded", "o_custkey % 3 = 0 as accepted")
    again = o.where("o_custkey % 7 <> 0").selectExpr("building_id", "'roofer' as backend", "'1.2' as lod", "o_custkey % 4 <> 0 as succeeded", "o_custkey % 2 = 0 as accepted")
    return lifecycle.outcomes(o.drop("o_custkey"), first.union(again))


def u08_split_membership(spark, d):
    own = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").cast("string").alias("name"))
    return benchmarks.split_membership(own, own.where("cast(name as bigint) % 3 = 0"), own.where("cast(name as bigint) % 4 < 2"))


def u02_first_seen(spark, d):
    own = spark.read.parquet(f"{d}/lineitem.parquet").selectExpr("cast(l_suppkey % 50 as bigint) as cell", "cast(l_orderkey as bigint) * 10 + l_linenumber as ord")
    return _r(benchmarks.first_seen(own, ["cell"], "ord"))


def t05_best_by(spark, d):
    own = view(spark, d, "v_entries").select("building_id", "rmse_m", "input_ord", "backend")
    return _r(benchmarks.best_by(own, "building_id", "rmse_m", ["input_ord", "backend"]))


def j12_evaluated(spark, d):
    done = view(spark, d, "v_entries").groupBy("building_id").agg(F.count("*").alias("entries"), F.bool_or("geometry_valid").alias("completed"))
    rasters = view(spark, d, "v_detections").select("building_id")
    return _r(benchmarks.evaluated(view(spark, d, "v_selection").select("building_id", "profile"), done, rasters))


def d19_entries(spark, d):
    own = view(spark, d, "v_evidence").select("building_id", F.col("backend_request").alias("backend"))
    return benchmarks.flat_entries(own)


def d23_taxonomy(spark, d):
    own = spark.read.parquet(f"{d}/part.parquet").selectExpr("cast(p_size as string) as version", "row_number() over (partition by p_size order by p_partkey) - 1 + if(p_size % 7 = 0, 1, 0) as class_id")
    return benchmarks.taxonomy_error(own)


def a27_mean_position(spark, d):
    own = view(spark, d, "v_edges").where("ring_id = 0")
    return _r(benchmarks.mean_position(own.selectExpr("building_id", "x1 as x", "y1 as y").union(own.where("edge_id = 0").selectExpr("building_id", "x1", "y1"))))


def a30_digests(spark, d):
    own = spark.read.parquet(f"{d}/pages.parquet").selectExpr("cast(page_id as string) as name", "cast(html as binary) as content")
    pinned = own.selectExpr("name", "if(cast(name as bigint) % 3 = 0, upper(md5(content)), md5(name)) as md5").where("cast(name as bigint) % 5 <> 0")
    return benchmarks.digests(own, pinned)


def j11_map_labels(spark, d):
    return benchmarks.map_labels(view(spark, d, "v_detections"), MAPPING)


def u04_missing_classes(spark, d):
    return benchmarks.missing_classes(TAXONOMY, MAPPING, spark)


_C01 = "least(greatest({}, 0), 1)"
_PARTS = """list_filter([{'i': 0, 'name': 'irregular footprint', 'v': ((1-compactness) + least(greatest((vertices-4)/12.0::double, 0), 1))/2, 'w': 0.15::double}, {'i': 1, 'name': 'multiple preliminary planes', 'v': least(greatest((planes-1)/5.0::double, 0), 1), 'w': 0.25::double},
 {'i': 2, 'name': 'multiple dominant orientations', 'v': least(greatest((normals-1)/3.0::double, 0), 1), 'w': 0.15::double}, {'i': 3, 'name': 'roof observations not explained by dominant planes', 'v': 1-explained, 'w': 0.15::double},
 case when parts is not null then {'i': 4, 'name': 'multiple cadastral building parts', 'v': least(greatest((parts-1)/4.0::double, 0), 1), 'w': 0.1::double} end, {'i': 5, 'name': 'frequent nDSM height discontinuities', 'v': least(discontinuity/0.2::double, 1), 'w': 0.2::double}], lambda c: c is not null)"""
_CPLX = f"""{prelude("v_evidence")}, cp as (select *, {_PARTS} as ps from v_evidence),
cx as (select *, list_sum(list_transform(ps, lambda c: c.v*c.w))/list_sum(list_transform(ps, lambda c: c.w)) as score from cp),
cl as (select *, case when score < 0.25 then 'SIMPLE' when score < 0.5 then 'MODERATE' when score < 0.75 then 'COMPLEX' else 'VERY_COMPLEX' end as cls from cx)"""
_FEAS = f"""{_CPLX}, f1 as (select *, available and roof_points > 0 as obs, coalesce(coverage, 0) as cov, 1 - coalesce(hole_ratio, 1) as hole, case cls when 'SIMPLE' then 1.0::double when 'MODERATE' then 0.85 when 'COMPLEX' then 0.65 else 0.4 end as sup from cl),
f2 as (select *, footprint_ok and ground_ok and height_ok and obs as lod12, (footprint_ok::int + ground_ok::int + height_ok::int + obs::int)/4.0::double as lod12_score, (coalesce(parts, 0) > 1 or discontinuity >= 0.05) as st,
  (least(coalesce(density, 0)/5, 1) + cov + hole + coalesce(planar, 0) + alignment + explained + valid_ratio + sup)/8 as lod22_score from f1),
f3 as (select *, lod12 and cov >= 0.65 and st as lod13, (lod12::int + (cov >= 0.65)::int + st::int)/3.0::double as lod13_score,
  lod12 and coalesce(density, 0) >= 2.5 and cov >= 0.75 and hole >= 0.7 and coalesce(planar, 0) >= 0.5 and alignment >= 0.7 and explained >= 0.4 and lod22_score >= 0.68 as lod22 from f2),
f4 as (select *, case when lod22 then '2.2' when lod13 then '1.3' when lod12 then '1.2' end as highest_lod from f3)"""
_GATE = f"""{prelude("v_entries")}, g as (select *, list_filter([case when not geometry_valid then 'geometry is not valid' end, case when not plausibility_pass then 'geometry is not plausible' end, case when rmse_m > 1 then 'point-to-surface RMSE exceeds acceptance threshold' end,
  case when p95_m > 2 then 'point-to-surface P95 exceeds acceptance threshold' end, case when within_050m < 0.75 then 'insufficient roof points lie within 0.5 m of the model' end], lambda f: f is not null) as fl from v_entries),
q as (select *, len(fl) = 0 as accepted from g)"""

FR, FM = decisions.FORM_REASONS, decisions.FORM_MISSING


def _why(lod: str, prefix: str, checks: tuple) -> str:
    names = {"1.2": decisions.LOD12_CHECKS, "1.3": decisions.LOD13_CHECKS, "2.2": decisions.LOD22_CHECKS}[lod]
    failed = ", ".join(f"case when not coalesce({c}, false) then '{prefix}{n}' end" for c, n in zip(checks, names, strict=True))
    return f"coalesce(nullif(array_to_string(list_filter([{failed}], lambda x: x is not null), '; '), ''), '{decisions.LOD_SUPPORTED[lod]}')"


ORACLES = {
    "d01_roof_form": f"""{prelude("v_evidence")} select building_id, case when density is null or density < 1 or valid_ratio < 0.55 or planar is null then 'INSUFFICIENT_EVIDENCE' when gradient_p95 <= 0.25 and discontinuity <= 0.05 then 'FLAT'
  when gradient_p95 >= 1 or discontinuity >= 0.15 then 'COMPOUND' when planar >= 0.6 and gradient_p50 >= 0.08 then 'PITCHED' else 'UNCERTAIN' end as roof_form,
  round((valid_ratio + case when density is null then 0 else least(density/4, 1) end + coalesce(planar, 0))/(1 + (density is not null)::int + (planar is not null)::int), 6) as evidence_score,
  case when density is null or density < 1 or valid_ratio < 0.55 or planar is null then array_to_string(list_filter([case when density is null or density < 1 then '{FM[0]}' end, case when valid_ratio < 0.55 then '{FM[1]}' end, case when planar is null then '{FM[2]}' end], lambda x: x is not null), '; ')
    when gradient_p95 <= 0.25 and discontinuity <= 0.05 then '{FR["FLAT"]}' when gradient_p95 >= 1 or discontinuity >= 0.15 then '{FR["COMPOUND"]}' when planar >= 0.6 and gradient_p50 >= 0.08 then '{FR["PITCHED"]}' else '{FR["UNCERTAIN"]}' end as reasons from v_evidence""",
    "d03_complexity": f"""{_CPLX} select building_id, round(score, 6) as complexity_score, cls as complexity_class,
  coalesce(nullif(array_to_string(list_transform(list_filter(list_sort(list_transform(ps, lambda c: {{'k': -(c.v*c.w), 'i': c.i, 'name': c.name, 'v': c.v}})), lambda c: c.v >= 0.25)[1:3], lambda c: c.name), '; '), ''), 'all available complexity indicators are low') as reasons from cl""",
    "d06_feasibility": f"{_FEAS} select building_id, lod12, lod13, lod22, round(lod12_score, 6) as lod12_score, round(lod13_score, 6) as lod13_score, round(lod22_score, 6) as lod22_score, highest_lod, {_why("1.2", "missing ", ("footprint_ok", "ground_ok", "height_ok", "obs"))} as lod12_reasons, {_why("1.3", "insufficient ", ("lod12", "cov >= 0.65", "st"))} as lod13_reasons, "
    f"{_why('2.2', 'insufficient ', ('lod12', 'coalesce(density, 0) >= 2.5', 'cov >= 0.75', 'hole >= 0.7', 'coalesce(planar, 0) >= 0.5', 'alignment >= 0.7', 'explained >= 0.4', 'lod22_score >= 0.68'))} as lod22_reasons from f4",
    "d09_plan": f"""{_FEAS}, p1 as (select *, case lod_request when '1.2' then lod12 when '1.3' then lod13 when '2.2' then lod22 end as sup_req from f4),
p2 as (select *, lod_request <> 'auto' and not coalesce(sup_req, false) and policy = 'force_experimental' as forced, case when lod_request = 'auto' then highest_lod when sup_req then lod_request when policy = 'force_experimental' then lod_request
  when policy = 'fallback' then case when lod_request = '2.2' and lod13 then '1.3' when lod_request <> '1.2' and lod12 then '1.2' end end as target_lod from p1),
p3 as (select *, case when available and backend_request in ('auto', 'roofer') and target_lod is not null then 'roofer' when available and backend_request in ('auto', 'city3d') and target_lod = '2.2' then 'city3d' end as selected_backend,
  case when policy = 'fallback' then case when target_lod = '2.2' and lod13 then '1.3' when target_lod <> '1.2' and lod12 then '1.2' end end as fallback_lod from p2)
select building_id, target_lod, selected_backend, fallback_lod, case when selected_backend = 'roofer' then case when building_id % 5 in (0, 1) and cls in ('SIMPLE', 'MODERATE') then 'balanced' else 'conservative' end end as profile, forced,
  case when target_lod is null then 'no_lod' when selected_backend is null then 'no_backend' else 'execute' end as decision,
  concat_ws('; ', case when lod_request = 'auto' and target_lod is not null then 'automatic target is highest supported LoD ' || target_lod when lod_request = 'auto' then 'no LoD is supported by available evidence' when sup_req then 'requested LoD ' || lod_request || ' is supported'
    when forced then 'forced unsupported LoD ' || lod_request when target_lod is not null then 'downgraded unsupported request to LoD ' || target_lod else 'requested LoD ' || lod_request || ' is not supported' end,
    case when target_lod is null then null when selected_backend is null then '{decisions.NO_BACKEND}' else 'selected available ' || selected_backend || ' backend' end) as plan_reasons,
  case when forced and target_lod is not null and selected_backend is not null then '{decisions.FORCED_WARNING}' else '' end as plan_warnings from p3""",
    "d18_quality_gate": f"{_GATE} select building_id, input_ord, accepted, case when accepted and rmse_m <= 0.3 and p95_m <= 0.6 and within_050m >= 0.9 then 'HIGH' when accepted then 'MEDIUM' else 'LOW' end as confidence, array_to_string(fl, '; ') as failures from q",
    "w04_ranking": f"{_GATE} select building_id, input_ord, backend, row_number() over (partition by building_id order by rmse_m, p95_m, input_ord) as rank from q where accepted",
    "a20_backend_summary": f"{_GATE} select b.backend, count(q.backend) as evaluated, count(*) filter (where q.accepted) as accepted, round(avg(rmse_m), 6) as mean_rmse, round(avg(p95_m), 6) as mean_p95 from (values ('roofer'), ('city3d')) as b(backend) left join q on q.backend = b.backend group by b.backend",
    "j13_building_matrix": f"""{prelude("v_selection", "v_entries")} select s.building_id, b.backend, round(min(rmse_m), 6) as best_rmse, count(e.backend) as entries, case when count(e.backend) = 0 then 'no artifact' end as reason
  from (select distinct building_id from v_selection) s cross join (values ('roofer'), ('city3d')) as b(backend) left join v_entries e on e.building_id = s.building_id and e.backend = b.backend group by all""",
    "a22_catalog_audit": f"""{prelude("v_edges")},
b as (select building_id, cast(floor((min(x1)-25)/1000) as bigint) as e1, cast(ceil((max(x1)+25)/1000) as bigint)-1 as e2, cast(floor((min(y1)-25)/1000) as bigint) as n1, cast(ceil((max(y1)+25)/1000) as bigint)-1 as n2 from v_edges group by building_id),
c as (select building_id, unnest(range(e1, e2+1)) as e, n1, n2 from b), d as (select building_id, e, unnest(range(n1, n2+1)) as n from c),
a as (select building_id, e, n, case when n % 2 = 0 or e % 2 = 0 then 2020 + e % 3 end as year, case when n % 2 = 0 or e % 2 = 0 then n % 4 + 1 end as density from d)
select building_id, count(*) as cells, count(year) as found, array_to_string(list_sort(list_distinct(list(year) filter (where year is not null))), ',') as years, array_to_string(list_sort(list_distinct(list(density) filter (where density is not null))), ',') as densities,
  case when count(year) = count(*) then 'verified' when count(year) > 0 then 'partial' else 'unavailable' end as status from a group by building_id""",
    "a21_detection_counts": f"""{prelude("v_selection", "v_detections")} select s.building_id, class_name, count(object_id) as objects, cast(coalesce(sum(pixel_area), 0) as bigint) as pixels from v_selection s left join (select * from v_detections where pixel_area > 0) t on t.building_id = s.building_id group by all""",
    "a21_detection_totals": f"""{prelude("v_selection", "v_detections")}, c as (select s.building_id, class_name, count(object_id) as objects, cast(coalesce(sum(pixel_area), 0) as bigint) as pixels from v_selection s left join (select * from v_detections where pixel_area > 0) t on t.building_id = s.building_id group by all)
select class_name, count(distinct building_id) as buildings, cast(sum(objects) as bigint) as objects, cast(sum(pixels) as bigint) as pixels from c where class_name is not null group by class_name union all select null, count(distinct building_id), cast(sum(objects) as bigint), cast(sum(pixels) as bigint) from c""",
    "a24_queue_summary": f"""{prelude("v_selection", "v_detections")}, k as (select building_id, count(*) as retained, bool_or(class_name = 'pv_panel') as pv from v_detections where pixel_area > 0 group by building_id),
p as (select case when photovoltaic_panels = 'user_reported' and not coalesce(pv, false) then 'high' when coalesce(retained, 0) > 0 then 'medium' else 'low' end as priority from v_selection s left join k on k.building_id = s.building_id)
select count(*) filter (where priority = 'high') as high, count(*) filter (where priority = 'medium') as medium, count(*) filter (where priority = 'low') as low, count(*) as buildings from p""",
    "d15_outcomes": f"""with o as (select cast(o_orderkey as bigint) as b, o_orderkey % 11 <> 0 as run, o_orderkey % 3 <> 0 as fb, case when o_orderkey % 2 = 0 then '2.2' else '1.3' end as lod, o_custkey % 5 <> 0 as ok1, o_custkey % 3 = 0 as acc, o_custkey % 7 <> 0 and o_custkey % 4 <> 0 as ok2 from orders),
s as (select *, case when not run then 'ABSTAINED' when not ok1 then 'FAILED' when acc then 'SUCCEEDED' when not fb then 'ABSTAINED' when ok2 then 'SUCCEEDED' else 'FAILED' end as status from o)
select b as building_id, status, case when status = 'SUCCEEDED' then case when acc then lod else '1.2' end end as delivered_lod, case when run and ok1 and not acc and fb then '{lifecycle.FALLBACK_WARNING}' end as warning from s""",
    "u08_split_membership": "select p_partkey::varchar as name, case when p_partkey % 3 = 0 then 'train' when p_partkey % 4 < 2 then 'val' end as split, case when p_partkey % 3 <> 0 and p_partkey % 4 >= 2 then 'absent from both splits' end as split_error from part",
    "u02_first_seen": "select cast(l_suppkey % 50 as bigint) as cell, min(cast(l_orderkey as bigint) * 10 + l_linenumber) as first from lineitem group by 1",
    "t05_best_by": f"{prelude('v_entries')}, r as (select *, row_number() over (partition by building_id order by rmse_m, input_ord) as k from v_entries) select building_id, round(rmse_m, 6) as rmse_m, input_ord, backend from r where k = 1",
    "j12_evaluated": f"{prelude('v_selection', 'v_entries', 'v_detections')} select s.building_id, s.profile, e.entries from v_selection s join (select building_id, count(*) as entries from v_entries group by building_id having bool_or(geometry_valid)) e on e.building_id = s.building_id where s.building_id in (select building_id from v_detections)",
    "d19_entries": f"{prelude('v_evidence')} select building_id, backend_request as backend, case when backend_request = 'auto' then 'an entry needs the backend that ran' end as entry_error from v_evidence",
    "d23_taxonomy": "select p_size::varchar as version, case when p_size % 7 = 0 then 'class numbers are not contiguous from zero' end as error from part group by p_size",
    "a27_mean_position": f"{prelude('v_edges')}, e as (select * from v_edges where ring_id = 0), q as (select building_id, x1, y1 from e union all select building_id, x1, y1 from e where edge_id = 0) select building_id, round(avg(x1), 6) as x, round(avg(y1), 6) as y from q group by building_id",
    "a30_digests": "select page_id::varchar as name, md5(html) as actual, case when page_id % 5 <> 0 then case when page_id % 3 = 0 then md5(html) else md5(page_id::varchar) end end as expected, case when page_id % 5 <> 0 then md5(html) = case when page_id % 3 = 0 then md5(html) else md5(page_id::varchar) end end as matches from pages",
    "d21_annotation_queue": f"""{prelude("v_selection", "v_detections")}, k as (select building_id, count(*) as retained, bool_or(class_name = 'pv_panel') as pv from v_detections where pixel_area > 0 group by building_id),
p as (select s.building_id, coalesce(retained, 0) as retained, case when photovoltaic_panels = 'user_reported' and not coalesce(pv, false) then 'high' when coalesce(retained, 0) > 0 then 'medium' else 'low' end as priority from v_selection s left join k on k.building_id = s.building_id)
select building_id, retained, priority, cast(case priority when 'high' then 0 when 'medium' then 1 else 2 end as bigint) as priority_rank from p""",
    "j11_map_labels": f"{prelude('v_detections')} select class_name, case when class_name <> 'elevator_overrun' then class_name end as canonical, count(*) as objects, class_name = 'elevator_overrun' as ignored from v_detections group by all",
    "u04_missing_classes": "select 'elevator_overrun' as canonical",
}
ORACLES = {k: s.replace(", 6) as", " + 1e-9::double, 6) as") for k, s in ORACLES.items()}
QUERIES = {k: globals()[k] for k in ORACLES}
