"""Queries on meshes, point quality, projection and text rules, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from gablestone.functions import projection, text
from gablestone.operators import cloud_quality, evidence, meshes, rasters, spatial
from gablestone.plans import spatial_queries
from gablestone.plans.spatial_queries import KEYS, _cells, _near, _r
from gablestone.sources.adapters import VIEWS, prelude, view

K = ["k1", "k2", "k3", "k4"]


def _mesh(spark, d):
    return view(spark, d, "v_mesh_v"), view(spark, d, "v_mesh_f")


def _roof(spark, d):
    found = spatial.in_footprints(view(spark, d, "v_points").where("classification = 6"), view(spark, d, "v_edges")).where("inside")
    return found.select("building_id", *K, "x", "y", "z")


def a18_edge_report(spark, d):
    return _r(meshes.edge_report(_mesh(spark, d)[1]))


def g08_face_areas(spark, d):
    return _r(meshes.face_areas(*_mesh(spark, d)))


def a19_semantic_histogram(spark, d):
    return _r(meshes.semantic_histogram(_mesh(spark, d)[1]))


def d16_mesh_validation(spark, d):
    return _r(meshes.validate(*_mesh(spark, d), spatial.footprints(view(spark, d, "v_edges"))))


def d17_obj_validation(spark, d):
    """The same solids as polygon soup: each face with corners of its own, every fifth model broken."""
    v, f = _mesh(spark, d)
    own = f.join(v, ["model_id", "vertex_idx"]).withColumn("own", F.col("face_id") * 10 + F.col("ordinal"))
    loose = f.select("model_id", "face_id", "ordinal", F.lit(None).cast("string").alias("semantic"), F.when((F.col("model_id") % 5 == 0) & (F.col("face_id") == 1) & (F.col("ordinal") == 0), 999).otherwise(F.col("face_id") * 10 + F.col("ordinal")).alias("vertex_idx"))
    return _r(meshes.validate_obj(own.select("model_id", F.col("own").alias("vertex_idx"), "x", "y", "z"), loose, spatial.footprints(view(spark, d, "v_edges"))))


def a15_valid_ratio(spark, d):
    return _r(evidence.valid_ratio(rasters.height_raster(view(spark, d, "v_points"), view(spark, d, "v_edges"), 2.0)))


def a16_height_statistics(spark, d):
    return _r(evidence.height_statistics(spatial_queries.r07_normalized(spark, d)))


def p10_above_ground(spark, d):
    own = spatial.in_footprints(view(spark, d, "v_points"), view(spark, d, "v_edges")).where("inside").select("building_id", *K, "z", "classification")
    return _r(evidence.above_ground(own).select("building_id", *K, "above"))


def a11_quality_report(spark, d):
    """All but the local planes, which a09 checks."""
    return _r(evidence.quality_report(view(spark, d, "v_points"), view(spark, d, "v_edges"), ["src_building", *K]).drop("planar_support", "residual_p50"))


def _residuals(spark, d):
    return meshes.residuals(_roof(spark, d).withColumnRenamed("building_id", "model_id"), meshes.roof_triangles(*_mesh(spark, d)), tuple(K))


def a17_fit_report(spark, d):
    return _r(meshes.fit_report(_residuals(spark, d)).drop("status"))


def t03_largest_residuals(spark, d):
    return _r(meshes.largest_residuals(_residuals(spark, d).withColumn("distance", F.round("distance", 6)), tuple(K)))


def a07_outlier_ratio(spark, d):
    return _r(cloud_quality.outlier_ratio(_roof(spark, d)))


def a08_spacing(spark, d):
    return _r(cloud_quality.spacing(_roof(spark, d), K))


def d26_roof_observations(spark, d):
    return _r(cloud_quality.roof_observations(_roof(spark, d), K))


def a09_local_planes(spark, d):
    return _r(cloud_quality.local_planes(_roof(spark, d), K))


def x01_roof_planes(spark, d):
    return _r(cloud_quality.roof_planes(_roof(spark, d), K, threshold=0.6))


def x04_dominant_normals(spark, d):
    return _r(cloud_quality.dominant_normals(cloud_quality.roof_planes(_roof(spark, d), K, threshold=0.6)))


def g02_geographic(spark, d):
    own = view(spark, d, "v_edges").select("building_id", "ring_id", "edge_id", "x1", "y1")
    return _r(projection.apply(own, projection.to_geographic("x1", "y1"), ("lon", "lat")).select("building_id", "ring_id", "edge_id", F.round("lon", 8).alias("lon"), F.round("lat", 8).alias("lat")))


def g01_utm(spark, d):
    own = spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey", "cast(o_orderkey % 600 as double)/100 - 6 as lon", "cast(o_custkey % 800 as double)/100 + 36 as lat")
    return projection.apply(own, projection.to_utm("lon", "lat"), ("e", "n")).select("o_orderkey", F.round("e", 3).alias("easting"), F.round("n", 3).alias("northing"))


def p04_references(spark, d):
    raw = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.expr("concat('  ', lower(c_mktsegment), lpad(cast(c_custkey as string), 14 - length(c_mktsegment) + cast(c_custkey % 3 as int) * 4 - if(c_custkey % 7 = 0, 1, 0), '0'), ' ')").alias("raw"))
    return raw.select("c_custkey", text.reference(F.col("raw")).alias("reference"), text.reference_root(F.col("raw")).alias("root"))


def p11_crs(spark, d):
    raw = F.expr("case cast(o_orderkey % 4 as int) when 0 then concat('EPSG:', o_custkey) when 1 then concat('urn:ogc:def:crs:EPSG::', o_custkey) when 2 then concat('epsg:', o_custkey) else 'EPSG:25830 x' end")
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", text.crs(raw).alias("crs"))


def p13_web_urls(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", text.is_web_url(F.col("url")).alias("is_web"), text.safe_name(F.col("url")).alias("safe"))


def s11_visible_text(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", F.md5(text.visible(F.col("html"))).alias("text_md5"))


def a25_tag_counts(spark, d):
    tags = spark.read.parquet(f"{d}/pages.parquet").select(F.explode(text.tags(F.col("html"))).alias("tag"))
    return tags.groupBy("tag").agg(F.count("*").alias("n"))


def p09_image_size(spark, d):
    w, h = text.image_size(F.col("o_totalprice") / 100, (F.col("o_custkey") % 900).cast("double"), 0.25)
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", w.alias("width"), h.alias("height"))


_ROOF = f"{_near(0)}, roof as (select building_id, k1, k2, k3, k4, x, y, z from pt where inside and classification = 6)"
_FE = f"""{prelude("v_mesh_v", "v_mesh_f")}, fe as (select model_id, face_id, semantic, vertex_idx as a, coalesce(lead(vertex_idx) over w, first_value(vertex_idx) over w) as b from v_mesh_f window w as (partition by model_id, face_id order by ordinal)),
er as (select model_id, count(*) as edges, count(*) filter (where n = 1) as boundary_edges, count(*) filter (where n > 2) as nonmanifold_edges, bool_and(n = 2) as watertight from (select model_id, least(a,b) as u, greatest(a,b) as v, count(*) as n from fe group by all) group by model_id),
fc as (select fe.model_id, face_id, semantic, sum(p.y*q.z-p.z*q.y) as nx, sum(p.z*q.x-p.x*q.z) as ny, sum(p.x*q.y-p.y*q.x) as nz from fe join v_mesh_v p on p.model_id = fe.model_id and p.vertex_idx = a join v_mesh_v q on q.model_id = fe.model_id and q.vertex_idx = b group by all)"""


def _distance() -> str:
    """Residuals of roof points to fans of the top face, whose six corners are 6 .. 11 in order."""
    sql = f"""{_ROOF}, v_mesh_v as ({VIEWS["v_mesh_v"][1]}),
tri as (select a.model_id, t.k, {', '.join(f'{p}.{c} as {p}{c}' for p in 'agc' for c in 'xyz')} from (values (1),(2),(3),(4)) as t(k) join v_mesh_v a on a.vertex_idx = 6 join v_mesh_v g on g.model_id = a.model_id and g.vertex_idx = 6 + t.k join v_mesh_v c on c.model_id = a.model_id and c.vertex_idx = 7 + t.k),
s0 as (select tri.*, k1, k2, k3, k4, roof.x as px, roof.y as py, roof.z as pz from roof join tri on tri.model_id = roof.building_id)"""
    for i, step in enumerate(meshes.DISTANCE_STEPS):
        sql += f",\ns{i + 1} as (select *, {', '.join(f'{v} as {k}' for k, v in step.items())} from s{i})"
    return sql + f",\nres as (select model_id, k1, k2, k3, k4, min(distance) as distance from s{len(meshes.DISTANCE_STEPS)} group by all)"


ORACLES = {
    "a18_edge_report": f"{_FE} select * from er",
    "g08_face_areas": f"{_FE} select model_id, face_id, semantic, round(sqrt(nx*nx+ny*ny+nz*nz)/2, 6) as area, round(abs(nz)/2, 6) as area_xy from fc",
    "a19_semantic_histogram": f"{prelude('v_mesh_f')} select model_id, semantic, count(distinct face_id) as faces from v_mesh_f group by all",
    "d16_mesh_validation": f"""{_FE}, bx as (select model_id, count(*) as vertices, min(x) as lx, min(y) as ly, min(z) as lz, max(x) as hx, max(y) as hy, max(z) as hz from v_mesh_v group by model_id),
kd as (select model_id, count(distinct semantic) = 3 as complete from v_mesh_f group by model_id), ga as (select model_id, count(*) as faces, avg((sqrt(nx*nx+ny*ny+nz*nz)/2 < 0.25)::int) as tiny, sum(case when semantic = 'GroundSurface' then abs(nz)/2 end) as g from fc group by model_id),
fp as (select building_id, abs(sum(case when ring_id = 0 then x1*y2-x2*y1 end))/2 - abs(sum(case when ring_id > 0 then x1*y2-x2*y1 end))/2 as area, min(x1) as fx1, min(y1) as fy1, max(x1) as fx2, max(y1) as fy2 from v_edges group by building_id),
j as (select er.*, vertices, faces, tiny, complete, hz-lz as height, g/area as ratio, greatest(least(hx,fx2)-greatest(lx,fx1),0)*greatest(least(hy,fy2)-greatest(ly,fy1),0) as inter, (hx-lx)*(hy-ly)+(fx2-fx1)*(fy2-fy1) as both_ from er join bx using (model_id) join kd using (model_id) join ga using (model_id) left join fp on fp.building_id = model_id),
k as (select *, watertight and complete as gv, inter/(both_-inter) >= 0.8 and height between 1 and 150 as pp from j)
select model_id, vertices, faces, edges, boundary_edges, watertight, 0 as invalid_rings, round(tiny, 6) as tiny_fraction, round(height, 6) as height, round(inter/(both_-inter), 6) as iou, round(ratio, 6) as area_ratio, gv as geometry_valid, pp as plausibility_pass, gv and pp as accepted,
  concat_ws('; ', case when not watertight then '{meshes.NOT_WATERTIGHT}' end, case when not complete then '{meshes.NO_SEMANTICS}' end, case when not inter/(both_-inter) >= 0.8 then '{meshes.OFF_PRINT}' end, case when not height between 1 and 150 then '{meshes.OFF_HEIGHT}' end) as failures,
  case when ratio is null then '{meshes.NO_GROUND}' when not ratio between 0.8 and 1.2 then '{meshes.OFF_GROUND}' else '' end as warnings from k""",
    "d17_obj_validation": f"""{_FE}, w as (select * from v_mesh_f where not (model_id % 5 = 0 and face_id = 1)), g as (select fe.* from fe where not (model_id % 5 = 0 and face_id = 1)),
n0 as (select model_id, count(*) as vertices from v_mesh_f group by model_id), n1 as (select model_id, count(distinct vertex_idx) as places from v_mesh_f group by model_id),
u as (select model_id, least(a,b) as p, greatest(a,b) as q, count(*) as n from g group by all), us as (select model_id, count(*) filter (where n = 1) as boundary_edges, count(*) filter (where n > 2) as nonmanifold_edges, bool_and(n = 2) as watertight from u group by model_id),
fa as (select model_id, count(*) as faces, avg((sqrt(nx*nx+ny*ny+nz*nz)/2 < 0.25)::int) as tiny from fc where not (model_id % 5 = 0 and face_id = 1) group by model_id)
select us.model_id, vertices, faces, vertices - places as duplicates, boundary_edges, nonmanifold_edges, watertight, case when us.model_id % 5 = 0 then 1 else 0 end as invalid_faces, round(tiny, 6) as tiny_fraction, 8.0::double as height, 1.0::double as iou, watertight and us.model_id % 5 <> 0 as geometry_valid, true as plausibility_pass,
  watertight and us.model_id % 5 <> 0 as accepted, concat_ws('; ', case when us.model_id % 5 = 0 then '{meshes.BAD_FACES}' end, case when not watertight then '{meshes.OPEN_MESH}' end) as failures, '{meshes.NO_LABELS}; ' || (vertices - places) || ' duplicate vertices welded for topology checks' as warnings
from us join n0 using (model_id) join n1 using (model_id) join fa using (model_id)""",
    "a15_valid_ratio": f"{_near(0)}, {_cells(2.0)} select building_id, round(avg((height is not null)::int), 6) as valid_ratio from cells_h group by building_id",
    "a16_height_statistics": f"""{_near(0)}, {_cells(2.0)}, {prelude("v_terrain")[5:]}, a as (select c.building_id, round(height-elevation + 1e-9::double, 6) as a from cells_h c left join v_terrain t on t.building_id = c.building_id and t.trow = c.row and t.tcol = c.col)
select building_id, round(quantile_cont(a, 0.05), 6) as p05, round(quantile_cont(a, 0.5), 6) as p50, round(quantile_cont(a, 0.95), 6) as p95, round(quantile_cont(a, 0.95) - quantile_cont(a, 0.05), 6) as height_range from a where a is not null group by building_id""",
    "p10_above_ground": f"{_near(0)}, i as (select building_id, k1, k2, k3, k4, z, classification from pt where inside), m as (select building_id, median(z) as g from i where classification = 2 group by building_id) select building_id, k1, k2, k3, round(k4, 6) as k4, round(z - g, 6) as above from i left join m using (building_id)",
    "a09_local_planes": f"""{_ROOF}, s as (select a.building_id, a.k1, a.k2, a.k3, a.k4, b.x, b.y, b.z, row_number() over (partition by a.building_id, a.k1, a.k2, a.k3, a.k4 order by sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(b.z-a.z)*(b.z-a.z)), b.k1, b.k2, b.k3, b.k4) as k from roof a join roof b on a.building_id = b.building_id),
c as (select building_id, covar_pop(x,x) as xx, covar_pop(x,y) as xy, covar_pop(x,z) as xz, covar_pop(y,y) as yy, covar_pop(y,z) as yz, covar_pop(z,z) as zz, count(*) as n from s where k <= 16 group by building_id, k1, k2, k3, k4),
q as (select *, (xx+yy+zz)/3 as q from c where n >= 3), p as (select *, sqrt(((xx-q)*(xx-q)+(yy-q)*(yy-q)+(zz-q)*(zz-q)+2*(xy*xy+xz*xz+yz*yz))/6) as p from q),
r as (select *, ((xx-q)*((yy-q)*(zz-q)-yz*yz) - xy*(xy*(zz-q)-yz*xz) + xz*(xy*yz-(yy-q)*xz))/nullif(2*p*p*p, 0) as r from p), f as (select *, acos(least(greatest(coalesce(r, 1), -1), 1))/3 as f from r),
e as (select building_id, q+2*p*cos(f) as e1, greatest(q+2*p*cos(f+2*pi()/3), 0) as e3, q from f), g as (select building_id, e1, e3, 3*q-e1-e3 as e2 from e)
select building_id, round(avg((sqrt(e3) <= 0.2 and coalesce((e2-e3)/nullif(e1, 0), 0) >= 0.3)::int), 6) as planar_support, round(quantile_cont(sqrt(e3), 0.5), 6) as residual_p50 from g group by building_id""",
    "a17_fit_report": f"""{_distance()} select model_id, count(*) as points, round(quantile_cont(distance, 0.5), 6) as median_m, round(sqrt(avg(distance*distance)), 6) as rmse_m, round(quantile_cont(distance, 0.95), 6) as p95_m,
  round(avg((distance <= 0.2::double + 1e-9::double)::int), 6) as within_020m, round(avg((distance <= 0.5::double + 1e-9::double)::int), 6) as within_050m, round(avg((distance <= 1.0::double + 1e-9::double)::int), 6) as within_100m from res group by model_id""",
    "t03_largest_residuals": f"{_distance()}, rr as (select model_id, k1, k2, k3, k4, round(distance, 6) as distance_ from res) select model_id, k1, k2, k3, round(k4, 6) as k4, round(distance_, 6) as distance from rr order by distance_ desc, model_id, k1, k2, k3, rr.k4 limit 10",
    "a07_outlier_ratio": f"""{_ROOF}, m as (select building_id, median(z) as mid, count(*) as n from roof group by building_id), o as (select building_id, n, abs(z-mid) as off from roof join m using (building_id)), d as (select building_id, median(off) as mad from o group by building_id)
select building_id, round(case when any_value(n) >= 3 then avg(case when mad = 0 then (off > 0)::int else (off/(1.4826::double*mad) > 6)::int end) end, 6) as outlier_ratio from o join d using (building_id) group by building_id""",
    "a08_spacing": f"""{_ROOF}, g as (select a.building_id, a.k1, a.k2, a.k3, a.k4, min(sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y))) as gap from roof a join roof b on a.building_id = b.building_id and (a.k1 <> b.k1 or a.k2 <> b.k2 or a.k3 <> b.k3 or a.k4 <> b.k4) group by all)
select building_id, round(quantile_cont(gap, 0.5), 6) as spacing_p50, round(quantile_cont(gap, 0.9), 6) as spacing_p90 from g group by building_id""",
    "d26_roof_observations": f"""{_ROOF}, n as (select a.building_id, a.k1, a.k2, a.k3, a.k4, a.z, count(*) as around, quantile_cont(b.z, 0.8) as p80 from roof a join roof b on a.building_id = b.building_id and sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) <= 1.5 group by all)
select building_id, k1, k2, k3, round(n.k4, 6) as k4, around, around < 4 or z >= p80 - 0.75 as kept from n""",
    "g02_geographic": f"{prelude('v_edges')} select building_id, ring_id, edge_id, round(round(lon, 8), 6) as lon, round(round(lat, 8), 6) as lat from {projection.as_sql('v_edges', projection.to_geographic('x1', 'y1'), ('lon', 'lat'))}",
    "g01_utm": "select o_orderkey, round(e, 3) as easting, round(n, 3) as northing from " + projection.as_sql("(select o_orderkey, cast(o_orderkey % 600 as double)/100 - 6 as lon, cast(o_custkey % 800 as double)/100 + 36 as lat from orders)", projection.to_utm("lon", "lat"), ("e", "n")),
    "p04_references": """with r as (select c_custkey, upper(trim('  ' || lower(c_mktsegment) || lpad(c_custkey::varchar, cast(14 - length(c_mktsegment) + c_custkey % 3 * 4 - case when c_custkey % 7 = 0 then 1 else 0 end as int), '0') || ' ')) as t from customer)
select c_custkey, case when regexp_full_match(t, '[0-9A-Z]+') and length(t) in (14, 18, 20) then t end as reference, case when regexp_full_match(t, '[0-9A-Z]+') and length(t) in (14, 18, 20) then substr(t, 1, 14) end as root from r""",
    "p11_crs": "select o_orderkey, case when o_orderkey % 4 in (0, 1) then 'EPSG:' || o_custkey end as crs from orders",
    "p13_web_urls": "select page_id, regexp_matches(url, '^https?://[^/?#\\s]+') as is_web, regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g') as safe from pages",
    "s11_visible_text": "select page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[ \\t\\r\\n]+', ' ', 'g'))) as text_md5 from pages",
    "a25_tag_counts": "select tag, count(*) as n from (select unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) as tag from pages) group by tag",
    "p09_image_size": """with s as (select o_orderkey, cast(ceil(o_totalprice/100/0.25::double) as bigint) as w, cast(ceil(cast(o_custkey % 900 as double)/0.25::double) as bigint) as h from orders)
select o_orderkey, case when least(w, h) > 0 and greatest(w, h) <= 4096 then w end as width, case when least(w, h) > 0 and greatest(w, h) <= 4096 then h end as height from s""",
}
_S = spatial_queries.ORACLES
ORACLES["a11_quality_report"] = f"""with n as ({_near(0)} select building_id, any_value(area) as area, count(*) filter (where inside) as c, count(*) filter (where inside and classification = 6) as r from pt join bb using (building_id) group by building_id),
h as (select distinct cast(s_suppkey as bigint) as building_id from supplier), c5 as ({_near(0)}, {_cells(0.5)} select building_id, count(*) filter (where points > 0)/count(*)::double as cov from cells_h group by building_id), c10 as ({_S["a06_coverage"]}),
hole as ({_S["r04_empty_regions"].replace(_cells(2.0), _cells(1.0))}), sp as ({ORACLES["a08_spacing"]}), ol as ({ORACLES["a07_outlier_ratio"]}), al as ({_S["a10_alignment"]}), ar as ({_S["g05_morphology"]})
select h.building_id, (select count(*) from lineitem) > 0 as available, coalesce(c, 0) as point_count, coalesce(r, 0) as roof_point_count, round(coalesce(c, 0)/ar.area_m2, 6) as density_all, round(coalesce(r, 0)/ar.area_m2, 6) as density_roof, round(c5.cov, 6) as coverage_050m, c10.coverage as coverage_100m, hole.hole_ratio as largest_hole_ratio,
  case when r >= 2 then spacing_p50 end as spacing_p50, case when r >= 2 then spacing_p90 end as spacing_p90, outlier_ratio, al.score as alignment_score, al.sx as shift_x, al.sy as shift_y, 'UNCLASSIFIED' as quality_class, 0.0::double as quality_score,
  concat_ws('; ', case when coalesce(r, 0) = 0 then '{evidence.NO_ROOF_POINTS}' end, case when at_limit then '{evidence.AT_LIMIT}' end) as warnings
from h left join n using (building_id) left join c5 using (building_id) left join c10 using (building_id) left join hole using (building_id) left join sp using (building_id) left join ol using (building_id) left join al using (building_id) left join ar using (building_id)"""
ORACLES = {k: s.replace(", 6) as", " + 1e-9::double, 6) as") if k != "a11_quality_report" else s for k, s in ORACLES.items()}
_ROWS_ONLY = ("x01_roof_planes", "x04_dominant_normals")
QUERIES = {k: globals()[k] for k in (*ORACLES, *_ROWS_ONLY)}
