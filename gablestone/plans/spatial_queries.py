"""Queries on points, footprints and grids, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from gablestone.operators import rasters, spatial
from gablestone.sources.adapters import prelude, view

BBOX = (700000.0, 4370000.0, 700100.0, 4370050.0)
#: A box around every point of the cloud.
EVERYTHING = (690000.0, 4360000.0, 710000.0, 4470000.0)
KEYS = "src_building, k1, k2, k3, k4"


def _r(df, *keep):
    """Floats to six digits."""
    return df.select(*[F.round(F.col(c) + 1e-9, 6).alias(c) if t == "double" else F.col(c).cast("bigint").alias(c) if t in ("int", "bigint") else F.col(c) for c, t in df.dtypes])


def _pe(spark, d):
    return view(spark, d, "v_points"), view(spark, d, "v_edges")


def a01_crop_summary(spark, d):
    return _r(spatial.quality_flags(spatial.crop_summary(view(spark, d, "v_points"), BBOX), 5.0))


def a02_building_summary(spark, d):
    return _r(spatial.building_summary(*_pe(spark, d)))


def a02_class_histogram(spark, d):
    return _r(spatial.class_histogram(*_pe(spark, d)))


def a10_alignment(spark, d):
    return _r(spatial.alignment(*_pe(spark, d)))


def a03_multipolygon_summary(spark, d):
    return _r(spatial.building_summary(view(spark, d, "v_points"), view(spark, d, "v_edges2")))


def a04_multipolygon_histogram(spark, d):
    return _r(spatial.class_histogram(view(spark, d, "v_points"), view(spark, d, "v_edges2")))


def a10_multipolygon_alignment(spark, d):
    return _r(spatial.alignment(view(spark, d, "v_points"), view(spark, d, "v_edges2")))


def a06_multipolygon_coverage(spark, d):
    return _r(rasters.coverage(view(spark, d, "v_points"), view(spark, d, "v_edges2"), 1.0))


def a12_multipolygon_raster(spark, d):
    return _r(rasters.height_raster(view(spark, d, "v_points"), view(spark, d, "v_edges2"), 2.0).drop("cx", "cy"))


def a01_whole_cloud(spark, d):
    """The summary of a box around all points, with its class histogram: one group of all rows."""
    points = view(spark, d, "v_points")
    return _r(spatial.quality_flags(spatial.crop_summary(points, EVERYTHING), 5.0).crossJoin(spatial.crop_histogram(points, EVERYTHING)))


def g05_morphology(spark, d):
    return _r(spatial.morphology(view(spark, d, "v_edges")))


def g16_grid_cells(spark, d):
    return spatial.grid_cells(spatial.footprints(view(spark, d, "v_edges")), 25.0)


def a06_coverage(spark, d):
    return _r(rasters.coverage(*_pe(spark, d), 1.0))


def a12_height_raster(spark, d):
    return _r(rasters.height_raster(*_pe(spark, d), 2.0).drop("cx", "cy"))


def r04_empty_regions(spark, d):
    return _r(rasters.empty_regions(*_pe(spark, d), 2.0))


def a13_height_metrics(spark, d):
    return _r(rasters.height_metrics(rasters.height_raster(*_pe(spark, d), 2.0), 2.0))


def a14_resolution_agreement(spark, d):
    p, e = _pe(spark, d)
    return _r(rasters.resolution_agreement(rasters.height_raster(p, e, 1.0), rasters.height_raster(p, e, 2.0), 1.0, 2.0))


def r07_normalized(spark, d):
    p, e = _pe(spark, d)
    own = spatial.footprints(e).select("building_id", "min_x", "min_y")
    terrain = view(spark, d, "v_terrain").join(own, "building_id").select("building_id", "trow", "tcol", "elevation", F.col("min_x").alias("tx"), F.col("min_y").alias("ty"))
    return _r(rasters.normalized(rasters.height_raster(p, e, 2.0), terrain, 2.0))


def _near(margin: float, edges: str = "v_edges") -> str:
    return f"""{prelude("v_points", *(("v_edges",) if edges != "v_edges" else ()), edges)},
pa as (select building_id, polygon_id, abs(sum(case when ring_id = 0 then x1*y2-x2*y1 end))/2 - coalesce(abs(sum(case when ring_id > 0 then x1*y2-x2*y1 end))/2, 0) as area from {edges} group by all),
bb as (select e.building_id, min(x1) as min_x, min(y1) as min_y, max(x1) as max_x, max(y1) as max_y, any_value(a.area) as area from {edges} e join (select building_id, sum(area) as area from pa group by building_id) a using (building_id) group by e.building_id),
pp as (select b.building_id, p.* from v_points p join bb b on x between min_x - {margin} and max_x + {margin} and y between min_y - {margin} and max_y + {margin}),
par as (select pp.building_id, {KEYS}, polygon_id, ring_id, sum(case when (y1>y)<>(y2>y) and x < (x2-x1)*(y-y1)/nullif(y2-y1,0)+x1 then 1 else 0 end)%2 as odd from pp join {edges} e on e.building_id = pp.building_id group by all),
ins as (select building_id, {KEYS}, bool_or(inside) as inside from (select building_id, {KEYS}, polygon_id, bool_and(case when ring_id = 0 then odd = 1 else odd = 0 end) as inside from par group by all) group by all),
pt as (select pp.*, ins.inside from pp join ins using (building_id, {KEYS}))"""


def _cells(res: float, name: str = "cells", edges: str = "v_edges") -> str:
    return f"""{name}_all as (select building_id, min_x as ox, min_y as oy, r.i as row, c.i as col, min_x + (c.i + 0.5) * {res} as cx, min_y + (r.i + 0.5) * {res} as cy
  from bb, lateral (select unnest(range(0, cast(greatest(ceil((max_x - min_x)/{res}), 1) as bigint))) as i) c, lateral (select unnest(range(0, cast(greatest(ceil((max_y - min_y)/{res}), 1) as bigint))) as i) r),
{name}_par as (select a.building_id, a.row, a.col, polygon_id, ring_id, sum(case when (y1>cy)<>(y2>cy) and cx < (x2-x1)*(cy-y1)/nullif(y2-y1,0)+x1 then 1 else 0 end)%2 as odd from {name}_all a join {edges} e on e.building_id = a.building_id group by all),
{name} as (select distinct building_id, row, col from (select building_id, row, col, polygon_id from {name}_par group by all having bool_and(case when ring_id = 0 then odd = 1 else odd = 0 end))),
{name}_pts as (select pt.building_id, cast(floor((y - min_y)/{res}) as bigint) as row, cast(floor((x - min_x)/{res}) as bigint) as col, z from pt join bb using (building_id) where inside and classification = 6),
{name}_h as (select c.building_id, c.row, c.col, quantile_cont(z, 0.9) as height, count(z) as points from {name} c left join {name}_pts p on p.building_id = c.building_id and p.row = c.row and p.col = c.col group by all)"""


ORACLES = {
    "a01_crop_summary": f"""{prelude("v_points")},
s as (select count(*) as point_count, min(z) as z_min, quantile_cont(z, 0.01) as z_p01, quantile_cont(z, 0.5) as z_p50, quantile_cont(z, 0.95) as z_p95, quantile_cont(z, 0.99) as z_p99, max(z) as z_max,
  count(*) filter (where classification = 2) as ground_count, count(*) filter (where classification in (3,4,5)) as vegetation_count, count(*) filter (where classification = 6) as building_count,
  count(*) filter (where classification = 12) as legacy_overlap_count, cast(sum(overlap_flag) as bigint) as overlap_count from v_points where x between 700000 and 700100 and y between 4370000 and 4370050)
select cast(5000 as double) as area_m2, point_count, round(point_count/5000.0::double, 6) as density_m2, round(z_min, 6) as z_min, round(z_p01, 6) as z_p01, round(z_p50, 6) as z_p50, round(z_p95, 6) as z_p95, round(z_p99, 6) as z_p99, round(z_max, 6) as z_max,
  ground_count, vegetation_count, building_count, legacy_overlap_count, overlap_count,
  array_to_string(list_filter([case when z_p01-z_min>20 or z_max-z_p99>20 then 'extreme_elevations' end, case when legacy_overlap_count>0 then 'legacy_overlap_points' end, case when building_count<100 then 'few_building_points' end,
    case when ground_count<100 then 'few_ground_points' end, case when point_count/5000.0::double<5 then 'low_density' end], lambda f: f is not null), ',') as flags from s where point_count > 0""",
    "a02_building_summary": f"""{_near(25)},
s as (select building_id, count(*) filter (where inside) as footprint_points, count(*) filter (where inside and classification <> 12) as usable_points, count(*) filter (where inside and classification = 6) as building_points,
  count(*) filter (where inside and classification in (3,4,5)) as vegetation_points, count(*) filter (where inside and classification = 12) as legacy_overlap_points, count(*) filter (where classification = 2) as context_ground_points,
  quantile_cont(z, 0.5) filter (where classification = 2) as ground_p50, quantile_cont(z, 0.5) filter (where inside and classification = 6) as roof_p50, quantile_cont(z, 0.95) filter (where inside and classification = 6) as roof_p95 from pt group by building_id)
select building_id, round(area, 6) as footprint_area_m2, footprint_points, usable_points, round(usable_points/area, 6) as usable_density_m2, building_points, vegetation_points, legacy_overlap_points, context_ground_points,
  round(ground_p50, 6) as ground_p50, round(roof_p50, 6) as roof_p50, round(roof_p95, 6) as roof_p95, round(roof_p50-ground_p50, 6) as height_p50, round(roof_p95-ground_p50, 6) as height_p95 from s join bb using (building_id) where context_ground_points > 0 and building_points > 0""",
    "a02_class_histogram": f"{_near(0)} select building_id, classification, count(*) as points from pt where inside group by all",
    "a10_alignment": f"""{prelude("v_points", "v_edges")},
bb as (select building_id, min(x1) as min_x, min(y1) as min_y, max(x1) as max_x, max(y1) as max_y from v_edges group by building_id),
pp as (select b.building_id, p.*, i.i/2.0::double as sx, j.i/2.0::double as sy from v_points p join bb b on x between min_x-2 and max_x+2 and y between min_y-2 and max_y+2, (select unnest(range(-4,5)) as i) i, (select unnest(range(-4,5)) as i) j where classification = 6),
par as (select pp.building_id, {KEYS}, sx, sy, ring_id, sum(case when (y1>y+sy)<>(y2>y+sy) and x+sx < (x2-x1)*(y+sy-y1)/nullif(y2-y1,0)+x1 then 1 else 0 end)%2 as odd from pp join v_edges e on e.building_id = pp.building_id group by all),
ins as (select building_id, {KEYS}, sx, sy, bool_and(case when ring_id = 0 then odd = 1 else odd = 0 end) as inside from par group by all),
sc as (select building_id, sx, sy, avg(case when inside then 1 else 0 end) as score from ins group by all),
rk as (select *, row_number() over (partition by building_id order by score desc, sx, sy) as k from sc)
select building_id, round(score, 6) as score, sx, sy, greatest(abs(sx), abs(sy)) = 2 as at_limit from rk where k = 1""",
    "g05_morphology": f"""{prelude("v_edges")},
s as (select building_id, abs(sum(case when ring_id = 0 then x1*y2-x2*y1 end))/2 - abs(sum(case when ring_id > 0 then x1*y2-x2*y1 end))/2 as a, sum(sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1))) as p, count(*) as vertices from v_edges group by building_id)
select building_id, round(a, 6) as area_m2, round(p, 6) as perimeter_m, vertices, round(least(greatest(4*pi()*a/(p*p), 0), 1), 6) as compactness from s""",
    "g16_grid_cells": f"""{prelude("v_edges")},
b as (select building_id, cast(floor((min(x1)-25)/1000) as bigint) as e1, cast(ceil((max(x1)+25)/1000) as bigint)-1 as e2, cast(floor((min(y1)-25)/1000) as bigint) as n1, cast(ceil((max(y1)+25)/1000) as bigint)-1 as n2 from v_edges group by building_id),
c as (select building_id, unnest(range(e1, e2+1)) as easting_km, n1, n2 from b), d as (select building_id, easting_km, unnest(range(n1, n2+1)) as northing_km from c)
select building_id, easting_km, northing_km, easting_km || '-' || (northing_km+1) || '-H30' as cell_id from d""",
    "a06_coverage": f"""{_near(0)}, {_cells(1.0)}
select building_id, count(*) as footprint_cells, count(*) filter (where points > 0) as occupied_cells, round(count(*) filter (where points > 0)/count(*)::double, 6) as coverage from cells_h group by building_id""",
    "a12_height_raster": f"{_near(0)}, {_cells(2.0)} select building_id, row, col, round(height, 6) as height, points from cells_h",
    "a13_height_metrics": f"""{_near(0)}, {_cells(2.0)},
v as (select * from cells_h where height is not null),
d as (select a.building_id, abs(a.height-b.height) as d from v a join v b on a.building_id = b.building_id and ((a.row = b.row and a.col = b.col+1) or (a.col = b.col and a.row = b.row+1)))
select building_id, count(*) as pairs, round(quantile_cont(d/2, 0.5), 6) as gradient_p50, round(quantile_cont(d/2, 0.95), 6) as gradient_p95, round(avg(case when d >= 1 then 1 else 0 end), 6) as discontinuity_ratio from d group by building_id""",
    "a14_resolution_agreement": f"""{_near(0)}, {_cells(1.0, "f")}, {_cells(2.0, "g")},
m as (select building_id, cast(floor((row+0.5)/2) as bigint) as row, cast(floor((col+0.5)/2) as bigint) as col, median(height) as fine from f_h where height is not null group by all),
j as (select g.building_id, abs(fine-g.height) as e, fine from g_h g left join m on m.building_id = g.building_id and m.row = g.row and m.col = g.col where g.height is not null)
select building_id, count(fine) as joint_cells, round(avg(e), 6) as mae, round(sqrt(avg(e*e)), 6) as rmse, round(quantile_cont(e, 0.95), 6) as p95, round(count(fine)/count(*)::double, 6) as overlap from j group by building_id""",
    "r07_normalized": f"""{_near(0)}, {_cells(2.0)}, {prelude("v_terrain")[5:]}
select c.building_id, c.row, c.col, round(height, 6) as height, round(elevation, 6) as elevation, round(height-elevation, 6) as above_ground from cells_h c left join v_terrain t on t.building_id = c.building_id and t.trow = c.row and t.tcol = c.col""",
    "r04_empty_regions": f"""{_near(0)}, {_cells(2.0)},
reach as (with recursive w as (select building_id, row, col, row as r0, col as c0 from cells_h where points = 0
  union select c.building_id, c.row, c.col, w.r0, w.c0 from w join cells_h c on c.building_id = w.building_id and c.points = 0 and abs(c.row-w.row)+abs(c.col-w.col) = 1) select * from w),
n as (select building_id, r0, c0, count(*) as n from reach group by all), t as (select building_id, count(*) as cells from cells_h group by building_id)
select t.building_id, coalesce(max(n), 0) as largest_empty_cells, round(coalesce(max(n), 0)/any_value(cells)::double, 6) as hole_ratio from t left join n on n.building_id = t.building_id group by t.building_id""",
}
for _name, _like in (("a03_multipolygon_summary", "a02_building_summary"), ("a04_multipolygon_histogram", "a02_class_histogram"), ("a06_multipolygon_coverage", "a06_coverage"), ("a12_multipolygon_raster", "a12_height_raster")):
    _margin, _res = 25 if _like == "a02_building_summary" else 0, {"a06_coverage": 1.0, "a12_height_raster": 2.0}.get(_like)
    _body = ORACLES[_like].removeprefix(_near(_margin))
    if _res:
        _body = _body.replace(_cells(_res), _cells(_res, edges="v_edges2"))
    ORACLES[_name] = _near(_margin, "v_edges2") + _body
ORACLES["a10_multipolygon_alignment"] = (
    ORACLES["a10_alignment"].replace(prelude("v_points", "v_edges"), prelude("v_points", "v_edges", "v_edges2")).replace("from v_edges group by building_id)", "from v_edges2 group by building_id)").replace("join v_edges e on", "join v_edges2 e on")
    .replace("sx, sy, ring_id, sum(", "sx, sy, polygon_id, ring_id, sum(").replace(f"ins as (select building_id, {KEYS}, sx, sy, bool_and(case when ring_id = 0 then odd = 1 else odd = 0 end) as inside from par group by all)",
        f"ins as (select building_id, {KEYS}, sx, sy, bool_or(inside) as inside from (select building_id, {KEYS}, sx, sy, polygon_id, bool_and(case when ring_id = 0 then odd = 1 else odd = 0 end) as inside from par group by all) group by all)")
)
_AREA = float((EVERYTHING[2] - EVERYTHING[0]) * (EVERYTHING[3] - EVERYTHING[1]))
_WHOLE = (
    ORACLES["a01_crop_summary"].replace("x between 700000 and 700100 and y between 4370000 and 4370050", "x between {} and {} and y between {} and {}".format(EVERYTHING[0], EVERYTHING[2], EVERYTHING[1], EVERYTHING[3])).replace("cast(5000 as double)", f"{_AREA}::double").replace("5000.0::double", f"{_AREA}::double")
    .replace("from s where point_count > 0", "")
)
ORACLES["a01_whole_cloud"] = _WHOLE.rsplit(" as flags", 1)[0] + """ as flags, (select '{' || string_agg('"' || classification || '":' || n, ',' order by classification) || '}' from (select classification, count(*) as n from v_points group by classification)) as class_histogram from s where point_count > 0"""
#: Half digits are nudged alike on both sides.
ORACLES = {k: s.replace(", 6) as", " + 1e-9::double, 6) as") for k, s in ORACLES.items()}
QUERIES = {k: globals()[k] for k in ORACLES}
