"""The driver tables seen as point clouds, footprints, terrain, meshes and registries.

Each view is one SQL text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_points": ("lineitem", """
select cast(l_suppkey as bigint) as src_building, cast(l_orderkey as bigint) as k1, cast(l_linenumber as bigint) as k2, cast(l_partkey as bigint) as k3,
  cast(l_extendedprice as double) as k4,
  700000 + 32*(l_suppkey % 32) + cast((l_partkey*7 + l_orderkey*3) % 112 as double)/4 - 2 as x,
  4370000 + 32*floor(l_suppkey/32) + cast((l_partkey*5 + l_orderkey) % 88 as double)/4 - 2 as y,
  case when l_linenumber = 4 then 100 + (l_quantity % 4)/8 else 106 + (l_quantity % 8)/4 + cast((l_partkey + l_orderkey) % 5 as double)/8 end as z,
  cast(case l_linenumber when 4 then 2 when 5 then 5 when 6 then 12 else 6 end as bigint) as classification,
  cast(case when l_orderkey % 17 = 0 then 1 else 0 end as bigint) as overlap_flag
from lineitem"""),
    "v_edges": ("supplier", """
select cast(s_suppkey as bigint) as building_id, cast(0 as bigint) as polygon_id, cast(e.ring as bigint) as ring_id, cast(e.ord as bigint) as edge_id,
  cast(700000 + 32*(s_suppkey % 32) + e.x1 as double) as x1, cast(4370000 + 32*floor(s_suppkey/32) + e.y1 as double) as y1,
  cast(700000 + 32*(s_suppkey % 32) + e.x2 as double) as x2, cast(4370000 + 32*floor(s_suppkey/32) + e.y2 as double) as y2
from supplier cross join (values (0,0,0,0,24,0),(0,1,24,0,24,12),(0,2,24,12,12,12),(0,3,12,12,12,18),(0,4,12,18,0,18),(0,5,0,18,0,0),
  (1,0,3,3,6,3),(1,1,6,3,6,6),(1,2,6,6,3,6),(1,3,3,6,3,3)) as e(ring,ord,x1,y1,x2,y2)"""),
    "v_edges2": ("v_edges", """
select building_id, polygon_id, ring_id, edge_id, x1, y1, x2, y2 from v_edges union all
select building_id, cast(1 as bigint) as polygon_id, cast(0 as bigint) as ring_id, cast(q.ord as bigint) as edge_id, bx + q.x1 + case when building_id % 3 = 1 then 12 else 8 end as x1, y0 + q.y1 as y1,
  bx + q.x2 + case when building_id % 3 = 1 then 12 else 8 end as x2, y0 + q.y2 as y2
from (select building_id, x1 as bx, y1 as y0 from v_edges where ring_id = 0 and edge_id = 0 and building_id % 3 <> 0) as o
cross join (values (0,0.0,12.0,10.0,12.0),(1,10.0,12.0,10.0,20.0),(2,10.0,20.0,0.0,20.0),(3,0.0,20.0,0.0,12.0)) as q(ord,x1,y1,x2,y2)"""),
    "v_terrain": ("supplier", """
select cast(s_suppkey as bigint) as building_id, cast(r.i as bigint) as trow, cast(c.i as bigint) as tcol,
  cast(case when (s_suppkey + r.i*5 + c.i*3) % 29 = 0 then null else 99 + cast((s_suppkey + r.i + c.i) % 8 as double)/8 end as double) as elevation
from supplier cross join (values (0),(1),(2),(3),(4),(5),(6),(7),(8)) as r(i) cross join (values (0),(1),(2),(3),(4),(5),(6),(7),(8),(9),(10),(11)) as c(i)"""),
    "v_mesh_v": ("v_edges", """
select building_id as model_id, edge_id + 6*t.top as vertex_idx, x1 as x, y1 as y, cast(case when t.top = 1 then 108 else 100 end as double) as z
from v_edges cross join (values (0),(1)) as t(top) where ring_id = 0"""),
    "v_mesh_f": ("supplier", """
select cast(s_suppkey as bigint) as model_id, cast(f.face as bigint) as face_id, cast(f.ord as bigint) as ordinal, cast(f.v as bigint) as vertex_idx,
  case when f.face = 0 then 'GroundSurface' when f.face = 1 then 'RoofSurface' else 'WallSurface' end as semantic
from supplier cross join (values (0,0,0),(0,1,5),(0,2,4),(0,3,3),(0,4,2),(0,5,1),(1,0,6),(1,1,7),(1,2,8),(1,3,9),(1,4,10),(1,5,11),
 (2,0,0),(2,1,1),(2,2,7),(2,3,6),(3,0,1),(3,1,2),(3,2,8),(3,3,7),(4,0,2),(4,1,3),(4,2,9),(4,3,8),(5,0,3),(5,1,4),(5,2,10),(5,3,9),
 (6,0,4),(6,1,5),(6,2,11),(6,3,10),(7,0,5),(7,1,0),(7,2,6),(7,3,11)) as f(face,ord,v)
where not (s_suppkey % 7 = 0 and f.face = 7)"""),
    "v_entries": ("orders", """
select cast(o_custkey as bigint) as building_id, cast(o_orderkey as bigint) as input_ord, case when o_orderkey % 2 = 0 then 'roofer' else 'city3d' end as backend,
  cast((o_orderkey*37 + o_custkey*11) % 160 as double)/64 as rmse_m, cast((o_orderkey*37 + o_custkey*11) % 160 + o_orderkey % 96 as double)/64 as p95_m,
  1 - cast((o_orderkey*37 + o_custkey*11) % 160 as double)/512 as within_050m, (o_orderkey % 5 <> 0) as geometry_valid, (o_orderkey % 7 <> 0) as plausibility_pass
from orders"""),
    "v_evidence": ("orders", """
select cast(o_orderkey as bigint) as building_id, case when o_orderkey % 13 = 0 then null else cast((o_orderkey*7) % 48 as double)/8 end as density, cast((o_orderkey*5 + o_custkey) % 64 as double)/64 as valid_ratio,
  case when o_orderkey % 11 = 0 then null else cast((o_orderkey*3 + o_custkey*2) % 64 as double)/64 end as planar, cast((o_orderkey + o_custkey) % 32 as double)/64 as gradient_p50, cast((o_orderkey*9 + o_custkey) % 96 as double)/64 as gradient_p95,
  cast((o_orderkey*11 + o_custkey*3) % 32 as double)/128 as discontinuity, case when o_orderkey % 17 = 0 then null else cast((o_orderkey*13 + o_custkey) % 64 as double)/64 end as coverage,
  case when o_orderkey % 19 = 0 then null else cast((o_orderkey*3 + o_custkey*5) % 32 as double)/64 end as hole_ratio, cast((o_orderkey*7 + o_custkey*3) % 64 as double)/64 as alignment, cast((o_orderkey*5 + o_custkey*7) % 64 as double)/64 as explained,
  cast(o_orderkey % 9 as bigint) as planes, cast(o_orderkey % 5 as bigint) as normals, case when o_orderkey % 6 = 0 then null else cast(o_custkey % 5 as bigint) end as parts, cast(o_orderkey % 4 as bigint) * 50 as roof_points,
  cast(4 + o_orderkey % 20 as bigint) as vertices, cast(1 + (o_orderkey*3) % 64 as double)/64 as compactness, o_orderkey % 23 <> 0 as footprint_ok, o_orderkey % 29 <> 0 as ground_ok, o_orderkey % 31 <> 0 as height_ok, o_orderkey % 37 <> 0 as available,
  case cast(o_custkey % 4 as int) when 0 then 'auto' when 1 then '1.2' when 2 then '1.3' else '2.2' end as lod_request, case cast(o_orderkey % 3 as int) when 0 then 'strict' when 1 then 'fallback' else 'force_experimental' end as policy,
  case cast(o_custkey % 3 as int) when 0 then 'auto' when 1 then 'roofer' else 'city3d' end as backend_request from orders"""),
    "v_selection": ("customer", """
select cast(c_custkey as bigint) as building_id, c_mktsegment as profile, case when c_custkey % 3 = 0 then 'user_reported' else null end as photovoltaic_panels from customer"""),
    "v_detections": ("events", """
select cast(event_id as bigint) as object_id, cast(user_id as bigint) as building_id,
  case event_type when 'purchase' then 'pv_panel' when 'error' then 'hvac_unit' when 'click' then 'chimney' when 'view' then 'elevator_overrun' else 'skylight' end as class_name,
  least(value/500, cast(1 as double)) as confidence, cast(event_id % 64 as bigint) as pixel_area from events"""),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapter view over the tables in sf_dir."""
    source, sql = VIEWS[name]
    own = view(spark, sf_dir, source) if source in VIEWS else spark.read.parquet(f"{sf_dir}/{source}.parquet")
    return spark.sql(sql.replace(f"from {source}", "from {source}"), source=own)


def prelude(*names: str) -> str:
    """The views as a WITH clause for the checking engine, those that they need first."""
    wanted: list[str] = []
    for n in names:
        wanted += [x for x in ((VIEWS[n][0], n) if VIEWS[n][0] in VIEWS else (n,)) if x not in wanted]
    return "with " + ",\n".join(f"{n} as ({VIEWS[n][1]})" for n in wanted)
