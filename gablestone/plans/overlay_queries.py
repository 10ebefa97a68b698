"""Queries on rings that have to be made valid and on overlays, with SQL that knows their areas in closed form."""

from __future__ import annotations

from pyspark.sql import functions as F

from gablestone.operators import benchmarks, cadastre, decisions, overlay, shared, spatial
from gablestone.plans.spatial_queries import _r
from gablestone.sources import tiff
from gablestone.sources.adapters import prelude, view

# Width and height of a supplier's rings, and the corner that they start from.
_SIZES = "cast(s_suppkey as bigint) as building_id, cast(4 + s_suppkey % 7 as double) as w, cast(3 + s_suppkey % 5 as double) as h, cast(s_suppkey % 4 as int) as kind, cast(700000 + 32*(s_suppkey % 32) as double) as x0, cast(4370000 + 32*floor(s_suppkey/32) as double) as y0"


def _box(x: str, y: str, w: str, h: str) -> str:
    return f"array(struct(x0 + {x} as x, y0 + {y} as y), struct(x0 + {x} + {w} as x, y0 + {y} as y), struct(x0 + {x} + {w} as x, y0 + {y} + {h} as y), struct(x0 + {x} as x, y0 + {y} + {h} as y))"


def _rings(spark, d):
    """Bow-ties, disjoint rings, a ring in a ring and rings that overlap, a supplier each."""
    bow = "array(struct(x0 as x, y0 as y), struct(x0 + w as x, y0 + h as y), struct(x0 + w as x, y0 as y), struct(x0 as x, y0 + h as y))"
    whole = _box("0", "0", "w", "h")
    kinds = f"case kind when 0 then array({bow}) when 1 then array({_box('w + 2', '0', '1D', '1D')}, {whole}) when 2 then array({_box('1', '1', '1D', '1D')}, {whole}) else array({whole}, {_box('w - 2', 'h - 2', 'w', 'h')}) end as rings"
    return spark.read.parquet(f"{d}/supplier.parquet").selectExpr(*_SIZES.split(", ")).selectExpr("*", kinds)


def g12_valid_polygons(spark, d):
    found = overlay.repaired(_rings(spark, d), ["building_id"])
    return _r(found.groupBy("building_id").agg(F.count("part").alias("parts"), F.sum(F.size("rings")).alias("rings"), F.sum("area_m2").alias("area_m2"), F.max("area_m2").alias("largest_m2")))


def g15_overlay(spark, d):
    """Each footprint against a box that crosses its border, its notch and its hole."""
    prints = overlay.as_rings(spatial.footprints(view(spark, d, "v_edges")))
    boxes = spark.read.parquet(f"{d}/supplier.parquet").selectExpr(*_SIZES.split(", ")).selectExpr("building_id", f"array({_box('cast(building_id % 11 as double) + 0.5D', 'cast(building_id % 7 as double) + 0.25D', 'w + 6', 'h + 5')}) as rings")
    each = [overlay.overlay(prints, boxes, ["building_id"], how).groupBy("building_id").agg(F.lit(how).alias("how"), F.sum("area_m2").alias("area_m2")) for how in ("intersection", "union", "difference", "difference_both_ways")]
    out = each[0]
    for more in each[1:]:
        out = out.unionByName(more)
    return _r(out)


def k01_cadastral_documents(spark, d):
    """The three documents of each building: what kind of geometry the building's has, of how many polygons."""
    rows = _rings(spark, d).selectExpr("concat('ES/', building_id) as building_id", "'ref' as reference", "cast(building_id as string) as local_id", "'ES' as namespace", "rings")
    parts = rows.selectExpr("building_id", "0 as part", "local_id", "rings")
    found = cadastre.artefacts(rows, parts)
    kind = F.get_json_object("value", "$.geometry.type")
    lists = "array<array<array<array<double>>>>"
    n = F.when(kind == "MultiPolygon", F.size(F.from_json(F.get_json_object("value", "$.geometry.coordinates"), lists))).when(kind == "Polygon", 1)
    features = F.size(F.from_json(F.get_json_object("value", "$.features"), "array<struct<type: string>>"))
    return found.select("building_id", "folder", "file", kind.alias("kind"), n.cast("long").alias("polygons"), F.when(F.col("file") == "building_parts.geojson", features).cast("long").alias("features"))


def r16_terrain_sampling(spark, d):
    """All buildings' terrain as one raster file, sampled at the ground points of the cloud: a building's points, those with a value, and their mean height above it."""
    import uuid

    terrain = view(spark, d, "v_terrain")
    rows = 16 * (terrain.agg(F.max("building_id").alias("n")).first()["n"] // 32 + 1)
    cells = terrain.selectExpr("'terrain' as raster", f"{rows} - 1 - (16*cast(floor(building_id/32) as bigint) + trow) as row", "16*(building_id % 32) + tcol as col", "elevation as value")
    grid = spark.createDataFrame([("terrain", 700000.0, 4370000.0 + 2 * rows, 2.0, 512, rows)], "raster string, west double, north double, pixel double, width long, height long")
    path = f"{shared.folder(spark)}/rasters-{uuid.uuid4().hex}"
    tiff.write(cells, grid, path, "f8")
    points = view(spark, d, "v_points").where("classification = 2").select("src_building", "x", "y", "z")
    met = tiff.sampled(points, tiff.tiles(spark, path), 25830)
    return _r(met.groupBy(F.col("src_building").alias("building_id")).agg(F.count("*").alias("points"), F.count("value").alias("valued"), F.avg(F.col("z") - F.col("value")).alias("mean_above")))


def w04_comparison(spark, d):
    """Each building's entries, of even numbers one a backend, ranked or refused."""
    entries = decisions.with_quality_gate(view(spark, d, "v_entries")).where("building_id % 2 = 1 or input_ord % 3 = 0")
    rows = benchmarks.compared(view(spark, d, "v_selection"), entries)
    return rows.select("building_id", F.array_join("backends", ",").alias("backends"), F.array_join("accepted_ranking", ",").alias("accepted_ranking"), "error")


_S = f"with s as (select {_SIZES} from supplier)"


def _common(x: float, y: float, w: float, h: float) -> str:
    """The area that the box shares with a rectangle."""
    return f"greatest(least(qx + bw, {x + w}) - greatest(qx, {x}), 0) * greatest(least(qy + bh, {y + h}) - greatest(qy, {y}), 0)"


ORACLES = {
    "r16_terrain_sampling": f"""{prelude("v_points", "v_terrain")},
g as (select 16*cast(floor(building_id/32) as bigint) + trow as r, 16*(building_id % 32) + tcol as c, elevation from v_terrain)
select src_building as building_id, count(*) as points, count(elevation) as valued, round(avg(z - elevation), 6) as mean_above
from v_points left join g on r = cast(ceil((y - 4370000)/2) as bigint)- 1 and c = cast(floor((x - 700000)/2) as bigint) where classification = 2 group by src_building""",
    "w04_comparison": f"""{prelude("v_entries", "v_selection")},
e as (select *, geometry_valid and plausibility_pass and rmse_m <= 1.0 and p95_m <= 2.0 and within_050m >= 0.75 as accepted from v_entries where building_id % 2 = 1 or input_ord % 3 = 0),
o as (select building_id, string_agg(backend, ',' order by backend) as backends, coalesce(string_agg(backend, ',' order by rmse_m, p95_m, input_ord) filter (where accepted), '') as ranking, count(*) > count(distinct backend) as twice from e group by building_id)
select b.building_id, coalesce(backends, '') as backends, case when backends is not null and not twice then ranking end as accepted_ranking, case when backends is null then '{benchmarks.NO_ENTRIES}' when twice then '{benchmarks.DUPLICATES}' end as error
from (select distinct building_id from v_selection) b left join o using (building_id)""",
    "g12_valid_polygons": f"""{_S} select building_id, cast(case kind when 2 then 1 else 2 end as bigint) as parts, cast(2 as bigint) as rings,
  round(case kind when 0 then w*h/2 when 1 then w*h + 1 when 2 then w*h - 1 else 2*w*h - 8 end, 6) as area_m2, round(case kind when 0 then w*h/4 when 1 then w*h when 2 then w*h - 1 else w*h - 4 end, 6) as largest_m2 from s""",
    "g15_overlay": f"""{_S}, b as (select building_id, building_id % 11 + 0.5::double as qx, building_id % 7 + 0.25::double as qy, w + 6 as bw, h + 5 as bh from s),
c as (select building_id, bw * bh as own, {_common(0, 0, 24, 12)} + {_common(0, 12, 12, 6)} - {_common(3, 3, 3, 3)} as common, 24*12 + 12*6 - 9 as area from b)
select building_id, how, round(case how when 'intersection' then common when 'union' then own + area - common when 'difference' then area - common else own + area - 2 * common end, 6) as area_m2
from c cross join (values ('intersection'), ('union'), ('difference'), ('difference_both_ways')) as t(how)""",
    "k01_cadastral_documents": f"""{_S} select 'ES/' || building_id as building_id, 'ES_' || building_id as folder, file, case when file = 'building.geojson' then case kind when 2 then 'Polygon' else 'MultiPolygon' end end as kind,
  cast(case when file = 'building.geojson' then case kind when 2 then 1 else 2 end end as bigint) as polygons, cast(case when file = 'building_parts.geojson' then 1 end as bigint) as features
from s cross join (values ('identity.json'), ('building.geojson'), ('building_parts.geojson')) as t(file)""",
}
ORACLES = {k: s.replace(", 6) as", " + 1e-9::double, 6) as") for k, s in ORACLES.items()}
QUERIES = {k: globals()[k] for k in ORACLES}
