"""Valid polygons from any rings, and exact overlays of polygon sets: a group's rings are one arrangement, worked out in
the task that holds the row. Rings are arrays of (x, y)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RINGS = "array<array<struct<x: double, y: double>>>"
#: Tasks for each core that rows to arrange are dealt to.
TASKS = 4
TESTS = {
    "union": any, "intersection": all, "difference": lambda inside: inside[0] and not any(inside[1:]), "difference_both_ways": lambda inside: inside[0] != any(inside[1:]),
}


def _plain(rings) -> list:
    return [[(p["x"], p["y"]) for p in ring if p is not None and p["x"] is not None and p["y"] is not None] for ring in rings or [] if ring is not None]


def _points(polygon: list) -> list:
    return [[{"x": x, "y": y} for x, y in ring] for ring in polygon]


def _columns(batch, keys: list[str], at: list[int], columns: dict):
    """A batch with the keys of the rows at, and other columns (values, type)."""
    import pyarrow as pa

    own = [batch.column(k).take(pa.array(at, pa.int64())) for k in keys]
    return pa.RecordBatch.from_arrays([*own, *[pa.array(v, t) for v, t in columns.values()]], names=[*keys, *columns])


def _ring_type():
    import pyarrow as pa

    return pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt out by their number: arrangements take long for few bytes, by which Spark would give all to one task."""
    session = rows.sparkSession
    return rows.repartition(max(TASKS * session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions"))))


def parts_of(rows: DataFrame, keys: list[str], columns: list[str], how: str) -> DataFrame:
    """keys, part, rings, area and error for each polygon of the faces that pass; a row without a part where there is none."""
    kinds, test = ", ".join(f"`{c}` {t}" for c, t in rows.select(*keys).dtypes), TESTS[how]

    def read(layers):
        from math import isfinite

        from gablestone.functions import arrangement

        if not all(isfinite(v) for rings in layers for ring in rings for p in ring for v in p):
            return [(None, None, None, None, "a coordinate is not finite")]
        found, lines = arrangement.select(layers, test), arrangement.loose(layers[0])
        return [(k, _points(p), arrangement.area([p]), lines, None) for k, p in enumerate(found)] or [(None, None, None, lines, "no area")]

    def run(batches):
        import pyarrow as pa

        types = {"part": pa.int32(), "rings": _ring_type(), "area_m2": pa.float64(), "loose_edges": pa.int64(), "error": pa.string()}
        for b in batches:
            at, out = [], []
            for k, layers in enumerate(zip(*(b.column(c).to_pylist() for c in columns), strict=True)):
                found = read([_plain(r) for r in layers])
                out += found
                at += [k] * len(found)
            yield _columns(b, keys, at, {c: ([r[i] for r in out], t) for i, (c, t) in enumerate(types.items())})

    return spread(rows.select(*keys, *columns)).mapInArrow(run, f"{kinds}, part int, rings {RINGS}, area_m2 double, loose_edges long, error string")


def repaired(rows: DataFrame, keys: list[str], rings: str = "rings") -> DataFrame:
    """The polygons that a bag of rings stands for by the even-odd rule, whatever their order, direction, nesting, crossings
    or contacts: a row for each with its part number (the largest first), rings (the outer one first, counter-clockwise) and area.
    loose_edges counts pieces along which the rings run there and back; rows without any area have an error."""
    return parts_of(rows, keys, [rings], "union")


def overlay(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    """The union, intersection, difference (of a and b) or difference_both_ways of the polygons that two tables (keys, rings: a row for
    each polygon or set of rings) have under the same keys. Keys of one table only meet an empty set. The rings of
    a key are brought together, so that they are one object's or one building's, not a whole map's. Polygons of one side that overlap
    count once."""
    if how not in TESTS:
        raise ValueError(f"{how} is none of {', '.join(TESTS)}")
    whole = lambda df, name: merged(df, keys).groupBy(*keys).agg(F.flatten(F.collect_list("rings")).alias(name))
    return parts_of(whole(a, "of_a").join(whole(b, "of_b"), keys, "full"), keys, ["of_a", "of_b"], how).where("error is null")


def merged(polygons: DataFrame, keys: list[str]) -> DataFrame:
    """The union of all polygons of a key (rows of keys and rings); keys with one polygon keep it as it is."""
    own = polygons.select(*keys, "rings").groupBy(*keys).agg(F.collect_list("rings").alias("all"))
    single = own.where("size(all) = 1").select(*keys, F.col("all")[0].alias("rings"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in polygons.select(*keys).dtypes)

    def run(batches):
        from gablestone.functions import arrangement

        for b in batches:
            found = [(k, _points(p)) for k, layers in enumerate(b.column("all").to_pylist()) for p in arrangement.select([_plain(r) for r in layers], any)]
            yield _columns(b, keys, [k for k, _ in found], {"rings": ([p for _, p in found], _ring_type())})

    return single.unionByName(spread(own.where("size(all) > 1")).mapInArrow(run, f"{kinds}, rings {RINGS}"))


def as_rings(footprints: DataFrame) -> DataFrame:
    """Rings of points in place of rings of edges: building_id, polygon_id, rings."""
    return footprints.select("building_id", "polygon_id", F.transform("rings", lambda r: F.transform(r["edges"], lambda e: F.struct(e["x1"].alias("x"), e["y1"].alias("y")))).alias("rings"))


def clipped_outlines(outlines: DataFrame, objects: DataFrame, footprints: DataFrame) -> DataFrame:
    """(object_id, part, rings, area_m2): outlines (object_id, rings) cut exactly at the border of the building that
    objects (object_id, building_id) name for them. footprints: building_id, rings."""
    own = objects.select("object_id", "building_id")
    prints = own.join(footprints.select("building_id", "rings"), "building_id").select("object_id", "rings")
    met = outlines.select("object_id", "rings").join(prints.select("object_id").distinct(), "object_id", "left_semi")
    return overlay(met, prints, ["object_id"], "intersection").select("object_id", "part", "rings", "area_m2")
