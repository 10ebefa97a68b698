"""Training tiles: object polygons met with image tiles, cut to them and written as label lines.

A ring is an array of (x, y), closed. Tiles (tile, x1, y1, x2, y2) and objects (object_id, label, part,
rings) meet in cells of a grid; each pair is kept in one cell only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _once(value: Column, body) -> Column:
    """body of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _side(ring: Column, inside, at) -> Column:
    """A ring cut by a half-plane: corners inside stay, and where a side crosses the border a corner is
    put there."""

    def cut(r):
        def step(p, i):
            q = F.element_at(r, (i + 1) % F.size(r) + 1)
            cross = F.when(inside(p) != inside(q), F.array(at(p, q))).otherwise(F.slice(r, 1, 0))
            return F.concat(F.when(inside(p), F.array(p)).otherwise(F.slice(r, 1, 0)), cross)

        return F.flatten(F.transform(r, step))

    return _once(ring, cut)


def clip_ring(rows: DataFrame, ring: str, box: tuple[str, str, str, str], name: str) -> DataFrame:
    """rows with the part of an open ring within a box, side by side (Sutherland and Hodgman)."""
    x1, y1, x2, y2 = map(F.col, box)
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    on_x = lambda v: lambda p, q: point(v, p["y"] + (q["y"] - p["y"]) * (v - p["x"]) / (q["x"] - p["x"]))
    on_y = lambda v: lambda p, q: point(p["x"] + (q["x"] - p["x"]) * (v - p["y"]) / (q["y"] - p["y"]), v)
    found = F.col(ring)
    for inside, at in ((lambda p: p["x"] >= x1, on_x(x1)), (lambda p: p["x"] <= x2, on_x(x2)), (lambda p: p["y"] >= y1, on_y(y1)), (lambda p: p["y"] <= y2, on_y(y2))):
        found = _side(found, inside, at)
    return rows.withColumn(name, _once(found, _with_area))


def _with_area(ring: Column) -> Column:
    """A ring, without corners where it has no area."""
    cross = F.transform(ring, lambda p, i: _once(F.element_at(ring, (i + 1) % F.size(ring) + 1), lambda q: p["x"] * q["y"] - q["x"] * p["y"]))
    whole = (F.size(ring) >= 3) & (F.abs(F.aggregate(cross, F.lit(0.0), lambda a, b: a + b)) > 0)
    return F.when(whole, ring).otherwise(F.slice(ring, 1, 0))


def met(tiles: DataFrame, objects: DataFrame, cell: float = 64.0) -> DataFrame:
    """Pairs of a tile and an object whose boxes touch. objects: object_id, label, part, rings."""
    ring = F.col("rings")[0]
    of = lambda f, c: f(F.transform(ring, lambda p: p[c]))
    own = objects.withColumn("ox1", of(F.array_min, "x")).withColumn("oy1", of(F.array_min, "y")).withColumn("ox2", of(F.array_max, "x")).withColumn("oy2", of(F.array_max, "y"))
    deal = lambda df, a, b, n: df.withColumn(n, F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell))))
    left, right = deal(deal(tiles, "x1", "x2", "cx"), "y1", "y2", "cy"), deal(deal(own, "ox1", "ox2", "cx"), "oy1", "oy2", "cy")
    once = (F.col("cx") == F.greatest(F.floor(F.col("x1") / cell), F.floor(F.col("ox1") / cell))) & (F.col("cy") == F.greatest(F.floor(F.col("y1") / cell), F.floor(F.col("oy1") / cell)))
    touch = F.expr("ox1 <= x2 and ox2 >= x1 and oy1 <= y2 and oy2 >= y1")
    return left.join(right, ["cx", "cy"]).where(once & touch).drop("cx", "cy", "ox1", "oy1", "ox2", "oy2")


def cut_objects(tiles: DataFrame, objects: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """(tile, object_id, part, label, canonical, ring): outer rings within each tile, open; without
    corners where nothing is left; canonical is NULL for labels that stand for no class."""
    dims = objects.sparkSession.createDataFrame(sorted(mapping.items()), "label string, canonical string")
    rows = met(tiles, objects).join(F.broadcast(dims), "label", "left")
    rows = rows.withColumn("open", F.slice(F.col("rings")[0], F.lit(1), F.greatest(F.size(F.col("rings")[0]) - 1, F.lit(0))))
    rows = clip_ring(rows, "open", ("x1", "y1", "x2", "y2"), "ring")
    return rows.select("tile", "object_id", "part", "label", "canonical", "ring", "x1", "y1", "x2", "y2")


def label_lines(cut: DataFrame, classes: dict[str, int]) -> DataFrame:
    """(tile, value): class number and corners as shares of the tile from its north-western corner, six
    digits, a line for each object that is left."""
    dims = cut.sparkSession.createDataFrame(sorted(classes.items()), "canonical string, class_id int")
    share = lambda p: F.format_string("%.6f %.6f", (p["x"] - F.col("x1")) / (F.col("x2") - F.col("x1")), (F.col("y2") - p["y"]) / (F.col("y2") - F.col("y1")))
    rows = cut.where("size(ring) >= 3 and x2 > x1 and y2 > y1").join(F.broadcast(dims), "canonical").withColumn("line", F.concat_ws(" ", F.col("class_id").cast("string"), F.array_join(F.transform("ring", share), " ")))
    own = rows.groupBy("tile").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("object_id", "part", "line"))), lambda x: x["line"]), "\n").alias("value"))
    return cut.select("tile").distinct().join(own, "tile", "left").select("tile", F.coalesce(F.concat("value", F.lit("\n")), F.lit("")).alias("value"))


def label_counts(cut: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(instances by class, with ignored labels by their own name; images by split)."""
    kept = cut.where("canonical is null or size(ring) >= 3")
    counts = kept.groupBy(F.coalesce("canonical", "label").alias("name"), F.col("canonical").isNull().alias("ignored")).agg(F.count("*").alias("instances"))
    return counts, images.groupBy("split").agg(F.count("*").alias("images"))


def read_labels(lines: DataFrame, width: int, height: int) -> DataFrame:
    """(tile, line, class_id, ring in pixels) of label texts (tile, value)."""
    rows = lines.select("tile", F.posexplode(F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")).alias("line", "text")).withColumn("f", F.split(F.trim("text"), r"\s+"))
    pair = lambda i: F.struct((F.element_at("f", i).cast("double") * width).alias("x"), (F.element_at("f", i + 1).cast("double") * height).alias("y"))
    ring = F.when(F.size("f") >= 3, F.transform(F.sequence(F.lit(2), F.size("f") - 1, F.lit(2)), pair))
    return rows.select("tile", "line", F.col("f")[0].cast("int").alias("class_id"), ring.alias("ring"))


def polygons(rows: DataFrame, geometry: str = "geometry") -> DataFrame:
    """A row for each polygon of a GeoJSON geometry (type, coordinates as text): part and rings.
    Anything but polygons and multipolygons has none."""
    rings = "array<array<array<double>>>"
    many = F.when(F.col(f"{geometry}.type") == "Polygon", F.array(F.from_json(f"{geometry}.coordinates", rings))).when(F.col(f"{geometry}.type") == "MultiPolygon", F.from_json(f"{geometry}.coordinates", f"array<{rings}>"))
    out = rows.select("*", F.posexplode(many).alias("part", "p"))
    return out.withColumn("rings", F.transform("p", lambda r: F.transform(r, lambda q: F.struct(q[0].alias("x"), q[1].alias("y"))))).drop("p", geometry)
