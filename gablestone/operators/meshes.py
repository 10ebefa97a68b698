"""Meshes as vertex and face rows: validity, areas, and fit to points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablestone.functions import geometry as G
from gablestone.operators.samples import sampled
from gablestone.operators.shared import cut

REQUIRED_SEMANTICS = ("GroundSurface", "RoofSurface", "WallSurface")


def face_edges(faces: DataFrame) -> DataFrame:
    """Directed edges (model_id, face_id, a, b) of each face, closed from its last vertex to its first."""
    order = Window.partitionBy("model_id", "face_id").orderBy("ordinal")
    rows = faces.withColumn("b", F.lead("vertex_idx").over(order)).withColumn("first", F.first("vertex_idx").over(order))
    return rows.select("model_id", "face_id", "semantic", F.col("vertex_idx").alias("a"), F.coalesce("b", "first").alias("b"))


def edge_report(faces: DataFrame) -> DataFrame:
    """How often each undirected edge is used: watertight where each is used twice."""
    uses = face_edges(faces).groupBy("model_id", F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).agg(F.count("*").alias("n"))
    return uses.groupBy("model_id").agg(F.count("*").alias("edges"), F.count_if(F.col("n") == 1).alias("boundary_edges"), F.count_if(F.col("n") > 2).alias("nonmanifold_edges"), F.bool_and(F.col("n") == 2).alias("watertight"))


def face_areas(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Area in space and in the plane of each face, by sums of cross products."""
    p = lambda k: vertices.select("model_id", F.col("vertex_idx").alias(k), *[F.col(c).alias(f"{k}{c}") for c in "xyz"])
    e = face_edges(faces).join(p("a"), ["model_id", "a"]).join(p("b"), ["model_id", "b"])
    cross = {"x": "ay*bz - az*by", "y": "az*bx - ax*bz", "z": "ax*by - ay*bx"}
    sums = e.groupBy("model_id", "face_id", "semantic").agg(*[F.sum(F.expr(v)).alias(f"n{k}") for k, v in cross.items()])
    return sums.select("model_id", "face_id", "semantic", (F.sqrt(F.expr("nx*nx + ny*ny + nz*nz")) / 2).alias("area"), (F.abs("nz") / 2).alias("area_xy"))


def semantic_histogram(faces: DataFrame) -> DataFrame:
    return faces.select("model_id", "face_id", "semantic").distinct().groupBy("model_id", "semantic").agg(F.count("*").alias("faces"))


#: Texts of structural failures and warnings.
NOT_FINITE, BAD_RINGS, NOT_WATERTIGHT = "vertices are empty or non-finite", "surface rings contain invalid vertex references", "solid boundary is not watertight"
NO_SEMANTICS, OFF_PRINT, OFF_HEIGHT = "required semantic surface types are missing", "model footprint bbox does not align with source footprint", "model height is outside configured plausibility bounds"
NO_GROUND, OFF_GROUND = "ground-surface area is unavailable", "ground area differs from source footprint"
BAD_FACES, OPEN_MESH, NO_LABELS = "faces contain invalid vertex references", "mesh boundary is not watertight", "OBJ has no semantic surface labels"

#: Least overlap of boxes, height bounds in metres, faces below this area in square metres are tiny.
MIN_IOU, HEIGHTS, TINY_AREA = 0.80, (1, 150), 0.25


def _listed(*pairs):
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(True)), t) for c, t in pairs]), lambda f: f.isNotNull())


def broken_faces(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """(model_id, face_id) of faces with fewer than three corners or a corner that is no vertex."""
    met = faces.join(vertices.select("model_id", "vertex_idx", F.lit(1).alias("known")), ["model_id", "vertex_idx"], "left")
    return met.groupBy("model_id", "face_id").agg(F.count("*").alias("n"), F.count("known").alias("k")).where("n < 3 or k < n").select("model_id", "face_id")


def _shape(vertices: DataFrame, prints: DataFrame) -> DataFrame:
    """Per model with vertices: whether they are finite, its height, and the overlap of its box with
    its footprint's."""
    finite = lambda c: F.coalesce(F.abs(F.col(c)) < float("inf"), F.lit(False)) & ~F.isnan(c)
    box = vertices.groupBy("model_id").agg(F.count("*").alias("vertices"), F.bool_and(finite("x") & finite("y") & finite("z")).alias("finite"), *[f(c).alias(f"{n}_{c}") for n, f in (("lo", F.min), ("hi", F.max)) for c in "xyz"])
    own = prints.groupBy(F.col("building_id").alias("model_id")).agg(F.sum("area").alias("footprint_area"), F.min("min_x").alias("fx1"), F.min("min_y").alias("fy1"), F.max("max_x").alias("fx2"), F.max("max_y").alias("fy2"))
    c = F.col
    rows = box.join(own, "model_id", "left").withColumn("height", F.when(c("finite"), c("hi_z") - c("lo_z")).otherwise(0.0))
    iou = G.bbox_iou([c("lo_x"), c("lo_y"), c("hi_x"), c("hi_y")], [c("fx1"), c("fy1"), c("fx2"), c("fy2")])
    return rows.withColumn("iou", F.when(c("finite"), iou).otherwise(0.0)).select("model_id", "vertices", "finite", "height", "iou", "footprint_area")


def _verdict(rows: DataFrame, structural, warnings) -> DataFrame:
    off = _listed((~(F.coalesce("iou", F.lit(0.0)) >= MIN_IOU), OFF_PRINT), (~F.col("height").between(*HEIGHTS), OFF_HEIGHT))
    rows = rows.withColumn("geometry_valid", F.size(structural) == 0).withColumn("plausibility_pass", F.size(off) == 0)
    return rows.withColumn("failures", F.array_join(F.concat(structural, off), "; ")).withColumn("warnings", F.array_join(warnings, "; ")).withColumn("accepted", F.col("geometry_valid") & F.col("plausibility_pass"))


def validate(vertices: DataFrame, faces: DataFrame, prints: DataFrame) -> DataFrame:
    """Validity and plausibility of each solid against its building's footprint (footprints()): rings
    with bad corners are counted and left out."""
    broken = broken_faces(vertices, faces)
    good = faces.join(broken, ["model_id", "face_id"], "left_anti")
    areas = face_areas(vertices, good).groupBy("model_id").agg(F.count("*").alias("faces"), F.avg((F.col("area") < TINY_AREA).cast("int")).alias("tiny"), F.sum(F.when(F.col("semantic") == "GroundSurface", F.col("area_xy"))).alias("ground_area"))
    kinds = faces.groupBy("model_id").agg(F.collect_set("semantic").alias("kinds"))
    bad = broken.groupBy("model_id").agg(F.count("*").alias("bad"))
    rows = kinds
    for more in (_shape(vertices, prints), edge_report(good), areas, bad):
        rows = rows.join(more, "model_id", "left")
    c = F.col
    rows = rows.withColumn("watertight", F.coalesce("watertight", F.lit(False))).withColumn("area_ratio", F.when(c("ground_area") > 0, c("ground_area") / F.nullif(c("footprint_area"), F.lit(0.0))))
    for name in ("vertices", "faces", "edges", "boundary_edges", "bad"):
        rows = rows.withColumn(name, F.coalesce(name, F.lit(0)))
    complete = F.size(F.array_except(F.array(*map(F.lit, REQUIRED_SEMANTICS)), "kinds")) == 0
    structural = _listed((~F.coalesce("finite", F.lit(False)), NOT_FINITE), (c("bad") > 0, BAD_RINGS), (~c("watertight"), NOT_WATERTIGHT), (~complete, NO_SEMANTICS))
    warnings = _listed((c("area_ratio").isNull(), NO_GROUND), (c("area_ratio").isNotNull() & ~F.coalesce(c("area_ratio").between(0.8, 1.2), F.lit(False)), OFF_GROUND))
    rows = _verdict(rows.withColumn("height", F.coalesce("height", F.lit(0.0))), structural, warnings)
    return rows.select(
        "model_id", "vertices", "faces", "edges", "boundary_edges", "watertight", c("bad").alias("invalid_rings"), F.coalesce("tiny", F.lit(1.0)).alias("tiny_fraction"), "height", "iou", "area_ratio", "geometry_valid", "plausibility_pass", "accepted", "failures", "warnings"
    )


def validate_obj(vertices: DataFrame, faces: DataFrame, prints: DataFrame) -> DataFrame:
    """The same for polygon meshes without semantics: vertices equal to six decimals are one, and an
    edge between two that are one is none."""
    at = lambda c: F.round(F.col(c), 6)
    welded = vertices.select("model_id", "vertex_idx", F.struct(at("x").alias("x"), at("y").alias("y"), at("z").alias("z")).alias("place"))
    first = welded.groupBy("model_id", "place").agg(F.min("vertex_idx").alias("own"))
    number = welded.join(first, ["model_id", "place"]).select("model_id", "vertex_idx", "own")
    doubles = first.groupBy("model_id").agg(F.count("*").alias("places"))
    broken = broken_faces(vertices, faces)
    good = faces.join(broken, ["model_id", "face_id"], "left_anti")
    edges = face_edges(good.join(number, ["model_id", "vertex_idx"]).select("model_id", "face_id", "ordinal", "semantic", F.col("own").alias("vertex_idx"))).where("a <> b")
    uses = edges.groupBy("model_id", F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).agg(F.count("*").alias("n"))
    used = uses.groupBy("model_id").agg(F.count_if(F.col("n") == 1).alias("boundary_edges"), F.count_if(F.col("n") > 2).alias("nonmanifold_edges"), F.bool_and(F.col("n") == 2).alias("watertight"))
    areas = face_areas(vertices, good).groupBy("model_id").agg(F.count("*").alias("faces"), F.avg((F.col("area") < TINY_AREA).cast("int")).alias("tiny"))
    rows = faces.select("model_id").distinct()
    for more in (_shape(vertices, prints), doubles, used, areas, broken.groupBy("model_id").agg(F.count("*").alias("bad"))):
        rows = rows.join(more, "model_id", "left")
    c = F.col
    for name in ("vertices", "faces", "boundary_edges", "nonmanifold_edges", "bad", "places"):
        rows = rows.withColumn(name, F.coalesce(name, F.lit(0)))
    rows = rows.withColumn("watertight", F.coalesce("watertight", F.lit(False))).withColumn("height", F.coalesce("height", F.lit(0.0))).withColumn("duplicates", c("vertices") - c("places"))
    structural = _listed((~F.coalesce("finite", F.lit(False)), NOT_FINITE), (c("bad") > 0, BAD_FACES), (~c("watertight"), OPEN_MESH))
    warnings = F.concat(F.array(F.lit(NO_LABELS)), F.filter(F.array(F.when(c("duplicates") > 0, F.concat(c("duplicates").cast("string"), F.lit(" duplicate vertices welded for topology checks")))), lambda x: x.isNotNull()))
    rows = _verdict(rows, structural, warnings)
    return rows.select(
        "model_id", "vertices", "faces", "duplicates", "boundary_edges", "nonmanifold_edges", "watertight", c("bad").alias("invalid_faces"), F.coalesce("tiny", F.lit(1.0)).alias("tiny_fraction"), "height", "iou", "geometry_valid", "plausibility_pass", "accepted", "failures", "warnings"
    )


def roof_triangles(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Fans of the faces that look up (first three vertices) and lie over a metre above the lowest
    vertex."""
    order = F.sort_array(F.collect_list(F.struct("ordinal", "x", "y", "z")))
    low = vertices.groupBy("model_id").agg(F.min("z").alias("z0"))
    rows = faces.join(vertices, ["model_id", "vertex_idx"]).groupBy("model_id", "face_id").agg(order.alias("p"), F.avg("z").alias("zm")).where(F.size("p") >= 3).join(low, "model_id")
    u = {c: f"(p[1].{c} - p[0].{c})" for c in "xyz"}
    v = {c: f"(p[2].{c} - p[0].{c})" for c in "xyz"}
    n = {"x": f"({u['y']}*{v['z']} - {u['z']}*{v['y']})", "y": f"({u['z']}*{v['x']} - {u['x']}*{v['z']})", "z": f"({u['x']}*{v['y']} - {u['y']}*{v['x']})"}
    up = F.expr(f"abs({n['z']}) >= 0.25D * sqrt({n['x']}*{n['x']} + {n['y']}*{n['y']} + {n['z']}*{n['z']}) and {n['x']}*{n['x']} + {n['y']}*{n['y']} + {n['z']}*{n['z']} > 0")
    rows = rows.where(up & (F.col("zm") > F.col("z0") + 1.0)).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("p") - 2)))
    return rows.select("model_id", "face_id", "k", *[F.col("p")[i][c].alias(f"{n_}{c}") for n_, i in (("a", F.lit(0)), ("g", F.col("k")), ("c", F.col("k") + 1)) for c in "xyz"])


def triangulated(vertices: DataFrame, faces: DataFrame, semantic: str = "RoofSurface") -> DataFrame:
    """Triangles of the surfaces of a kind, with their holes left open (faces with surface_id and
    ring_id), as roof_triangles() gives them; a surface that cannot be cut has one row that says why."""
    corners = faces.where(F.col("semantic") == semantic).join(vertices, ["model_id", "vertex_idx"])
    kind = dict(faces.dtypes)["model_id"]

    def cut(pdf):
        import pandas as pd

        from gablestone.functions.triangles import triangulate

        pdf = pdf.sort_values(["ring_id", "ordinal"]).reset_index(drop=True)
        xyz = pdf[["x", "y", "z"]].to_numpy(float)
        head = (pdf["model_id"].iloc[0], int(pdf["surface_id"].iloc[0]))
        # A vertex of two rings is one corner of the plane.
        number = {v: i for i, v in reversed(list(enumerate(pdf["vertex_idx"])))}
        rings = [[number[v] for v in r["vertex_idx"]] for _, r in pdf.groupby("ring_id")]
        try:
            rows = [(*head, k, *xyz[list(t)].reshape(-1), None) for k, t in enumerate(triangulate(rings, xyz))]
        except ValueError as e:
            rows = [(*head, None, *[None] * 9, str(e))]
        return pd.DataFrame(rows, columns=["model_id", "face_id", "k", *[f"{n}{c}" for n in "agc" for c in "xyz"], "error"]).astype({"k": "Int64"})

    schema = f"model_id {kind}, face_id long, k long, " + ", ".join(f"{n}{c} double" for n in "agc" for c in "xyz") + ", error string"
    return corners.select("model_id", "surface_id", "ring_id", "ordinal", "vertex_idx", "x", "y", "z").groupBy("model_id", "surface_id").applyInPandas(cut, schema)


def surface_areas(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Area of each surface with its holes taken off: rings that run the other way count against it."""
    keys = ["model_id", "face_id", "surface_id"]
    own = face_edges(faces).join(faces.select(*keys).distinct(), ["model_id", "face_id"])
    p = lambda k: vertices.select("model_id", F.col("vertex_idx").alias(k), *[F.col(c).alias(f"{k}{c}") for c in "xyz"])
    e = own.join(p("a"), ["model_id", "a"]).join(p("b"), ["model_id", "b"])
    cross = {"x": "ay*bz - az*by", "y": "az*bx - ax*bz", "z": "ax*by - ay*bx"}
    sums = e.groupBy("model_id", "surface_id", "semantic").agg(*[F.sum(F.expr(v)).alias(f"n{k}") for k, v in cross.items()])
    return sums.select("model_id", "surface_id", "semantic", (F.sqrt(F.expr("nx*nx + ny*ny + nz*nz")) / 2).alias("area"))


def _dot(p: str, q: str) -> str:
    return "(" + " + ".join(f"{p}{c}*{q}{c}" for c in "xyz") + ")"


#: Steps of the distance of a point p to a triangle agc, as SQL over columns px .. cz (by is a word of SQL): which of the
#: corners, edges or the face is nearest follows from six projections.
DISTANCE_STEPS = [
    {**{f"u{c}": f"g{c} - a{c}" for c in "xyz"}, **{f"v{c}": f"c{c} - a{c}" for c in "xyz"}, **{f"r{c}": f"p{c} - a{c}" for c in "xyz"}, **{f"s{c}": f"p{c} - g{c}" for c in "xyz"}, **{f"t{c}": f"p{c} - c{c}" for c in "xyz"}},
    {"d1": _dot("u", "r"), "d2": _dot("v", "r"), "d3": _dot("u", "s"), "d4": _dot("v", "s"), "d5": _dot("u", "t"), "d6": _dot("v", "t")},
    {"wc": "d1*d4 - d3*d2", "wb": "d5*d2 - d1*d6", "wa": "d3*d6 - d5*d4"},
    {
        "m": "case when d1 <= 0 and d2 <= 0 then 0 when d3 >= 0 and d4 <= d3 then 1 when wc <= 0 and d1 >= 0 and d3 <= 0 then d1/(d1-d3) when d6 >= 0 and d5 <= d6 then 0 when wb <= 0 and d2 >= 0 and d6 <= 0 then 0"
        " when wa <= 0 and d4 >= d3 and d5 >= d6 then 1 - (d4-d3)/((d4-d3)+(d5-d6)) else wb/nullif(wa+wb+wc, 0) end",
        "w": "case when d1 <= 0 and d2 <= 0 then 0 when d3 >= 0 and d4 <= d3 then 0 when wc <= 0 and d1 >= 0 and d3 <= 0 then 0 when d6 >= 0 and d5 <= d6 then 1 when wb <= 0 and d2 >= 0 and d6 <= 0 then d2/(d2-d6)"
        " when wa <= 0 and d4 >= d3 and d5 >= d6 then (d4-d3)/((d4-d3)+(d5-d6)) else wc/nullif(wa+wb+wc, 0) end",
    },
    {"distance": "sqrt(" + " + ".join(f"(r{c} - m*u{c} - w*v{c})*(r{c} - m*u{c} - w*v{c})" for c in "xyz") + ")"},
]


#: Triangles of a model up to which each of its points is compared with all of them.
FEW = 64
_AXES = [f"{n}{c}" for n in "agc" for c in "xyz"]
#: A triangle without area has no distance, and then the points of its model have none.
_THIN = "ux*vy - uy*vx = 0 and uy*vz - uz*vy = 0 and uz*vx - ux*vz = 0"


def residuals(points: DataFrame, triangles: DataFrame, keys: tuple, few: int = FEW, sample: int | None = None) -> DataFrame:
    """The distance of each point (model_id, keys, x, y, z), or of a sample of so many a model, to the nearest triangle of its
    model. Models of many triangles are searched by cells, in rings that grow until none beyond can be nearer."""
    points = points.select("model_id", *keys, *"xyz")
    points = sampled(points, ["model_id"], list(keys), sample) if sample else points
    points = points.select("model_id", *keys, *[F.col(c).alias(f"p{c}") for c in "xyz"])
    triangles = triangles.select("model_id", *_AXES)
    large = triangles.groupBy("model_id").agg(F.count("*").alias("n")).where(F.col("n") > few).select("model_id")
    if large.isEmpty():
        return _all_compared(points, triangles, keys)
    large = cut(large)
    pick = lambda df, how: df.join(large, "model_id", how)
    return _all_compared(pick(points, "left_anti"), pick(triangles, "left_anti"), keys).unionByName(_searched(pick(points, "left_semi"), pick(triangles, "left_semi"), keys))


def _distances(rows: DataFrame) -> DataFrame:
    for step in DISTANCE_STEPS:
        rows = rows.select("*", *[F.expr(v).alias(k) for k, v in step.items()])
    return rows.withColumn("distance", F.when(~F.expr(_THIN), F.col("distance")))


def _all_compared(points: DataFrame, triangles: DataFrame, keys: tuple) -> DataFrame:
    rows = _distances(points.join(triangles, "model_id"))
    return rows.groupBy("model_id", *keys).agg(F.when(F.count_if(F.col("distance").isNull()) == 0, F.min("distance")).alias("distance"))


def _searched(points: DataFrame, triangles: DataFrame, keys: tuple) -> DataFrame:
    """By cells of the plane. A triangle lies in at most four cells of its level, whose size is the first power of two of the
    model's own that its box fits into, so that large triangles are not dealt to many small cells. A point looks at all levels'
    cells within a radius; a triangle beyond it is farther than the radius. The next radius is the best distance found, which
    settles the point, or twice the last one where nothing was met."""
    low, high = (lambda c, f=f: F.expr(f"{f}(a{c}, g{c}, c{c})") for f in ("least", "greatest"))
    box = triangles.select("*", *[f(c).alias(f"{n}{c}") for f, n in ((low, "low"), (high, "high")) for c in "xy"])
    # Corners of a triangle without area, told by the first step of the distance.
    first = DISTANCE_STEPS[0]
    thin = F.expr(_THIN.replace("ux", f"({first['ux']})").replace("uy", f"({first['uy']})").replace("uz", f"({first['uz']})").replace("vx", f"({first['vx']})").replace("vy", f"({first['vy']})").replace("vz", f"({first['vz']})"))
    span = F.greatest(F.max("highx") - F.min("lowx"), F.max("highy") - F.min("lowy"))
    own = box.groupBy("model_id").agg(F.greatest(span / F.sqrt(F.count("*")), F.lit(1e-6)).alias("unit"), *[f(f"{n}{c}").alias(f"all_{n}{c}") for f, n in ((F.min, "low"), (F.max, "high")) for c in "xy"], F.max(thin).alias("thin"))
    box = box.join(own.select("model_id", "unit"), "model_id")
    wide = F.greatest(F.col("highx") - F.col("lowx"), F.col("highy") - F.col("lowy"))
    box = box.withColumn("level", F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(wide / F.col("unit"), F.lit(1e-9))))).cast("int")).withColumn("size", F.col("unit") * F.pow(F.lit(2.0), "level"))
    at = lambda c: F.floor(F.expr(c) / F.col("size"))
    cells = cut(box.withColumn("i", F.explode(F.sequence(at("lowx"), at("highx")))).withColumn("j", F.explode(F.sequence(at("lowy"), at("highy")))).drop("unit", "size"))
    levels = cells.groupBy("model_id").agg(F.collect_set("level").alias("levels"))
    todo = points.join(own.join(levels, "model_id"), "model_id")
    # Where nothing is near, the search begins at the border of the model's box.
    gap = lambda c: F.greatest(F.col(f"all_low{c}") - F.col(f"p{c}"), F.col(f"p{c}") - F.col(f"all_high{c}"), F.lit(0.0))
    todo = cut(todo.withColumn("radius", F.col("unit") + F.hypot(gap("x"), gap("y"))))
    settled = [todo.where("thin").select("model_id", *keys, F.lit(None).cast("double").alias("distance"))]
    todo = todo.where("not thin")
    while not todo.isEmpty():
        probe = todo.select("model_id", *keys, "px", "py", "pz", "radius", "unit", *[f"all_{n}{c}" for n in ("low", "high") for c in "xy"], F.explode("levels").alias("level")).withColumn("size", F.col("unit") * F.pow(F.lit(2.0), "level"))
        for c, k in (("x", "i"), ("y", "j")):
            begin, end = F.greatest(at(f"p{c} - radius"), at(f"all_low{c}")), F.least(at(f"p{c} + radius"), at(f"all_high{c}"))
            probe = probe.withColumn(k, F.explode(F.when(begin <= end, F.sequence(begin, end)).otherwise(F.array().cast("array<bigint>"))))
        near = probe.select("model_id", *keys, "px", "py", "pz", "radius", "level", "i", "j").join(cells, ["model_id", "level", "i", "j"])
        near = near.where("lowx <= px + radius and highx >= px - radius and lowy <= py + radius and highy >= py - radius")
        best = _distances(near.select("model_id", *keys, "px", "py", "pz", *_AXES)).groupBy("model_id", *keys).agg(F.min("distance").alias("distance"))
        same = [F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}")) for k in ("model_id", *keys)]
        tried = cut(todo.alias("t").join(best.alias("b"), same, "left").select("t.*", "b.distance"))
        settled.append(tried.where("distance <= radius").select("model_id", *keys, "distance"))
        todo = tried.where("distance is null or distance > radius").withColumn("radius", F.coalesce("distance", 2 * F.col("radius"))).drop("distance")
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def fit_report(found: DataFrame) -> DataFrame:
    """Distances of a model's points; where a triangle is degenerate the status says so and the rest is
    NULL."""
    d = F.col("distance")
    ok = F.count(d) == F.count("*")
    of = lambda value: F.when(ok, value)
    within = lambda t: of(F.avg((d <= t + 1e-9).cast("int")))
    return found.groupBy("model_id").agg(
        F.count("*").alias("points"), of(F.percentile(d, F.lit(0.5))).alias("median_m"), of(F.sqrt(F.avg(d * d))).alias("rmse_m"), of(F.percentile(d, F.lit(0.95))).alias("p95_m"), within(0.2).alias("within_020m"), within(0.5).alias("within_050m"),
        within(1.0).alias("within_100m"), F.when(ok, "ok").otherwise("degenerate triangle").alias("status"),
    )


def largest_residuals(found: DataFrame, keys: tuple, k: int = 10) -> DataFrame:
    return found.orderBy(F.desc("distance"), "model_id", *keys).limit(k)
