"""Registry, catalogue and archive records from landed files: a broken record is a row that says why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gablestone.functions import text as T


def _local(name: str) -> str:
    return f"*[local-name()='{name}']"


def _one(xml: str, *path: str) -> Column:
    """Text at a path of local names, trimmed; NULL where it is blank or missing."""
    return F.nullif(F.trim(F.get(F.xpath(xml, F.lit("//" + "/".join(map(_local, path)) + "/text()")), F.lit(0))), F.lit(""))


def _first(*checks) -> Column:
    """The first complaint that holds."""
    out = None
    for when, text in checks:
        out = F.when(when, text) if out is None else out.when(when, text)
    return out


def _readable(rows: DataFrame, xml: str) -> tuple[DataFrame, str]:
    """rows with documents that are no XML (or null) replaced by an empty one, and the name of a column that says what
    is wrong with them: XPath functions would end the job at the first of them."""

    def check(documents):
        from xml.etree import ElementTree

        out = []
        for x in documents:
            try:
                ElementTree.fromstring(x if x is not None else "")
                out.append(None)
            except ElementTree.ParseError as e:
                out.append(f"no XML: {e}")
        return documents.__class__(out, dtype=object)

    broken = "broken"
    while broken in rows.columns:
        broken += "_"
    rows = rows.withColumn(broken, F.pandas_udf(check, "string")(xml))
    return rows.withColumn(xml, F.when(F.col(broken).isNull(), F.col(xml)).otherwise("<none/>")), broken


def coordinates(rows: DataFrame, xml: str = "xml") -> DataFrame:
    """Answers of a coordinate service: reference and address, or what it complains of."""
    others, (rows, broken) = [c for c in rows.columns if c != xml], _readable(rows, xml)
    count = _one(xml, "cuerr").try_cast("int")
    said = F.array_join(F.filter(F.transform(F.xpath(xml, F.lit("//*[substring(local-name(), string-length(local-name()) - 2) = 'des']/text()")), lambda x: F.trim(x)), lambda x: x != ""), "; ")
    first, second = _one(xml, "pc1"), _one(xml, "pc2")
    error = _first(
        (F.col(broken).isNotNull(), F.col(broken)), (count.isNull(), F.lit("no error count")), (count > 0, F.concat(F.lit("resolution failed: "), F.coalesce(F.nullif(said, F.lit("")), F.lit("unspecified error")))), (first.isNull() | second.isNull(), F.lit("no reference")),
    )
    return rows.select(*others, F.when(error.isNull(), F.concat(first, second)).alias("reference"), F.when(error.isNull(), _one(xml, "ldt")).alias("address"), error.alias("error"))


def parts(rows: DataFrame, key: str, xml: str = "xml") -> DataFrame:
    """A row for each building part of a registry answer, in order: identity, floors, depth and rings
    as texts, and what is wrong with it: a document that is no XML is one row without a part, a number that is none is
    left out and named. Parts nest, so that a document is read as a whole, by a small parser in the task."""
    def run(batches):
        from xml.etree import ElementTree

        import pandas as pd

        numbers = (("numberOfFloorsAboveGround", int), ("numberOfFloorsBelowGround", int), ("heightBelowGround", float))
        tail = lambda e: e.tag.rpartition("}")[2]

        def read(p):
            texts: dict[str, str] = {}
            for e in p.iter():
                if e.text and e.text.strip():
                    texts.setdefault(tail(e), e.text.strip())
            values, wrong = [], []
            for name, kind in numbers:
                try:
                    values.append(kind(texts[name]) if name in texts else None)
                except ValueError:
                    values.append(None)
                    wrong.append(f"{name} is no number")
            return texts.get("localId"), *values, [e.text or "" for e in p.iter() if tail(e) == "posList"], "; ".join(wrong) or None

        for pdf in batches:
            out = []
            for k, content in pdf[[key, xml]].itertuples(index=False):
                try:
                    tree = ElementTree.fromstring(content or "")
                except ElementTree.ParseError as e:
                    out.append((k, None, None, None, None, None, None, f"no XML: {e}"))
                    continue
                out += [(k, i, *read(p)) for i, p in enumerate(e for e in tree.iter() if tail(e) == "BuildingPart")]
            yield pd.DataFrame(out, columns=["key", "part", "local_id", "floors_above", "floors_below", "depth_m", "rings", "error"]).astype({"part": "Int32", "floors_above": "Int64", "floors_below": "Int64"})

    kind = dict(rows.dtypes)[key]
    found = rows.select(key, xml).mapInPandas(run, f"key {kind}, part int, local_id string, floors_above long, floors_below long, depth_m double, rings array<string>, error string")
    return found.withColumnRenamed("key", key)


def buildings(rows: DataFrame, xml: str = "xml") -> DataFrame:
    """The building of each registry answer: identity, condition, use, years, units, dwellings, floors,
    area, facade document and the rings of its first surface; or why there is none. Dates without
    their partner, three-dimensional rings and unknown coordinate systems are complaints."""
    others, (rows, broken) = [c for c in rows.columns if c != xml], _readable(rows, xml)
    n = F.xpath_int(xml, F.lit(f"count(//{_local('Building')})"))
    surface = f"(//{_local('Building')}//{_local('Surface')})[1]"
    raw = F.xpath_string(xml, F.lit(f"{surface}/@srsName"))
    flat = F.xpath(xml, F.lit(f"{surface}//{_local('LinearRing')}/{_local('posList')}/text()"))
    deep = F.xpath_int(xml, F.lit(f"count({surface}//{_local('LinearRing')}/{_local('posList')}[@srsDimension and @srsDimension != '2'])"))
    beginning, end = _one(xml, "dateOfConstruction", "DateOfEvent", "beginning"), _one(xml, "dateOfConstruction", "DateOfEvent", "end")
    local, space, reference = _one(xml, "localId"), _one(xml, "namespace"), _one(xml, "externalReference", "ExternalReference", "reference")
    rings = F.transform(flat, lambda r: T.positions(r))
    counted = {"units": _one(xml, "numberOfBuildingUnits"), "dwellings": _one(xml, "numberOfDwellings"), "floors_above": _one(xml, "numberOfFloorsAboveGround")}
    area = _one(xml, "officialArea", "OfficialArea", "value")
    dates = {"beginning": F.substring(beginning, 1, 10), "end": F.substring(end, 1, 10)}
    unread = [(c.isNotNull() & c.try_cast(kind).isNull(), F.lit(f"{name} cannot be read")) for kind, of in (("int", counted), ("double", {"official_area_m2": area}), ("date", dates)) for name, c in of.items()]
    error = _first(
        (F.col(broken).isNotNull(), F.col(broken)), (n != 1, F.concat(F.lit("buildings: "), n.cast("string"))), (local.isNull() | space.isNull() | reference.isNull(), F.lit("no identity")), (F.size(flat) == 0, F.lit("no rings")), (T.crs(raw).isNull(), F.lit("unknown coordinate system")),
        (deep > 0, F.lit("rings are not flat")), (F.exists(rings, lambda r: r.isNull()), F.lit("a ring has an odd count of numbers")), (beginning.isNull() != end.isNull(), F.lit("construction period is incomplete")),
        *unread,
    )
    ok = lambda c: F.when(error.isNull(), c)
    whole = {
        "building_id": F.concat_ws(".", space, local), "reference": reference, "local_id": local, "namespace": space, "condition": _one(xml, "conditionOfConstruction"), "current_use": _one(xml, "currentUse"),
        **{k: c.try_cast("date") for k, c in dates.items()}, **{k: c.try_cast("int") for k, c in counted.items()}, "official_area_m2": area.try_cast("double"), "document_url": _one(xml, "document", "Document", "documentLink"),
        "document_format": _one(xml, "document", "Document", "format"), "crs": T.crs(raw), "rings": rings,
    }
    return rows.select(*others, *[ok(v).alias(k) for k, v in whole.items()], error.alias("error"))


#: How catalogue pages write tiles, numbers, densities and sizes.
TILE_NAME = r"PNOA[-_]\d{4}[-_][A-Z]+[-_]\d+-\d+[-_]H\d+[-_]NPC\d+\.laz"
PAGE = {
    "row": r"(?is)<tr\b[^>]*>(.*?)</tr>", "detail": r"(?i)detalleArchivo\?sec=(\d+)", "number": r"(?i)secuencial\s*=\s*['\"](\d+)['\"]", "density": r"(?i)([\d.,]+)\s*ptos/m2", "size": r"(?i)Tama[^:]*:\s*([\d.,]+)\s*\(Mb\)",
    "tile": r"(?i)(PNOA_(\d{4})_[A-Z]+_(\d+)-(\d+)_H(\d+)_(NPC\d+)\.LAZ)",
}


def listing(rows: DataFrame, key: str, html: str = "html") -> DataFrame:
    """The one tile that a catalogue listing names: file and detail number from the table rows that have
    both; none or several different ones are a complaint."""
    lines = rows.select(key, F.explode_outer(F.regexp_extract_all(html, F.lit(PAGE["row"]), 1)).alias("line"))
    file, number = F.regexp_extract("line", f"(?i)({TILE_NAME})", 1), F.regexp_extract("line", PAGE["detail"], 1)
    pairs = lines.groupBy(key).agg(F.collect_set(F.when((file != "") & (number != ""), F.struct(file.alias("file"), number.alias("number")))).alias("found"))
    one = F.size("found") == 1
    return pairs.select(key, F.when(one, F.col("found")[0]["file"]).alias("file"), F.when(one, F.col("found")[0]["number"]).alias("number"), F.when(~one, F.concat(F.lit("assets found: "), F.size("found").cast("string"))).alias("error"))


#: The entities that catalogue pages use.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&aacute;": "á", "&eacute;": "é", "&iacute;": "í", "&oacute;": "ó", "&uacute;": "ú", "&ntilde;": "ñ", "&amp;": "&"}


def plain(html: Column) -> Column:
    """Text without tags and entities, white space collapsed."""
    out = F.regexp_replace(html, r"<[^>]+>", " ")
    for entity, c in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(c))
    return F.regexp_replace(out, r"[\s\x{A0}]+", " ")


def asset_page(rows: DataFrame, html: str = "html") -> DataFrame:
    """Number, file, year, density, size, grid cell and level of a tile from its detail page; decimals
    with a comma count as points; what is missing is a complaint."""
    own, words = F.col(html), plain(F.col(html))
    name = PAGE["tile"]
    take = lambda text, pattern, k: F.nullif(F.regexp_extract(text, pattern, k), F.lit(""))
    number, file = take(own, PAGE["number"], 1), take(words, name, 1)
    density, size = take(words, PAGE["density"], 1), take(words, PAGE["size"], 1)
    real = lambda c: F.try_to_number(F.replace(c, F.lit(","), F.lit(".")), F.lit("999999999.999999")).cast("double")
    error = _first((number.isNull(), F.lit("no number")), (file.isNull(), F.lit("no file name")), (density.isNull(), F.lit("no density")), (size.isNull(), F.lit("no size")))
    cell = F.concat(take(words, name, 3), F.lit("-"), take(words, name, 4), F.lit("-H"), take(words, name, 5))
    found = {"number": number, "file": file, "flight_year": take(words, name, 2).cast("int"), "density_m2": real(density), "size_mb": real(size), "grid_cell": cell, "level": F.upper(take(words, name, 6))}
    return rows.select(*[c for c in rows.columns if c != html], *[F.when(error.isNull(), v).alias(k) for k, v in found.items()], error.alias("error"))


def building_features(spark: SparkSession, path: str) -> DataFrame:
    """(building_id, polygon_id, ring_id, ordinal, lon, lat, error) of GeoJSON features, one file each."""
    schema = "type string, id string, geometry struct<type: string, coordinates: string>"
    rows = spark.read.schema(schema).json(path, multiLine=True)
    rings = "array<array<array<double>>>"
    kind, raw = F.col("geometry.type"), F.col("geometry.coordinates")
    many = F.when(kind == "Polygon", F.array(F.from_json(raw, rings))).when(kind == "MultiPolygon", F.from_json(raw, f"array<{rings}>"))
    error = _first((~F.coalesce(kind.isin("Polygon", "MultiPolygon"), F.lit(False)), F.lit("not a polygon")), (many.isNull() | F.exists(many, lambda p: F.size(p) < 1), F.lit("no coordinates")))
    out = rows.select(F.col("id").alias("building_id"), error.alias("error"), F.posexplode_outer(F.when(error.isNull(), many)).alias("polygon_id", "p"))
    out = out.select("building_id", "error", "polygon_id", F.posexplode_outer("p").alias("ring_id", "r"))
    return out.select("building_id", "polygon_id", "ring_id", F.posexplode_outer("r").alias("ordinal", "q"), "error").select("building_id", "polygon_id", "ring_id", "ordinal", F.col("q")[0].alias("lon"), F.col("q")[1].alias("lat"), "error")


def in_range(lon: Column, lat: Column) -> Column:
    """Whether a position is one on earth; both limits count."""
    return F.coalesce(lon.between(-180, 180) & lat.between(-90, 90), F.lit(False))


def finite(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.coalesce(F.abs(F.col(c).cast("double")) < float("inf"), F.lit(False)) & ~F.coalesce(F.isnan(F.col(c).cast("double")), F.lit(True))
    return out


def query_error(reference: Column, lon: Column, lat: Column) -> Column:
    """A query has either a reference or both coordinates."""
    place = lon.isNotNull() & lat.isNotNull()
    return F.when(reference.isNotNull() & (lon.isNotNull() | lat.isNotNull()), "a reference and coordinates exclude each other").when(reference.isNull() & ~place, "a reference or both coordinates are needed").when(
        reference.isNull() & ~in_range(lon, lat), "coordinates out of range"
    )


def file_kind(path: Column) -> Column:
    """mesh, city or cloud by a path's suffix, whatever its case; else NULL."""
    low = F.lower(path)
    return F.when(low.endswith(".obj"), "mesh").when(low.endswith(".city.jsonl") | low.endswith(".jsonl"), "city").when(low.endswith(".las") | low.endswith(".laz"), "cloud")


def inventory(members: DataFrame, sample: int = 20) -> DataFrame:
    """One row an archive: files, sizes, files by suffix, top level names and the first members.
    members: archive, ordinal, member, suffix, size, packed."""
    own = members.groupBy("archive").agg(
        F.count("*").alias("files"), F.sum("size").alias("bytes"), F.sum("packed").alias("packed_bytes"), F.array_sort(F.collect_set(F.split("member", "/")[0])).alias("top"),
    )
    kinds = members.groupBy("archive", F.when(F.col("suffix") == "", "<no suffix>").otherwise(F.col("suffix")).alias("suffix")).agg(F.count("*").alias("n"))
    kinds = kinds.groupBy("archive").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("suffix", "n")))).alias("suffixes"))
    first = members.where(F.col("ordinal") < sample).groupBy("archive").agg(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "member"))), lambda x: x["member"]).alias("sample"))
    return own.join(kinds, "archive").join(first, "archive", "left")
