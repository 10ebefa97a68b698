"""Reports as typed, versioned documents: written from rows and read again strictly.

A kind is a schema; fields NOT NULL must be there. A document that has another kind or version, a field that its kind does not
know, one of another type or none where one is needed is a row whose report_error names the field by its path."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

VERSION = 1
_REASONS = "reasons array<string> not null"
_PLANE = "struct<plane: int not null, support: bigint not null, nx: double not null, ny: double not null, nz: double not null, slope_deg: double not null, aspect_deg: double, median_m: double not null, p95_m: double not null>"
#: Kind of report: its fields beside schema_version, kind and building_id.
KINDS = {
    "lidar_quality": (
        "available boolean not null, point_count bigint not null, roof_point_count bigint not null, density_all double, density_roof double, coverage_050m double, coverage_100m double, largest_hole_ratio double, spacing_p50 double, spacing_p90 double, planar_support double,"
        " residual_p50 double, outlier_ratio double, alignment_score double, shift_x double, shift_y double, quality_class string not null, quality_score double not null, warnings string"
    ),
    "roof_hypothesis": f"roof_form string not null, evidence_score double not null, density double, valid_ratio double not null, planar double, {_REASONS}",
    "roof_complexity": f"complexity_class string not null, complexity_score double not null, {_REASONS}",
    "lod_feasibility": "lod12 boolean not null, lod13 boolean not null, lod22 boolean not null, lod12_score double not null, lod13_score double not null, lod22_score double not null, highest_lod string, lod12_reasons array<string> not null, lod13_reasons array<string> not null, lod22_reasons array<string> not null",
    "reconstruction_plan": "target_lod string, selected_backend string, fallback_lod string, profile string, forced boolean not null, decision string not null, plan_reasons array<string> not null, plan_warnings array<string> not null",
    "roof_planes": f"explained double not null, planes array<{_PLANE}> not null",
    "height_metrics": "valid_ratio double not null, gradient_p50 double, gradient_p95 double, discontinuity double",
    "lidar_fit": "points bigint not null, median_m double, rmse_m double, p95_m double, within_020m double, within_050m double, within_100m double, status string not null",
    "quality_gate": "accepted boolean not null, confidence string not null, failures array<string> not null",
    "roof_objects": "profile string not null, status string not null, raw_candidates bigint not null, retained_objects bigint not null, retained_classes map<string, bigint> not null, error string",
    "selection": "profile string not null, cadastral_root_id string not null, photovoltaic_panels string, notes string",
    "vision_config": (
        "model struct<name: string not null, task: string not null, pretrained: boolean not null> not null, input struct<image_size: int not null, channels: int not null> not null,"
        " training struct<epochs: int not null, batch_size: int not null, seed: int not null, patience: int not null> not null, tracking struct<enabled: boolean not null, project: string> not null, export struct<format: string not null, half: boolean not null> not null"
    ),
}


def schema(kind: str) -> StructType:
    if kind not in KINDS:
        raise ValueError(f"{kind} is none of {', '.join(KINDS)}")
    return StructType.fromDDL(f"schema_version int not null, kind string not null, building_id string not null, {KINDS[kind]}")


def encode(rows: DataFrame, kind: str) -> DataFrame:
    """(building_id, value): the document of each row, fields in the order of its kind, null ones too. A row that
    lacks what must be there is an error when it is read, not here."""
    own = {f.name: F.col(f.name).cast(f.dataType.simpleString()).alias(f.name) for f in schema(kind).fields if f.name not in ("schema_version", "kind")}
    whole = F.struct(F.lit(VERSION).alias("schema_version"), F.lit(kind).alias("kind"), *own.values())
    return rows.select(F.col("building_id").cast("string").alias("building_id"), F.to_json(whole, {"ignoreNullFields": "false"}).alias("value"))


def _wrong(value, kind, path: str, needed: bool) -> str | None:
    """What is wrong with a value, whose type is as StructType.jsonValue() has it."""
    if value is None:
        return f"{path}: missing" if needed else None
    if isinstance(kind, dict):
        name = kind["type"]
        if name == "struct":
            if not isinstance(value, dict):
                return f"{path}: not an object"
            known = {f["name"]: f for f in kind["fields"]}
            at = lambda n: f"{path}.{n}" if path else n
            extra = next((f"{at(n)}: unknown field" for n in value if n not in known), None)
            return extra or next((e for n, f in known.items() if (e := _wrong(value.get(n), f["type"], at(n), not f["nullable"]))), None)
        if name == "array":
            if not isinstance(value, list):
                return f"{path}: not a list"
            return next((e for k, x in enumerate(value) if (e := _wrong(x, kind["elementType"], f"{path}[{k}]", True))), None)
        if not isinstance(value, dict):
            return f"{path}: not an object"
        return next((e for n, x in value.items() if (e := _wrong(x, kind["valueType"], f"{path}.{n}", True))), None)
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == "string":
        good = isinstance(value, str)
    elif kind == "boolean":
        good = isinstance(value, bool)
    elif kind == "double":
        good = number
    else:
        good = number and isinstance(value, int) and abs(value) < 1 << (31 if kind == "integer" else 63)
    return None if good else f"{path}: not {'an' if kind[0] in 'aeiou' else 'a'} {kind}"


def decode(texts: DataFrame, kind: str, value: str = "value") -> DataFrame:
    """The fields of each document and report_error; fields are NULL where there is one. Other columns of texts stay."""
    own = schema(kind)
    spec = own.jsonValue()

    def check(documents):
        out = []
        for text in documents:
            try:
                found = json.loads(text if text is not None else "", parse_constant=lambda c: (_ for _ in ()).throw(ValueError(f"{c} is no number")))
            except ValueError as e:
                out.append(f"no JSON: {e}")
                continue
            if isinstance(found, dict) and found.get("kind") not in (None, kind):
                out.append(f"kind: {found['kind']}, not {kind}")
            elif isinstance(found, dict) and found.get("schema_version") not in (None, VERSION):
                out.append(f"schema_version: {found['schema_version']}, not {VERSION}")
            else:
                out.append(_wrong(found, spec, "", True))
        return documents.__class__(out, dtype=object)

    rows = texts.withColumn("report_error", F.pandas_udf(check, "string")(value))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.fields)
    rows = rows.withColumn("document_", F.from_json(F.when(F.col("report_error").isNull(), F.col(value)), ddl))
    fields = [f.name for f in own.fields if f.name not in ("schema_version", "kind")]
    others = [c for c in texts.columns if c != value and c not in fields]
    return rows.select(*others, *[F.col(f"document_.{f}").alias(f) for f in fields], "report_error")


def write(rows: DataFrame, kind: str, path: str) -> None:
    """Documents by kind and building: path/kind=.../ with a line for each."""
    encode(rows, kind).withColumn("kind", F.lit(kind)).select("kind", "value").write.mode("append").partitionBy("kind").text(path)


def read(spark, path: str, kind: str) -> DataFrame:
    return decode(spark.read.text(f"{path}/kind={kind}"), kind)
