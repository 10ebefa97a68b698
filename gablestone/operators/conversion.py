"""An archive of labelled roof images as a training set: splits, label lines, images, manifest and dataset file.

Split lists and the two collections are members of the archive; everything after them is rows, so that tiles and objects meet in
cells and labels are cut in expressions or, exactly, in tasks. Images go from the archive to their place a member at a time."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablestone.operators import overlay, tiles
from gablestone.operators.shared import uri
from gablestone.sources import archives

#: Members of the archive and its coordinate system.
TRAINING, TEST = "training_split_512.csv", "test_split_512.csv"
IMAGES, OBJECTS = "geometries/gdf_images_with_labels_512.json", "geometries/gdf_all_superstructures.json"
SOURCE_CRS = "EPSG:28992"


def _one(read: DataFrame, member: str) -> DataFrame:
    return read.where(F.col("member") == member).withColumn("text", F.decode("content", "utf-8"))


def splits(read: DataFrame) -> DataFrame:
    """(image, split) of the two lists: a column image_names, with or without others and a byte order mark. An image in both is in training."""

    def run(batches):
        import csv
        import io

        import pandas as pd

        for pdf in batches:
            rows = [(r["image_names"], split) for text, split in pdf[["text", "split"]].itertuples(index=False) for r in csv.DictReader(io.StringIO(text.removeprefix("﻿")))]
            yield pd.DataFrame(rows, columns=["image", "split"])

    both = _one(read, TRAINING).withColumn("split", F.lit("train")).unionByName(_one(read, TEST).withColumn("split", F.lit("val")))
    return both.select("text", "split").mapInPandas(run, "image string, split string").groupBy("image").agg(F.min("split").alias("split"))


def _features(read: DataFrame, member: str, properties: str) -> DataFrame:
    shape = f"struct<features: array<struct<properties: struct<{properties}>, geometry: struct<type: string, coordinates: string>>>>"
    return _one(read, member).select(F.posexplode(F.from_json("text", shape)["features"]).alias("number", "f")).select("number", "f.properties.*", F.col("f.geometry").alias("geometry"))


def tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(images: tile, image, split, box, error; objects: object_id, label, part, rings made valid; members that are images) of an archive."""
    listed = archives.directory(spark, path)
    wanted = [TRAINING, TEST, IMAGES, OBJECTS]
    read = archives.contents(listed.where(F.col("member").isin(wanted)))
    lost = [r["member"] or r["archive"] for r in read.where("error is not null").select("member", "archive").collect()]  # four rows at most
    found = {r["member"] for r in read.select("member").collect()}
    if lost or set(wanted) - found:
        raise ValueError(f"the archive lacks or cannot read {', '.join(sorted([*lost, *(set(wanted) - found)]))}")
    ring = tiles.polygons(_features(read, IMAGES, "id: string"))
    corner = lambda f, c: f(F.transform(F.flatten("rings"), lambda p: p[c]))
    boxes = ring.groupBy(F.col("id").alias("tile")).agg(*[f(corner(g, c)).alias(n) for f, g, c, n in ((F.min, F.array_min, "x", "x1"), (F.min, F.array_min, "y", "y1"), (F.max, F.array_max, "x", "x2"), (F.max, F.array_max, "y", "y2"))])
    images = boxes.withColumn("image", F.concat("tile", F.lit(".png"))).join(splits(read), "image", "left").withColumn("error", F.when(F.col("split").isNull(), "in no split list"))
    rows = tiles.polygons(_features(read, OBJECTS, "label: string")).groupBy("number", "label").agg(F.flatten(F.collect_list("rings")).alias("rings"))
    objects = overlay.repaired(rows, ["number", "label"]).where("error is null").select(F.col("number").cast("long").alias("object_id"), "label", "part", "rings")
    return images, objects, listed.where(F.col("member").startswith("images/"))


def cut_exactly(images: DataFrame, objects: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """What tiles.cut_objects() gives, with a row for each polygon that is left: a concave outline that a tile's border cuts in two is two."""
    dims = objects.sparkSession.createDataFrame(sorted(mapping.items()), "label string, canonical string")
    met = tiles.met(images.select("tile", "x1", "y1", "x2", "y2"), objects).join(F.broadcast(dims), "label", "left")
    point = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    box = F.array(F.array(point("x1", "y1"), point("x2", "y1"), point("x2", "y2"), point("x1", "y2")))
    keys = ["tile", "object_id", "piece", "label", "canonical", "x1", "y1", "x2", "y2"]
    pairs = met.withColumnRenamed("part", "piece").select(*keys, F.col("rings").alias("of_a"), box.alias("of_b"))
    out = overlay.parts_of(pairs, keys, ["of_a", "of_b"], "intersection")
    ring = F.col("rings")[0]
    open_ = F.when(ring.isNotNull(), F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))).otherwise(F.array().cast("array<struct<x: double, y: double>>"))
    # Pieces of one part follow one another.
    return out.select("tile", "object_id", F.struct("piece", F.coalesce("part", F.lit(0)).alias("of")).alias("part"), "label", "canonical", open_.alias("ring"), "x1", "y1", "x2", "y2")


def convert(spark: SparkSession, path: str, output: str, mapping: dict[str, str], classes: dict[str, int], source: dict, taxonomy_version: str) -> tuple[DataFrame, DataFrame]:
    """Write labels/<split>/<tile>.txt and images/<split>/<tile>.png, manifest.json and dataset.yaml under output; (images with the
    error of those that are not written, manifest rows). mapping: label to class; classes: class to number; source: version, record_url,
    archive_md5, licence. Labels of tiles that no split list names are not written."""
    from pyspark.sql import types as T

    images, objects, members = tables(spark, path)
    good = images.where("error is null")
    cut = cut_exactly(good, objects, mapping)
    lines = good.select("tile", "split").join(tiles.label_lines(cut, classes), "tile", "left")
    texts = lines.select(F.concat_ws("/", F.lit("labels"), "split", F.concat("tile", F.lit(".txt"))).alias("file"), F.coalesce("value", F.lit("")).cast("binary").alias("content"))
    named = members.join(good.select(F.concat(F.lit("images/"), "image").alias("member"), "split", "image"), "member")
    pictures = archives.contents(named)
    write_files(texts, output)
    write_files(pictures.where("error is null").select(F.concat_ws("/", F.lit("images"), "split", "image").alias("file"), "content"), output)
    counts, by_split = tiles.label_counts(cut, good)
    of = {(r["ignored"], r["name"]): r["instances"] for r in counts.collect()}  # a row a class
    n = {r["split"]: r["images"] for r in by_split.collect()}
    manifest = {
        "source_version": source["version"], "source_record_url": source["record_url"], "archive_md5": source["archive_md5"], "source_crs": SOURCE_CRS, "taxonomy_version": taxonomy_version, "licence": source.get("licence"),
        "train_images": n.get("train", 0), "validation_images": n.get("val", 0), "instance_counts": {k: v for (i, k), v in sorted(of.items()) if not i}, "ignored_instance_counts": {k: v for (i, k), v in sorted(of.items()) if i},
    }
    names = "\n".join(f"  {k}: {name}" for name, k in sorted(classes.items(), key=lambda x: x[1]))
    both = [("manifest.json", json.dumps(manifest, indent=2, ensure_ascii=False) + "\n"), ("dataset.yaml", f"train: images/train\nval: images/val\nnames:\n{names}\n")]
    write_files(spark.createDataFrame([(f, bytearray(t.encode())) for f, t in both], T.StructType([T.StructField("file", T.StringType()), T.StructField("content", T.BinaryType())])), output)
    lost = pictures.where("error is not null").select("image", F.col("error").alias("broken"))
    written = images.join(members.select(F.substring("member", len("images/") + 1, 1 << 20).alias("image"), F.lit(True).alias("there")), "image", "left").join(lost, "image", "left")
    return written.select("tile", "image", "split", F.coalesce("error", "broken", F.when(F.col("there").isNull(), "no image in the archive")).alias("error")), spark.createDataFrame([(json.dumps(manifest),)], "value string")


def write_files(rows: DataFrame, output: str) -> None:
    """Each row's content as a file under output, under a name of its own first: a task that runs again leaves the same file."""
    base = uri(output)

    def run(batches):
        import os
        import uuid

        from pyarrow import fs

        for pdf in batches:
            for file, content in pdf[["file", "content"]].itertuples(index=False):
                where, path = fs.FileSystem.from_uri(f"{base.rstrip('/')}/{file}")
                where.create_dir(os.path.dirname(path), recursive=True)
                own = f"{path}.{uuid.uuid4().hex}.tmp"
                with where.open_output_stream(own) as out:
                    out.write(content)
                where.move(own, path)
            yield pdf[["file"]]

    rows.select("file", "content").mapInPandas(run, "file string").count()
