"""Class counts of point tiles as they land: an extension, without a counterpart to match."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landed(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    """A stream of Parquet tiles in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def windowed_counts(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events (ts, event_type) by window and type; windows close when the watermark has passed."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def class_counts(points: DataFrame) -> DataFrame:
    """Running number of points, and height range, of each class."""
    return points.groupBy("classification").agg(F.count("*").alias("points"), F.min("z").alias("z_min"), F.max("z").alias("z_max"))
