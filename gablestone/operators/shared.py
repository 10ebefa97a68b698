"""Lineage cuts that survive a lost executor."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def folder(spark) -> str:
    """The folder of spark.checkpoint.dir that driver and executors share, set in the session or by setCheckpointDir. Only where it is
    unset and Spark runs on one machine is a temporary folder taken."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        found = spark.conf.get("spark.checkpoint.dir", "")
        if not found and sc.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(found or tempfile.mkdtemp(prefix="gablestone-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read from there."""
    folder(df.sparkSession)
    return df.checkpoint()


def uri(path: str) -> str:
    """A path with its scheme; one without is of the local file system."""
    return path if "://" in path else f"file://{path.removeprefix('file:')}"
