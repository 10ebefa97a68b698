"""What the operators share: the shared work folder, written cuts, free column names, tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session, a path
    without a scheme meaning one of the default file system. Only where it is unset and Spark runs
    on one machine (as in tests) is a temporary folder made."""
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if found:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found)
        return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="gablestone-"))
    return f"file://{_LOCAL[0]}"


def scratch(spark: SparkSession, tag: str) -> str:
    """A path of its own for each call."""
    return f"{work_dir(spark).rstrip('/')}/gablestone/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write a table to the shared folder and read it again: lineage ends there, so a lost executor
    costs at most the tasks of the running stage."""
    return _written(df, scratch(df.sparkSession, tag))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Work:
    """The cuts of one call under one folder, deleted when they have served:

    with Work(spark, "tag") as work: ...; return work.keep(result)"""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.tag, self.path = spark, tag, scratch(spark, f"{tag}-work")

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        return _written(df, f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, f"{self.path}/{name}")

    def release(self) -> None:
        """Shuffle files of jobs that are done go when the driver collects its garbage; large ones need not
        wait until it happens to."""
        import gc

        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def keep(self, df: DataFrame) -> DataFrame:
        """The result, written outside the folder: it outlives the call."""
        return cut(df, self.tag)

    def __enter__(self) -> Work:
        return self

    def __exit__(self, *error) -> None:
        remove(self.spark, self.path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs, with whatever columns, without the rows whose doc_id is in the only column of ids; a
    null there stands for the rows without a doc_id."""
    gone, = unused(docs, "gone")
    ids = ids.toDF(gone).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids[gone]), "left_anti")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and other named columns; whatever else docs has stays out."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)
