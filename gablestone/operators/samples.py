"""Samples of a bounded number of rows a group that do not depend on how rows are dealt out.

Each row has a priority, a hash of the seed and its keys; a group's sample is its rows of least priority. Rows are counted by
the upper bits of their priorities (partial sums in the tasks, at most 2 ^ BITS rows a group are shuffled), which says up to
where priorities can belong to the sample; only those rows, about the sample and one in 2 ^ BITS more, are ranked."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BITS = 12


def sampled(rows: DataFrame, group: list[str], keys: list[str], most: int, seed: int = 42) -> DataFrame:
    """rows without those beyond `most` a group. keys tell the rows of a group apart; rows with equal keys are told apart by nothing
    and may take each other's place."""
    if most < 1:
        raise ValueError("a sample has one row at least")
    columns = rows.columns
    # As an unsigned number: the sign bit is turned over.
    priority = F.xxhash64(F.lit(seed), *group, *keys).bitwiseXOR(F.lit(-(1 << 63)))
    rows = rows.withColumn("priority_", priority).withColumn("bin_", F.shiftright("priority_", 64 - BITS))
    counts = rows.groupBy(*group, "bin_").agg(F.count("*").alias("n_"))
    so_far = F.sum("n_").over(Window.partitionBy(*group).orderBy("bin_")) - F.col("n_")
    reach = counts.withColumn("before_", so_far).where(F.col("before_") < most).groupBy(*group).agg(F.max("bin_").alias("reach_"))
    same = [rows[g].eqNullSafe(F.col(f"g_{g}")) for g in group]
    reach = reach.select(*[F.col(g).alias(f"g_{g}") for g in group], "reach_")
    near = rows.join(reach, same).where(F.col("bin_") <= F.col("reach_"))
    order = Window.partitionBy(*group).orderBy("priority_", *keys)
    return near.withColumn("place_", F.row_number().over(order)).where(F.col("place_") <= most).select(*columns)
