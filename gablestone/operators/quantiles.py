"""Exact quantiles of groups of any size, by selection.

A group of up to `limit` values is sorted in one task. For a larger one the ranks that its quantiles lie between are
narrowed down: values are counted in ranges (partial sums in the tasks, a row for each range), the range that
holds the rank is kept with its own least and greatest value, and so on until it holds few values, or one and the
same. Each pass reads the rows again and keeps nothing of them, so no task ever holds more than `limit` values of a
group; a range is divided by BINS, so two or three passes do for heights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablestone.operators.shared import cut

LIMIT = 50_000
BINS = 1024
#: Ranks looked for at once up to which they are broadcast.
BROADCAST_RANKS = 50_000


def quantiles(rows: DataFrame, keys: list[str], value: str, probabilities: tuple, limit: int = LIMIT, bins: int = BINS) -> DataFrame:
    """keys and quantiles: an array with the linearly interpolated quantile at each probability, of the
    values that are not null; groups without any have no row. keys and the value keep their names; rows may have
    other columns, which are not read."""
    rows = rows.select(*keys, F.col(value).cast("double").alias("v")).where("v is not null")
    at = F.array(*map(F.lit, probabilities))
    sizes = cut(rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")))
    large = sizes.where(F.col("n") > limit)
    if large.isEmpty():
        return rows.groupBy(*keys).agg(F.percentile("v", at).alias("quantiles")).where("quantiles is not null")
    few = rows
    if keys:
        few = rows.join(_maybe_small(large.select(*keys)), keys, "left_anti")
    else:
        few = rows.limit(0)
    small = few.groupBy(*keys).agg(F.percentile("v", at).alias("quantiles")).where("quantiles is not null")
    # The two ranks around each quantile, from 0.
    place = F.transform(at, lambda p: p * (F.col("n") - 1))
    ranks = F.array_distinct(F.flatten(F.transform(place, lambda x: F.array(F.floor(x), F.ceil(x)))))
    open_ = large.select(*keys, F.explode(ranks).alias("rank"), F.col("n").alias("size"), "low", "high", F.lit(0).cast("long").alias("before"))
    by = Window.partitionBy(*keys, "rank").orderBy("bin")
    found = []
    while True:
        one = F.col("low") == F.col("high")
        found.append(open_.where(one).select(*keys, "rank", F.col("low").alias("v")))
        found.append(_within(rows, open_.where(~one & (F.col("size") <= limit)), keys))
        open_ = open_.where(~one & (F.col("size") > limit))
        if open_.isEmpty():
            break
        met = _met(rows, open_, keys).withColumn("bin", F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * bins)))
        counts = met.groupBy(*keys, "rank", "before", "bin").agg(F.count("*").alias("size"), F.min("v").alias("low"), F.max("v").alias("high"))
        counts = counts.withColumn("upto", F.col("before") + F.sum("size").over(by)).withColumn("before", F.col("upto") - F.col("size"))
        open_ = cut(counts.where("before <= rank and rank < upto").select(*keys, "rank", "size", "low", "high", "before"))
    values = found[0]
    for more in found[1:]:
        values = values.unionByName(more)
    held = values.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("of"))
    of = lambda r: F.element_at("of", r.cast("long"))
    whole = large.join(held, keys) if keys else large.crossJoin(held)  # one row each
    between = F.transform(place, lambda x: of(F.floor(x)) + (of(F.ceil(x)) - of(F.floor(x))) * (x - F.floor(x)))
    whole = whole.select(*keys, between.alias("quantiles"))
    return small.unionByName(whole) if keys else whole


def _maybe_small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_RANKS else df


def _met(rows: DataFrame, open_: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the open ranks whose range they lie in."""
    inside = F.col("v").between(F.col("low"), F.col("high"))
    if keys:
        return rows.join(_maybe_small(open_), keys).where(inside)
    return rows.crossJoin(F.broadcast(open_)).where(inside)  # a row for each rank


def _within(rows: DataFrame, open_: DataFrame, keys: list[str]) -> DataFrame:
    """The value of each rank whose range holds few values."""
    order = Window.partitionBy(*keys, "rank").orderBy("v")
    return _met(rows, open_, keys).withColumn("k", F.col("before") + F.row_number().over(order) - 1).where("k = rank").select(*keys, "rank", "v")
