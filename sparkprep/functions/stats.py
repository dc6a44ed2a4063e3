"""Aggregate expressions and exact order statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkprep.plans.staging import stage, unstage

MEASURES = ("count", "min", "max", "mean", "median", "std")


def basic_stats(value: Column | str) -> dict[str, Column]:
    """Count, min, max, mean, exact median and sample deviation of an integer column.

    0 where there is nothing to measure. The median is Spark's, which counts equal
    values before the shuffle; that is compact for lengths. For measurements with
    unlimited distinct values use :func:`exact_median`.
    """
    value = F.col(value) if isinstance(value, str) else value
    return {
        "count": F.count(value),
        "min": F.coalesce(F.min(value), F.lit(0)),
        "max": F.coalesce(F.max(value), F.lit(0)),
        "mean": F.coalesce(F.avg(value), F.lit(0.0)),
        "median": F.coalesce(F.median(value), F.lit(0.0)),
        "std": F.coalesce(F.stddev_samp(value), F.lit(0.0)),
    }


BUCKETS = 1024


def exact_median(df: DataFrame, value: str, groups: list[str] | None = None) -> DataFrame:
    """``groups, median``: the exact median of a double column, per group.

    A plain median gathers every distinct value of a group in one task. Here the range that
    holds the median is narrowed by counting: the values in it fall into ``BUCKETS`` buckets,
    whose counts, least and largest values add up in the tasks before they shuffle. The
    bucket that holds the wanted rank is the next range, until it is a single value. No task
    sees more than the buckets of a group. A group without values has no row.
    """
    groups = groups or []
    data = df.select(*groups, F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    ends = data.groupBy(*groups).agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    ranks = F.array(F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1)
    ranges = ends.filter("n > 0").select(*groups, F.posexplode(ranks).alias("side", "rank"), "low", "high")
    return select_ranks(data, ranges, groups)


def select_ranks(data: DataFrame, ranges: DataFrame, groups: list[str]) -> DataFrame:
    """``groups, median``: the mean of the values ``v`` of ``data`` at the ranks of a group's ``ranges``.

    A range is ``groups, side, rank, low, high``: the value wanted is the one of that rank among
    those from ``low`` to ``high``.
    """
    ranges = stage(ranges, "median-ranges")
    while ranges.filter("NOT low <=> high").limit(1).count():
        narrowed = stage(_narrowed(data, ranges, groups), "median-ranges")
        unstage(ranges)
        ranges = narrowed
    return ranges.groupBy(*groups).agg(F.avg("low").alias("median")).filter("median IS NOT NULL")


def _narrowed(data: DataFrame, ranges: DataFrame, groups: list[str]) -> DataFrame:
    """The ranges' buckets that hold the wanted ranks. The ends are buckets of their own, so ranges shrink."""
    wide = ranges.filter("NOT low <=> high")
    if groups:
        rows = data.join(wide, groups).filter("v >= low AND v <= high")
    else:  # two ranges at most
        limits = F.array(*(F.struct(*(F.lit(x).alias(c) for c, x in r.asDict().items())) for r in wide.collect()))
        rows = data.select("v", F.inline(limits)).filter("v >= low AND v <= high")
    place = (F.col("v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * (BUCKETS - 2)
    inner = F.coalesce(F.nanvl(place, F.lit(0.0)), F.lit(0.0)).cast("int") + 1
    bucket = F.when(F.col("v") == F.col("low"), 0).when(F.col("v") == F.col("high"), BUCKETS).otherwise(F.least(inner, F.lit(BUCKETS - 1)))
    keys = [*groups, "side", "rank"]
    counts = rows.groupBy(*keys, bucket.alias("bucket")).agg(F.count("v").alias("c"), F.min("v").alias("low"), F.max("v").alias("high"))
    upto = F.sum("c").over(Window.partitionBy(*groups, "side").orderBy("bucket"))
    found = counts.withColumn("upto", upto).filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("c") < F.col("rank")))
    found = found.withColumn("rank", F.col("rank") - (F.col("upto") - F.col("c")))
    return found.select(ranges.columns).unionByName(ranges.filter("low <=> high"))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; ``0.0`` is added so that no negative zero is left."""
    return df.select(
        *(
            (F.round(F.col(f"`{n}`"), digits) + F.lit(0.0)).alias(n)
            if t == "double"
            else F.col(f"`{n}`")
            for n, t in df.dtypes
        )
    )
