"""Running aggregates that do not put a whole group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from sparkprep.plans.staging import stage

_COMBINE = {
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def running(
    df: DataFrame, value: str, how: str, name: str, order: list[str], groups: list[str] | None = None
) -> DataFrame:
    """Add ``name``: the running ``sum``, ``min`` or ``max`` of ``value``, this row included.

    A plain window sends all rows of a group to one task, which a group with a large
    share of the table does not survive. Here the rows are range-partitioned by group
    and order, so a large group spans many blocks of like size. The window runs within
    blocks; one total per group and block then carries the result across them. ``order``
    must identify a row within its group, for the result and for even blocks.
    """
    groups = groups or []
    aggregate, combine = _COMBINE[how]
    blocks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written once: both readers below have to see the same blocks.
    cut = stage(
        df.repartitionByRange(blocks, *groups, *order).withColumn("_block", F.spark_partition_id()),
        "blocks",
    )
    within = Window.partitionBy(*groups, "_block").orderBy(*order)
    inner = cut.withColumn(
        "_inner", aggregate(value).over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    earlier = (
        Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        cut.groupBy(*groups, "_block")
        .agg(aggregate(value).alias("_total"))
        .withColumn("_before", aggregate("_total").over(earlier))
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"i.{c}").eqNullSafe(F.col(f"c.{c}")) for c in [*groups, "_block"]],
    )
    return (
        inner.alias("i")
        .join(carried.alias("c"), same)
        .select(
            *(F.col(f"i.{c}") for c in df.columns),
            combine(F.col("_inner"), F.col("_before")).alias(name),
        )
    )
