"""As-of joins of large tables, by a merged order instead of a comparison of pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from sparkprep.plans.staging import stage


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_at: str, right_at: str, values: list[str]) -> DataFrame:
    """Rows of ``left`` with ``values`` of the last row of ``right`` that has the same keys ``on`` and is not after them.

    "Not after" means ``right_at <= left_at``; of several last rows the one with the greatest ``values``
    counts. Where there is none, and for null keys or a null ``left_at``, the values are null, so no
    row of ``left`` is lost or repeated.

    Both tables are merged into one order by key and place and range-partitioned by it, with a salt for
    rows of one place, so a key with a large share of all rows spans many blocks. Within a block the last
    values are carried along by a window; one row per key and block carries them on across
    blocks. Nothing is compared in pairs, and neither side has to fit anywhere.
    """
    names = {c: f"_on{i}" for i, c in enumerate(on)}
    keys = list(names.values())
    value = F.struct(*(F.col(v).alias(f"v{i}") for i, v in enumerate(values)))
    here = left.select(
        *(F.col(c).alias(n) for c, n in names.items()), F.col(left_at).alias("_at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).alias("_value")
    )
    there = right.filter(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in [*on, right_at])))
    there = there.select(
        *(F.col(c).alias(n) for c, n in names.items()), F.col(right_at).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(left.schema).alias("_row"), value.alias("_value")
    )
    merged = there.unionByName(here).withColumn("_salt", F.monotonically_increasing_id())
    order = ["_at", "_side", "_value", "_salt"]
    blocks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written once: both readers below have to see the same blocks.
    cut = stage(merged.repartitionByRange(blocks, *keys, *order).withColumn("_block", F.spark_partition_id()), "asof-blocks")
    within = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = cut.withColumn("_inner", F.last("_value", ignorenulls=True).over(within)).filter("_side = 1")
    place = F.struct("_at", "_value")
    ends = cut.groupBy(*keys, "_block").agg(F.max_by("_value", F.when(F.col("_side") == 0, place)).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_block", F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
    same = reduce(lambda a, b: a & b, (F.col(f"i.{c}").eqNullSafe(F.col(f"c.{c}")) for c in [*keys, "_block"]))
    joined = inner.alias("i").join(carried.alias("c"), same)
    complete = reduce(lambda a, b: a & b, (F.col(f"i.{c}").isNotNull() for c in [*keys, "_at"]))
    found = F.when(complete, F.coalesce("i._inner", "c._before"))
    rows = joined.select(F.col("i._row").alias("_row"), found.alias("_found"))
    return rows.select("_row.*", *(F.col(f"_found.v{i}").alias(v) for i, v in enumerate(values)))
