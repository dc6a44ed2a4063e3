"""Window states of a log that merge, so that metrics of a time range read states and not entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sparkprep.functions.stats import select_ranks
from sparkprep.operators.monitoring import between

STATE = "window bigint, bucket bigint, entries bigint, measured bigint, total double, low double, high double, batch int"
VALUE = "bucket bigint, ts timestamp, value double, batch int, window bigint"
DAY = 86_400
WIDTH = 1 / 16  # a power of two, by which values divide exactly, so buckets are in the order of values


def _states(rows: DataFrame) -> DataFrame:
    return rows.groupBy("window", "bucket").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count("value").alias("measured"),
        F.sum("value").alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def write_states(log: DataFrame, value: str, path: str, batch: int = 0, seconds: int = DAY, width: float = WIDTH) -> None:
    """Add a batch of entries (``ts`` and a value, which may be null) to the states below ``path``.

    ``states`` has a row per window and bucket: the numbers of entries and of values, their sum and extremes.
    A window is the second it starts at; a bucket is a stretch of values ``width`` wide, and null for entries
    without a value. ``values`` has the times and values in a folder per window, sorted by bucket, so a window's bucket
    is read from few row groups. There is a folder per batch in each: a repeated batch replaces its
    own, and those of several batches add up. Entries without a time are in no window. Entries are added up
    before the shuffle.
    """
    second = F.floor(F.unix_micros("ts") / 1_000_000).cast("bigint")
    number = F.when(F.isnan(value), F.lit(2**63 - 1)).otherwise(F.floor(F.col(value) / F.lit(width)).cast("bigint"))
    rows = log.filter("ts IS NOT NULL").select(
        (second - F.pmod(second, F.lit(seconds))).alias("window"), number.alias("bucket"), "ts", F.col(value).cast("double").alias("value")
    )
    _states(rows).write.mode("overwrite").parquet(f"{path}/states/batch={batch}")
    order = ["window", "bucket", "value", "ts"]
    kept = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept.write.mode("overwrite").partitionBy("window").parquet(f"{path}/values/batch={batch}")


def _bound(value) -> Column:
    return F.lit(value).cast("timestamp")


def metrics_from_states(spark: SparkSession, path: str, prefix: str, start=None, end=None, seconds: int = DAY) -> DataFrame:
    """One row: ``<prefix>_count`` and ``mean, median, min, max`` of the values from ``start`` to ``end``, both inclusive.

    The same as from the entries. Windows that lie in the range give their states; the entries of the two that it
    cuts are read and added up. The buckets' counts say which holds the median, and only that bucket's values are
    read, and narrowed down by counting. 0 where there is nothing.
    """
    states = spark.read.schema(STATE).parquet(f"{path}/states").drop("batch")
    values = spark.read.schema(VALUE).parquet(f"{path}/values").drop("batch")
    first, last = F.timestamp_seconds("window"), F.timestamp_seconds(F.col("window") + seconds)
    inside, touched = F.lit(True), F.lit(True)
    if start is not None:
        inside, touched = inside & (first >= _bound(start)), touched & (last > _bound(start))
    if end is not None:
        inside, touched = inside & (last <= _bound(end)), touched & (first <= _bound(end))
    merged = states.filter(inside).unionByName(_states(between(values.filter(touched & ~inside), start, end)))
    merged = merged.groupBy("bucket").agg(*(f(c).alias(c) for c, f in (("entries", F.sum), ("measured", F.sum), ("total", F.sum), ("low", F.min), ("high", F.max))))
    measured = merged.agg(
        F.coalesce(F.sum("entries"), F.lit(0)).alias(f"{prefix}_count"),
        F.coalesce(F.try_divide(F.sum("total"), F.sum("measured")), F.lit(0.0)).alias("mean"),
        F.coalesce(F.min("low"), F.lit(0.0)).alias("min"),
        F.coalesce(F.max("high"), F.lit(0.0)).alias("max"),
    )
    buckets = merged.filter("bucket IS NOT NULL").select("bucket", F.col("measured").alias("n"), "low", "high")
    ordered = Window.orderBy("bucket")  # a row per bucket of the whole range
    buckets = buckets.withColumn("upto", F.sum("n").over(ordered)).withColumn("all", F.sum("n").over(Window.partitionBy()))
    ranks = F.array(F.floor((F.col("all") + 1) / 2), F.floor(F.col("all") / 2) + 1)
    sides = buckets.select("*", F.posexplode(ranks).alias("side", "rank"))
    held = sides.filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
    found = held.select("side", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "low", "high", "bucket").collect()  # two rows at most
    ranges = spark.createDataFrame([tuple(r)[:4] for r in found], "side int, rank bigint, low double, high double")
    rows = between(values.filter(touched & F.col("bucket").isin([r.bucket for r in found])), start, end)
    middle = select_ranks(rows.select(F.col("value").alias("v")), ranges, []).agg(F.coalesce(F.max("median"), F.lit(0.0)))
    return measured.withColumn("median", middle.scalar())
