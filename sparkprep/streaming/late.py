"""Windows over a stream in which late rows are data: nothing is dropped, everything is counted.

A watermark drops the rows behind it and leaves a number in a progress report. Here each
micro-batch writes three things: the states of the windows that its rows fell into, the rows that came
after their window was closed, and its counters. Windows and late rows together hold every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkprep.plans.staging import stage, unstage

ENTRY = ["event_id", "ts", "endpoint_id", "status", "latency"]
KEYS = ["window_start", "window_end", "endpoint_id", "status"]
LATE = (
    "event_id bigint, ts timestamp, endpoint_id string, status string, latency double,"
    " window_start timestamp, window_end timestamp, watermark timestamp, behind_seconds double, batch bigint"
)
STATE = (
    "window_start timestamp, window_end timestamp, endpoint_id string, status string,"
    " entries bigint, measured bigint, latency_sum double, latency_min double, latency_max double, batch bigint"
)
PROGRESS = "rows bigint, on_time bigint, late bigint, undated bigint, watermark timestamp, newest timestamp, batch bigint"


def window_bounds(ts: Column, seconds: int) -> tuple[Column, Column]:
    """Start and end of the tumbling window of a time; null without a time."""
    micros = F.unix_micros(ts)
    start = micros - F.pmod(micros, F.lit(seconds * 1_000_000))
    return F.timestamp_micros(start), F.timestamp_micros(start + seconds * 1_000_000)


def track_windows(log: DataFrame, path: str, checkpoint: str, seconds: int = 86_400, delay: str = "10 minutes") -> StreamingQuery:
    """Follow tumbling windows per endpoint and status over what has arrived, and return the running query.

    The watermark of a batch is the newest time of all batches before it, less ``delay``. A row is
    late if its window ends at the watermark or before; it goes to ``<path>/late`` with its window, the
    watermark and how far its own time is behind it. A row without a time has no window and goes there
    too. All others are added up below ``<path>/windows`` as counts, sums and extremes, which merge. Every
    batch leaves its counters and the newest time below ``<path>/progress``.

    There is a folder per batch in each, so a batch that is repeated after a failure replaces its output;
    it reads nothing but the counters of the batch before. Rows are added up before the shuffle, so a
    busy endpoint is a few rows per task.
    """

    def advance(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = None
        if number > 0:
            before = spark.read.schema("newest timestamp").parquet(f"{path}/progress/batch={number - 1}")
            newest = before.select("newest", (F.col("newest") - F.expr(f"INTERVAL {delay}")).alias("watermark")).first()
        watermark = F.lit(newest and newest["watermark"]).cast("timestamp")
        start, end = window_bounds(F.col("ts"), seconds)
        rows = batch.select(*ENTRY, start.alias("window_start"), end.alias("window_end"), watermark.alias("watermark"))
        behind = F.col("ts").isNull() | F.coalesce(F.col("window_end") <= F.col("watermark"), F.lit(False))
        rows = stage(rows.withColumn("is_late", behind), "stream-batch")
        distance = (F.unix_micros("watermark") - F.unix_micros("ts")) / 1_000_000
        late = rows.filter("is_late").drop("is_late").withColumn("behind_seconds", distance)
        late.write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        states = rows.filter("NOT is_late").groupBy(*KEYS).agg(
            F.count(F.lit(1)).alias("entries"),
            F.count("latency").alias("measured"),
            F.sum("latency").alias("latency_sum"),
            F.min("latency").alias("latency_min"),
            F.max("latency").alias("latency_max"),
        )
        states.write.mode("overwrite").parquet(f"{path}/windows/batch={number}")
        counters = rows.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~F.col("is_late")).alias("on_time"),
            F.count_if(F.col("is_late")).alias("late"),
            F.count_if(F.col("ts").isNull()).alias("undated"),
            watermark.alias("watermark"),
            F.greatest(F.max("ts"), F.lit(newest and newest["newest"]).cast("timestamp")).alias("newest"),
        )
        counters.write.mode("overwrite").parquet(f"{path}/progress/batch={number}")
        unstage(rows)

    writer = log.writeStream.foreachBatch(advance).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came too late, with window, watermark, seconds behind it and batch."""
    return spark.read.schema(LATE).parquet(f"{path}/late")


def progress(spark: SparkSession, path: str) -> DataFrame:
    """A row of counters per batch: ``rows, on_time, late, undated, watermark, newest, batch``."""
    return spark.read.schema(PROGRESS).parquet(f"{path}/progress")


def window_totals(spark: SparkSession, path: str) -> DataFrame:
    """``window_start, window_end, endpoint_id, status, prediction_count, total, mean, min, max, late`` of each window.

    The states of all batches merged, and the number of rows that came too late for the window; a
    window that has late rows only counts 0 predictions. The counts and ``late`` of all windows, and the
    rows without a time, add up to the rows of the stream.
    """
    states = spark.read.schema(STATE).parquet(f"{path}/windows")
    missed = late_rows(spark, path).filter("window_start IS NOT NULL").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("late"))
    own = states.groupBy(*KEYS).agg(
        F.sum("entries").alias("prediction_count"),
        F.sum("latency_sum").alias("total"),
        F.try_divide(F.sum("latency_sum"), F.sum("measured")).alias("mean"),
        F.min("latency_min").alias("min"),
        F.max("latency_max").alias("max"),
        F.lit(0).cast("bigint").alias("late"),
    )
    nothing = [F.lit(0).cast("bigint").alias("prediction_count"), *(F.lit(None).cast("double").alias(c) for c in ("total", "mean", "min", "max"))]
    both = own.unionByName(missed.select(*KEYS, *nothing, "late"))
    return both.groupBy(*KEYS).agg(*(F.max(c).alias(c) for c in ("prediction_count", "total", "mean", "min", "max", "late")))
