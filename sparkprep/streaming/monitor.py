"""The monitoring operators on streams.

A streaming log is what :func:`sparkprep.operators.monitoring.prediction_log` makes of a
stream; its ``ts`` must be a timestamp with time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.operators.monitoring import (
    ERROR_RATE_ALERT,
    FAILURE_ALERT,
    alert_level,
    failure_islands,
)
from sparkprep.plans.staging import delete, stage, unstage
from sparkprep.sources.files import scan_files


def windowed_metrics(log: DataFrame, size: str = "1 day", delay: str = "10 minutes") -> DataFrame:
    """Count and latency per tumbling window, endpoint and status."""
    return (
        log.withWatermark("ts", delay)
        .groupBy(F.window("ts", size).alias("w"), "endpoint_id", "status")
        .agg(
            F.count(F.lit(1)).alias("prediction_count"),
            F.avg("latency").alias("mean"),
            F.min("latency").alias("min"),
            F.max("latency").alias("max"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "endpoint_id",
            "status",
            "prediction_count",
            "mean",
            "min",
            "max",
        )
    )


def error_rate_alerts(
    log: DataFrame, size: str = "2 days", slide: str = "1 day", delay: str = "10 minutes"
) -> DataFrame:
    """Error rate with alert level per sliding window and endpoint."""
    return (
        log.withWatermark("ts", delay)
        .groupBy(F.window("ts", size, slide).alias("w"), "endpoint_id")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(F.col("status") == "error").alias("errors"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "endpoint_id",
            "requests",
            "errors",
            (F.col("errors") / F.col("requests")).alias("error_rate"),
            alert_level(F.col("errors") / F.col("requests"), ERROR_RATE_ALERT).alias("level"),
        )
    )


def feedback_windows(
    feedback: DataFrame, size: str = "1 day", delay: str = "10 minutes", accuracy: int = 10_000
) -> DataFrame:
    """Feedback count and score per window; the median is approximate."""
    return (
        feedback.withWatermark("ts", delay)
        .groupBy(F.window("ts", size).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("feedback_count"),
            F.avg("score").alias("mean"),
            F.min("score").alias("min"),
            F.max("score").alias("max"),
            F.percentile_approx("score", 0.5, accuracy).alias("approx_median"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "feedback_count",
            "mean",
            "min",
            "max",
            "approx_median",
        )
    )


def run_available(result: DataFrame, path: str, checkpoint: str) -> list[dict]:
    """Process what is there, append to a table at ``path``, return the progress reports."""
    query = (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query.recentProgress


def run_windows(result: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Process what is there and return all windows, those that are still open as well.

    Each micro-batch writes the windows it changed; of a window the last state counts. A
    repeated batch replaces its own output.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = result.writeStream.outputMode("update").foreachBatch(write)
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    schema = f"{', '.join(f'`{n}` {t}' for n, t in result.dtypes)}, batch bigint"
    states = result.sparkSession.read.schema(schema).parquet(path)
    row = F.struct(*(c for c in result.columns if c not in keys))
    return states.groupBy(*keys).agg(F.max_by(row, "batch").alias("row")).select(*keys, "row.*").select(result.columns)


STREAK = "endpoint_id string, failures bigint, first_ts timestamp, last_ts timestamp"
ENTRY = "event_id bigint, ts timestamp, endpoint_id string, status string"


def track_failures(log: DataFrame, streaks: str, state: str, checkpoint: str, delay: str = "10 minutes"):
    """Follow runs of failures per endpoint across micro-batches.

    Entries may come late and batches overlap in time: those newer than the newest entry less
    ``delay`` are held back, and runs advance over closed time only. An entry older than the
    time already closed is dropped, as by a watermark. Finished runs are appended below
    ``streaks``. ``state`` keeps the runs that are still open, the entries held back and
    the closed time. All are tables with one folder per batch, so a batch that is repeated
    after a failure replaces its own output and reads the state before it; older state goes.
    A batch is cut into runs by the batch operator, which spreads a busy endpoint over many
    tasks; the carried run is simply one more piece of the first one.
    """

    def advance(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("event_id", "ts", "endpoint_id", "status")
        before, closed = f"{state}/batch={number - 1}", None
        if number > 0:
            closed = spark.read.schema("closed timestamp").parquet(f"{before}/closed").first()["closed"]
            if closed is not None:
                rows = rows.filter(F.col("ts") > F.lit(closed))
            rows = rows.unionByName(spark.read.schema(ENTRY).parquet(f"{before}/held"))
        rows = stage(rows, "stream-batch")
        bound = rows.agg((F.max("ts") - F.expr(f"INTERVAL {delay}")).alias("bound")).first()["bound"]
        bound = max((b for b in (bound, closed) if b is not None), default=None)
        own = f"{state}/batch={number}"
        due = F.lit(False) if bound is None else F.col("ts") <= F.lit(bound)
        spark.createDataFrame([(bound,)], "closed timestamp").write.mode("overwrite").parquet(f"{own}/closed")
        rows.filter(~due).write.mode("overwrite").parquet(f"{own}/held")
        carried = spark.read.schema(STREAK).parquet(f"{before}/runs") if number > 0 else None
        marked = stage(_advanced(rows.filter(due), carried), "stream-runs")
        columns = ["endpoint_id", "failures", "first_ts", "last_ts"]
        marked.filter("open").select(columns).write.mode("overwrite").parquet(f"{own}/runs")
        level = alert_level(F.col("failures"), FAILURE_ALERT).alias("level")
        marked.filter("NOT open").select(*columns, level).write.mode("overwrite").parquet(f"{streaks}/batch={number}")
        unstage(rows)
        unstage(marked)
        if number > 1:
            delete(spark, f"{state}/batch={number - 2}")

    return (
        log.writeStream.foreachBatch(advance)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _advanced(rows: DataFrame, carried: DataFrame | None) -> DataFrame:
    """Runs over ``rows``, which the ``carried`` open runs precede; ``open`` if no success follows."""
    pieces = failure_islands(rows)
    if carried is not None:
        pieces = pieces.unionByName(carried.withColumn("island", F.lit(0).cast("bigint")))
    runs = pieces.groupBy("endpoint_id", "island").agg(
        F.sum("failures").alias("failures"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )
    successes = rows.groupBy("endpoint_id").agg(F.count_if(F.col("status") != "error").alias("successes"))
    return runs.join(successes, "endpoint_id", "left").withColumn("open", F.col("island") == F.coalesce("successes", F.lit(0)))


def all_failures(spark: SparkSession, streaks: str, state: str) -> DataFrame:
    """``endpoint_id, failures, first_ts, last_ts, level, open``: finished runs and, by the last state, the others."""
    columns = ["endpoint_id", "failures", "first_ts", "last_ts"]
    last = max((r["number"] for r in batches(spark, state)), default=None)
    done = spark.read.schema(f"{STREAK}, level string").parquet(streaks).select(*columns, "level")
    done = done.withColumn("open", F.lit(False))
    if last is None:
        return done
    held, runs = (spark.read.schema(s).parquet(f"{state}/batch={last}/{n}") for s, n in ((ENTRY, "held"), (STREAK, "runs")))
    rest = _advanced(stage(held, "held-entries"), runs)
    return done.unionByName(rest.select(*columns, alert_level(F.col("failures"), FAILURE_ALERT).alias("level"), "open"))


def batches(spark: SparkSession, state: str) -> list:
    """The numbers of the batches whose state is kept: the last two."""
    files = scan_files(spark, state, "part-*", recursive=True)
    number = F.regexp_extract("path", "/batch=([0-9]+)/", 1).cast("bigint").alias("number")
    return files.select(number).distinct().collect()
