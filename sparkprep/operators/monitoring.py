"""Prediction and feedback logs: entries, metric points, windows, alerts.

A log has ``ts, model_id, endpoint_id, request, response, latency, error, severity,
status`` and an ``event_id`` that orders entries of the same time. Everything that is
not an ordered read works on streams as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkprep.functions.stats import exact_median
from sparkprep.operators.ordered import running

# Fixed values: (warning, critical) thresholds of the alerts.
ERROR_RATE_ALERT = (0.05, 0.10)
RUN_TIME_ALERT = (0.5, 1.0)
USAGE_ALERT = (0.8, 0.9)
FAILURE_ALERT = (1, 3)


def latency_seconds(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 1_000_000


def prediction_log(
    requests: DataFrame,
    event_id: Column,
    ts: Column,
    model_id: Column,
    endpoint_id: Column,
    latency: Column,
    error: Column,
    request: Column,
    response: Column,
) -> DataFrame:
    """Log entries of served requests; an error makes severity ``ERROR``."""
    failed = error.isNotNull()
    return requests.select(
        event_id.alias("event_id"),
        ts.alias("ts"),
        model_id.alias("model_id"),
        endpoint_id.alias("endpoint_id"),
        request.alias("request"),
        response.alias("response"),
        latency.alias("latency"),
        error.alias("error"),
        F.when(failed, "ERROR").otherwise("INFO").alias("severity"),
        F.when(failed, "error").otherwise("success").alias("status"),
    )


VALUE_TYPES = {"value_bool": "boolean", "value_int": "bigint", "value_double": "double"}


def typed_value(value: Column, data_type: str) -> list[Column]:
    """``value_bool, value_int, value_double``; the one of ``data_type`` is set."""
    if data_type not in VALUE_TYPES.values():
        raise ValueError(f"data_type is one of {list(VALUE_TYPES.values())}")
    return [
        (value if kind == data_type else F.lit(None)).cast(kind).alias(name)
        for name, kind in VALUE_TYPES.items()
    ]


def _points(
    entries: DataFrame, points: list[tuple[str, Column, str, Column | None]]
) -> DataFrame:
    """One row per entry and (metric, value, type, status); points without value are left out."""
    rows = F.array(
        *(
            F.struct(
                F.concat(F.lit("model/"), "model_id", F.lit(f"/{name}")).alias("metric"),
                (F.lit(None).cast("string") if status is None else status).alias("status"),
                *typed_value(value, data_type),
            )
            for name, value, data_type, status in points
        )
    )
    has_value = F.col("value_bool").isNotNull() | F.coalesce("value_int", "value_double").isNotNull()
    return entries.select("ts", "endpoint_id", F.inline(rows)).filter(has_value)


def value_points(entries: DataFrame, values: dict[str, Column]) -> DataFrame:
    """A point for each entry and named value that is not null; the value's own type says which column is set."""
    kinds = {"boolean": "boolean", "tinyint": "bigint", "smallint": "bigint", "int": "bigint", "bigint": "bigint"}
    types = dict(entries.select(*(v.alias(n) for n, v in values.items())).dtypes)
    return _points(entries, [(n, v, kinds.get(types[n], "double"), None) for n, v in values.items()])


def metric_points(log: DataFrame) -> DataFrame:
    """A count point with the status and a latency point for each log entry."""
    return _points(
        log,
        [
            ("prediction_count", F.lit(1), "bigint", F.col("status")),
            ("prediction_latency", F.col("latency"), "double", None),
        ],
    )


def feedback_points(feedback: DataFrame) -> DataFrame:
    """A count point for each feedback and a score point where there is a score."""
    return _points(
        feedback,
        [
            ("feedback_count", F.lit(1), "bigint", None),
            ("feedback_score", F.col("score"), "double", None),
        ],
    )


def between(log: DataFrame, start=None, end=None, inclusive_end: bool = True) -> DataFrame:
    """Entries from ``start`` to ``end``; the filter reaches the scan."""
    if start is not None:
        log = log.filter(F.col("ts") >= F.lit(start))
    if end is not None:
        log = log.filter(F.col("ts") <= F.lit(end) if inclusive_end else F.col("ts") < F.lit(end))
    return log


def recent(log: DataFrame, minutes: int = 30) -> DataFrame:
    """Entries of the last minutes, counted back from the newest entry.

    The bound is computed first, from the time column alone, so it reaches the scan.
    """
    newest = log.agg((F.max("ts") - F.expr(f"INTERVAL {minutes} MINUTES")).alias("bound")).first()["bound"]
    return log.filter(F.lit(False) if newest is None else F.col("ts") > F.lit(newest))


def _window_metrics(entries: DataFrame, value: str, prefix: str) -> DataFrame:
    measured = entries.agg(
        F.count(F.lit(1)).alias(f"{prefix}_count"),
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
        F.coalesce(F.min(value), F.lit(0.0)).alias("min"),
        F.coalesce(F.max(value), F.lit(0.0)).alias("max"),
    )
    middle = exact_median(entries, value).agg(F.coalesce(F.max("median"), F.lit(0.0)))
    return measured.withColumn("median", middle.scalar())


def prediction_metrics(log: DataFrame, start=None, end=None) -> DataFrame:
    """One row: ``prediction_count`` and latency ``mean, median, min, max`` (0 if empty)."""
    return _window_metrics(between(log, start, end), "latency", "prediction")


def feedback_metrics(feedback: DataFrame, start=None, end=None) -> DataFrame:
    """One row: ``feedback_count`` and ``mean, median, min, max`` of the scores given."""
    return _window_metrics(between(feedback, start, end), "score", "feedback")


def prediction_logs(
    log: DataFrame, model_id: str, endpoint_id: str, start=None, end=None, limit: int = 100
) -> DataFrame:
    """The newest entries of one model and endpoint; both time bounds are inclusive."""
    chosen = between(log, start, end).filter(
        (F.col("model_id") == model_id) & (F.col("endpoint_id") == endpoint_id)
    )
    return chosen.orderBy(F.col("ts").desc(), F.col("event_id")).limit(limit)


def metrics_by_status(log: DataFrame) -> DataFrame:
    """Count and latency by model, endpoint and status."""
    return log.groupBy("model_id", "endpoint_id", "status").agg(
        F.count(F.lit(1)).alias("prediction_count"),
        F.avg("latency").alias("mean"),
        F.min("latency").alias("min"),
        F.max("latency").alias("max"),
    )


def flatten_predictions(batches: DataFrame) -> DataFrame:
    """Pair each input of a request with its prediction; ``position`` counts from 0.

    ``batches`` has the arrays ``inputs`` and ``predictions``; a missing partner is null.
    """
    kept = [c for c in batches.columns if c not in ("inputs", "predictions")]
    pairs = F.posexplode(F.arrays_zip("inputs", "predictions")).alias("position", "pair")
    return batches.select(*kept, pairs).select(
        *kept,
        "position",
        F.col("pair.inputs").alias("input"),
        F.col("pair.predictions").alias("prediction"),
    )


def alert_level(value: Column, thresholds: tuple[float, float]) -> Column:
    """``critical``, ``warning`` or ``ok``; unknown values are ``ok``."""
    warning, critical = thresholds
    return F.when(value >= critical, "critical").when(value >= warning, "warning").otherwise("ok")


def alerts(log: DataFrame, window: str = "1 day") -> DataFrame:
    """Error rate, run-time change and usage per endpoint and window, with alert levels.

    The run-time change compares a window with the one before it. ``usage`` is a column
    of the log with values in [0, 1].
    """
    per_window = (
        log.groupBy("endpoint_id", F.window("ts", window).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(F.col("status") == "error").alias("errors"),
            F.avg("latency").alias("mean_latency"),
            F.avg("usage").alias("usage"),
        )
        .withColumn("error_rate", F.col("errors") / F.col("requests"))
    )
    # After the aggregation an endpoint has one row per window, so this stays small.
    before = F.lag("mean_latency").over(Window.partitionBy("endpoint_id").orderBy("w.start"))
    return per_window.withColumn(
        "run_time_change", F.try_divide(F.col("mean_latency") - before, before)
    ).select(
        "endpoint_id",
        F.col("w.start").alias("window_start"),
        "requests",
        "error_rate",
        alert_level(F.col("error_rate"), ERROR_RATE_ALERT).alias("error_alert"),
        "run_time_change",
        alert_level(F.col("run_time_change"), RUN_TIME_ALERT).alias("run_time_alert"),
        "usage",
        alert_level(F.col("usage"), USAGE_ALERT).alias("usage_alert"),
    )


def failure_islands(log: DataFrame) -> DataFrame:
    """``endpoint_id, island, failures, first_ts, last_ts`` of consecutive failures.

    ``island`` is the number of successes of the endpoint before the failures.
    """
    marked = log.select(
        "endpoint_id", "ts", "event_id", (F.col("status") != "error").cast("bigint").alias("ok")
    )
    counted = running(marked, "ok", "sum", "island", ["ts", "event_id"], ["endpoint_id"])
    return (
        counted.filter(F.col("ok") == 0)
        .groupBy("endpoint_id", "island")
        .agg(
            F.count(F.lit(1)).alias("failures"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )


def failure_streaks(log: DataFrame) -> DataFrame:
    """Runs of failures per endpoint; three or more in a row are critical."""
    return failure_islands(log).select(
        "endpoint_id",
        "first_ts",
        "last_ts",
        "failures",
        alert_level(F.col("failures"), FAILURE_ALERT).alias("level"),
    )


def run_rates(runs: DataFrame) -> DataFrame:
    """Runs, success and failure rate and mean run time per ``step``.

    ``runs`` has ``step, succeeded`` and ``run_time``.
    """
    share = F.avg(F.col("succeeded").cast("double"))
    return runs.groupBy("step").agg(
        F.count(F.lit(1)).alias("runs"),
        share.alias("success_rate"),
        (1 - share).alias("failure_rate"),
        F.avg("run_time").alias("mean_run_time"),
    )
