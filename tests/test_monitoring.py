import statistics
from datetime import datetime, timedelta
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from sparkprep.functions.stats import exact_median
from sparkprep.operators import monitoring as M
from sparkprep.operators.ordered import running

START = datetime(2024, 1, 1)


def log(spark, rows=3000):
    """A log of which one endpoint has most entries, with failures in bursts."""
    i = F.col("id")
    return spark.range(rows).select(
        i.alias("event_id"),
        (F.lit(START) + F.make_dt_interval(secs=(i / 3).cast("int"))).alias("ts"),
        F.lit("m").alias("model_id"),
        F.when(i % 3 == 0, F.concat(F.lit("ep"), (i % 7).cast("string"))).otherwise("busy").alias("endpoint_id"),
        ((i * 7919) % 101 / 10).alias("latency"),
        F.when((i / 5).cast("int") % 4 == 0, "error").otherwise("success").alias("status"),
    )


def test_median_with_ties_groups_and_skew(spark):
    i = F.col("id")
    df = spark.range(5001).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (i % 50).cast("string"))).alias("g"),
        F.when(i % 3 == 0, 1.5).otherwise((i * 31 % 977) / 7).alias("v"),
    )
    values = {}
    for r in df.collect():
        values.setdefault(r.g, []).append(r.v)
    found = {r.g: r["median"] for r in exact_median(df, "v", ["g"]).collect()}
    assert found == {g: statistics.median(v) for g, v in values.items()}
    everything = [v for vs in values.values() for v in vs]
    assert exact_median(df, "v").first()["median"] == statistics.median(everything)


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [None, 5.0], [2.0] * 9 + [7.0], [-1e308, 1e308, 5.0, 1e-300, 0.0], [float("-inf"), 1.0, float("inf")]])
def test_median_of_few(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_median(df, "v").first()["median"] == statistics.median([v for v in values if v is not None])


def test_median_of_none(spark):
    assert exact_median(spark.createDataFrame([], "v double"), "v").count() == 0


def test_running_equals_a_window(spark):
    df = log(spark).select("endpoint_id", "ts", "event_id", F.col("latency").alias("v"))
    rows = sorted(df.collect(), key=lambda r: (r.endpoint_id, r.ts, r.event_id))
    expected = {}
    for _, group in groupby(rows, key=lambda r: r.endpoint_id):
        least = float("inf")
        for r in group:
            least = expected[r.event_id] = min(least, r.v)
    found = running(df, "v", "min", "least", ["ts", "event_id"], ["endpoint_id"])
    assert {r.event_id: r.least for r in found.collect()} == expected


def expected_streaks(rows):
    found = set()
    rows = sorted(rows, key=lambda r: (r.endpoint_id, r.ts, r.event_id))
    for endpoint, group in groupby(rows, key=lambda r: r.endpoint_id):
        for status, run in groupby(group, key=lambda r: r.status):
            if status == "error":
                run = list(run)
                level = "critical" if len(run) >= 3 else "warning"
                found.add((endpoint, run[0].ts, run[-1].ts, len(run), level))
    return found


def test_failure_streaks(spark):
    entries = log(spark)
    found = M.failure_streaks(entries)
    assert {tuple(r) for r in found.collect()} == expected_streaks(entries.collect())


def test_window_metrics_and_empty_window(spark):
    entries = log(spark)
    row = M.prediction_metrics(entries).first()
    values = [r.latency for r in entries.collect()]
    assert row.prediction_count == len(values) and row.median == statistics.median(values)
    assert (row.min, row.max) == (min(values), max(values)) and row["mean"] == pytest.approx(statistics.mean(values))
    later = START + timedelta(days=99)
    empty = M.prediction_metrics(entries, later).first()
    assert set(empty.asDict().values()) == {0}


def test_feedback_without_score_counts(spark):
    df = spark.createDataFrame([(START, 1.0), (START, None)], "ts timestamp, score double")
    row = M.feedback_metrics(df).first()
    assert row.feedback_count == 2 and row["mean"] == row["median"] == 1.0


def test_log_query_limits_and_orders(spark):
    entries = log(spark)
    end = START + timedelta(seconds=500)
    rows = M.prediction_logs(entries, "m", "busy", START, end, 7).collect()
    assert len(rows) == 7 and rows[0].ts == end
    assert [(-r.ts.timestamp(), r.event_id) for r in rows] == sorted((-r.ts.timestamp(), r.event_id) for r in rows)
    plan = M.prediction_logs(entries, "m", "busy")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_entry_points_and_alerts(spark):
    requests = spark.createDataFrame([(1, START, START + timedelta(milliseconds=1500), None), (2, START, START, "boom")], "id int, a timestamp, b timestamp, e string")
    lit = F.lit
    entries = M.prediction_log(requests, F.col("id"), F.col("b"), lit("m"), lit("e"), M.latency_seconds(F.col("a"), F.col("b")), F.col("e"), lit("{}"), lit("{}"))
    rows = {r.event_id: r for r in entries.collect()}
    assert rows[1].latency == 1.5 and (rows[1].severity, rows[2].severity) == ("INFO", "ERROR")
    points = M.metric_points(entries).collect()
    assert len(points) == 4
    assert all((p.value_int is None) != (p.value_double is None) and p.value_bool is None for p in points)
    assert {p.status for p in points if p.metric == "model/m/prediction_count"} == {"success", "error"}
    own = M.value_points(entries, {"failed": F.col("status") == "error", "length": F.length("request"), "half": F.col("latency") / 2})
    kinds = {(p.metric, p.value_bool, p.value_int, p.value_double) for p in own.filter("ts > timestamp'2000-01-01'").collect()}
    assert ("model/m/failed", True, None, None) in kinds and ("model/m/length", None, 2, None) in kinds and ("model/m/half", None, None, 0.75) in kinds
    flag = spark.range(1).select(M.typed_value(lit(True), "boolean")).first()
    assert tuple(flag) == (True, None, None)
    levels = spark.createDataFrame([(0.04,), (0.05,), (0.1,), (None,)], "v double")
    found = [r[0] for r in levels.select(M.alert_level(F.col("v"), M.ERROR_RATE_ALERT)).collect()]
    assert found == ["ok", "warning", "critical", "ok"]


def test_flatten_keeps_positions(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x"])], "id int, inputs array<string>, predictions array<string>")
    assert [tuple(r) for r in M.flatten_predictions(df).collect()] == [(1, 0, "a", "x"), (1, 1, "b", None)]


def test_recent(spark):
    entries = log(spark)
    newest = max(r.ts for r in entries.collect())
    assert M.recent(entries, 5).agg(F.min("ts")).first()[0] > newest - timedelta(minutes=5)
