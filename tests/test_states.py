import random
from datetime import datetime, timedelta

import pytest

from sparkprep.operators import sketches, states
from sparkprep.operators.monitoring import prediction_metrics

START = datetime(2024, 1, 1)
KIND = "event_id bigint, ts timestamp, latency double"


def entries(seed, count=400):
    draw = random.Random(seed)
    values = [lambda: draw.uniform(0, 3), lambda: draw.choice([1.0, 1.03, 1.05, -2.0]), lambda: None, lambda: draw.expovariate(0.01)]
    return [(i, draw.choice([START + timedelta(minutes=draw.randrange(6 * 24 * 60))] * 30 + [None, START + timedelta(days=3)]), draw.choice(values)()) for i in range(count)]


RANGES = [(None, None), ("2024-01-02", "2024-01-05"), ("2024-01-02 07:30:00", "2024-01-02 19:00:00"), ("2024-01-01 12:00:00", None), (None, "2024-01-04"), ("2025-01-01", "2025-02-01")]


@pytest.mark.parametrize("seed", range(2))
def test_states_give_the_metrics_of_the_entries(spark, tmp_path, seed):
    rows, path = entries(seed), str(tmp_path / "s")
    log = spark.createDataFrame(rows, KIND).filter("ts IS NOT NULL").repartition(3)
    for batch in (0, 1, 1):  # the second is written again
        states.write_states(log.filter(f"event_id % 2 = {batch}"), "latency", path, batch)
    for start, end in RANGES:
        want = prediction_metrics(log, start, end).first().asDict()
        got = states.metrics_from_states(spark, path, "prediction", start, end).first().asDict()
        assert got == pytest.approx(want), (start, end)


def test_one_value_and_nothing(spark, tmp_path):
    one = spark.createDataFrame([(1, START, 0.5), (2, START, None)], KIND)
    states.write_states(one, "latency", str(tmp_path / "one"))
    assert tuple(states.metrics_from_states(spark, str(tmp_path / "one"), "p").first()) == (2, 0.5, 0.5, 0.5, 0.5)
    states.write_states(one.limit(0), "latency", str(tmp_path / "none"))
    assert tuple(states.metrics_from_states(spark, str(tmp_path / "none"), "p").first()) == (0, 0.0, 0.0, 0.0, 0.0)


def test_whole_windows_read_no_values_but_those_of_a_bucket(spark, tmp_path):
    path = str(tmp_path / "s")
    states.write_states(spark.createDataFrame(entries(5), KIND), "latency", path)
    rows = spark.read.schema(states.VALUE).parquet(f"{path}/values").filter("window >= 1704153600 AND bucket IN (3)")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window" in plan and "EqualTo(bucket,3)" in plan


def test_merged_sketches_are_within_their_error(spark):
    rows = spark.range(60_000).selectExpr("concat('part', id % 4) AS split", "concat('text', id % 23000) AS input_text")
    stored = sketches.distinct_sketches(rows.unionByName(spark.sql("SELECT 'part0' AS split, cast(null as string) AS input_text")), ["split"])
    for split, exact in [(None, 23_000), ("part1", 5_750 * 2 if 23_000 % 4 else 5_750)]:
        chosen = stored if split is None else stored.filter(f"split = '{split}'")
        found = sketches.merged_counts(chosen, []).first()
        assert abs(found.estimate - exact) <= sketches.ERROR * exact + 1
    assert sketches.merged_counts(stored, ["split"]).agg({"rows": "sum"}).first()[0] == 60_001
