import json
import statistics

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sparkprep.functions.stats import basic_stats
from sparkprep.operators import quality as Q
from sparkprep.sources.jsonl import read_splits

ROWS = [
    ("train", "What is one?", "One is a number."),
    ("train", "What about two, please?", "Two follows."),
    ("val", "And three?", "Three follows two, I think."),
    ("test", "What is one?", "One is a number."),
]


def split_rows(spark, rows=ROWS):
    return spark.createDataFrame(rows, "split string, input_text string, output_text string")


def stats_of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    return df.agg(*(c.alias(n) for n, c in basic_stats("v").items())).first().asDict()


def test_basic_stats(spark):
    assert set(stats_of(spark, []).values()) == {0}
    five = stats_of(spark, [1, 2, 3, 4, 5])
    assert (five["count"], five["min"], five["max"], five["mean"], five["median"]) == (5, 1, 5, 3, 3)
    assert five["std"] == pytest.approx(statistics.stdev([1, 2, 3, 4, 5]))
    assert stats_of(spark, [7])["std"] == 0


def test_metrics_from_first_principles(spark):
    stats = Q.length_stats(split_rows(spark))
    assert stats.count() == 6
    row = Q.quality_metrics(stats).first()
    lengths = {}
    for split, a, b in ROWS:
        lengths.setdefault(split, []).append((len(a), len(b)))
    mean_in = statistics.mean(statistics.mean(a for a, _ in v) for v in lengths.values())
    mean_out = statistics.mean(statistics.mean(b for _, b in v) for v in lengths.values())
    assert row.input_output_ratio == pytest.approx(mean_out / mean_in)
    assert row.split_balance == pytest.approx(1.5 / 1.584962500721156)
    stds = [statistics.stdev(x) if len(x) > 1 else 0 for v in lengths.values() for x in zip(*v)]
    assert row.length_variability == pytest.approx(statistics.mean(stds) / 100)
    expected = 0.3 * min(row.input_output_ratio, 1) + 0.3 * row.split_balance + 0.4 * row.length_variability
    assert row.overall_quality == pytest.approx(expected)


def test_one_split_and_none(spark):
    one = Q.quality_metrics(Q.length_stats(split_rows(spark, ROWS[:2]))).first()
    assert one.split_balance == 0
    none = Q.quality_metrics(Q.length_stats(split_rows(spark, []))).first()
    assert list(none) == [0, 0, 0, 0]


def test_rows_without_a_field_are_not_measured(spark):
    rows = split_rows(spark, ROWS + [("train", None, "x"), ("train", "x", None)])
    assert Q.length_stats(rows).exceptAll(Q.length_stats(split_rows(spark))).count() == 0


def test_ratings(spark):
    df = spark.createDataFrame([(0.9,), (0.6,), (0.3,), (0.8,), (0.5,)], "v double")
    found = [r[0] for r in df.select(Q.rating(F.col("v"), 0.5, 0.8)).collect()]
    assert found == ["good", "medium", "poor", "good", "medium"]
    rated = Q.quality_ratings(Q.quality_metrics(Q.length_stats(split_rows(spark)))).collect()
    assert [r.metric for r in rated] == list(Q.RATING_THRESHOLDS)
    assert all(r.label == r.rating.capitalize() and r.formatted == f"{r.value:.2f}" for r in rated)


def test_report_and_pivot(spark):
    report = json.loads(Q.quality_report(split_rows(spark)).first().report)
    assert len(report["stats"]) == 6 and set(report["metrics"]) == set(Q.RATING_THRESHOLDS)
    wide = Q.length_pivot(Q.length_stats(split_rows(spark)))
    assert wide.count() == 3 and "input_length_mean" in wide.columns


def test_summary_has_totals(spark):
    rows = {(r.split, r.field): r for r in Q.dataset_summary(split_rows(spark)).collect()}
    assert rows["total", "input_length"]["count"] == 4 and rows["train", "output_length"]["count"] == 2


def test_missing_directory_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_splits(spark, str(tmp_path / "absent"))
