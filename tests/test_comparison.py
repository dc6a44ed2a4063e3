import pytest
from pyspark.sql import functions as F

from sparkprep.operators import comparison as C
from sparkprep.operators import review as R

BASE = ["rain falls mostly in the hills", "two ships left"]
GOOD = ["rain falls in the hills all winter", "two ships left the harbour at dawn"]


def metric_table(spark, values):
    return spark.createDataFrame(list(values.items()), "metric string, value double")


def test_improvement_is_exact(spark):
    base = metric_table(spark, {"rouge1": 0.5, "rouge2": 0.3, "rougeL": 0.4, "bleu": 0.2, "zero": 0.0})
    tuned = metric_table(spark, {"rouge1": 0.7, "rouge2": 0.5, "rougeL": 0.6, "bleu": 0.4, "zero": 0.1})
    found = {r.metric: (r.absolute, r.relative) for r in C.improvement(base, tuned).collect()}
    assert all(found[m][0] == 0.2 for m in ("rouge1", "rouge2", "rougeL", "bleu"))
    assert found["rouge1"][1] == 40.0 and found["rougeL"][1] == 50.0 and found["bleu"][1] == 100.0
    assert found["rouge2"][1] == pytest.approx(66.67, rel=1e-2)
    assert found["zero"] == (0.1, None)


def predictions(spark):
    values = [(i, f"q{i}", GOOD[i], m, texts[i]) for m, texts in (("baseline", BASE), ("fine-tuned", GOOD)) for i in (0, 1)]
    return spark.createDataFrame(values, "id int, input string, output string, model string, prediction string")


def test_model_metrics_and_table(spark):
    measured = C.model_metrics(predictions(spark))
    assert measured.count() == 8
    table = {r.metric: r for r in C.comparison_table(measured, "baseline", "fine-tuned").collect()}
    assert table["rouge1"].tuned == pytest.approx(1)
    assert table["rouge1"].absolute_improvement == pytest.approx(1 - table["rouge1"].baseline)


def test_outputs(spark):
    sides = [spark.createDataFrame(list(enumerate(t)), "id int, text string") for t in (BASE, GOOD, GOOD)]
    found = {r.model: r for r in C.compare_outputs(C.align_outputs(*sides)).collect()}
    assert found["baseline"].reference_match == 0 and found["baseline"].reference_match_percentage == 0.0
    assert found["tuned"].reference_match == 2 and found["tuned"].reference_match_percentage == 100.0
    assert found["tuned"].exact_match == 0 and found["tuned"].exact_match_percentage == 0.0
    lengths = sorted(map(len, BASE))
    assert (found["baseline"].min_length, found["baseline"].max_length) == tuple(lengths)
    assert found["baseline"].median_length == sum(lengths) / 2


def test_answers_and_examples(spark):
    answers = predictions(spark).select("id", F.lit("same question").alias("question"), "model", F.col("prediction").alias("answer"))
    wide = C.answers_by_model(answers, ["baseline", "fine-tuned"]).orderBy("id").collect()
    assert [tuple(r) for r in wide] == [(i, "same question", BASE[i], GOOD[i]) for i in (0, 1)]
    shown = C.example_predictions(predictions(spark).filter("model = 'baseline'"), 1).collect()
    assert [r.id for r in shown] == [0]


def test_no_output_of_a_model_is_lost(spark):
    examples = spark.createDataFrame([(1, "q", "o")], "id int, input string, output string")
    outputs = spark.createDataFrame([(1, "a", "y"), (1, "a", "x"), (1, "b", "z"), (1, "a", "x"), (1, "c", "w"), (1, "b", None)], "id int, model string, prediction string")
    row = R.review_tasks(examples, outputs, ["a", "b"]).first()
    assert row.model_outputs == {"a": "x", "b": "z"}
    assert [tuple(r) for r in row.more_outputs] == [("a", "x"), ("a", "y")]


def review(spark):
    examples = predictions(spark).filter("model = 'baseline'").select("id", "input", "output")
    models = ["baseline", "fine-tuned"]
    tasks = R.review_tasks(examples, predictions(spark).select("id", "model", "prediction"), models)
    evaluations = spark.createDataFrame(
        [
            ("e1", 0, {"baseline": {"accuracy": 3.0}, "fine-tuned": {"accuracy": 5.0}}, "fine-tuned"),
            ("e2", 1, {"baseline": {"accuracy": 4.0}, "fine-tuned": {"accuracy": 5.0}}, "fine-tuned"),
        ],
        "evaluation_id string, task_id int, ratings map<string,map<string,double>>, preference string",
    )
    return tasks, evaluations


def test_criteria_and_tasks(spark):
    tasks, _ = review(spark)
    row = tasks.orderBy("task_id").first()
    assert [c.name for c in row.evaluation_criteria] == ["relevance", "accuracy", "fluency", "preference"]
    assert row.model_outputs == {"baseline": BASE[0], "fine-tuned": GOOD[0]}
    likert, binary = spark.range(1).select(
        R.criterion("likert", "accuracy", "How accurate?", 1, 5),
        R.criterion("binary", "preference", "Which?", options=["a", "b"]),
    ).first()
    assert (likert.type, likert.min_value, likert.max_value, likert.options, likert.required) == ("likert", 1, 5, None, True)
    assert (binary.type, binary.options, binary.required) == ("binary", ["a", "b"], True)


def test_rating_analysis(spark):
    _, evaluations = review(spark)
    stats = R.rating_stats(R.explode_ratings(evaluations))
    found = {r.model: r for r in stats.collect()}
    assert found["baseline"].mean == 3.5 and found["baseline"].median == 3.5
    assert found["baseline"].std == pytest.approx(0.5**0.5) and found["fine-tuned"].std == 0
    assert {r.model: r.overall for r in R.rating_overall(stats).collect()} == {"baseline": 3.5, "fine-tuned": 5.0}
    assert [tuple(r) for r in R.preferences(evaluations).collect()] == [("fine-tuned", 2)]


def test_violations(spark):
    tasks, evaluations = review(spark)
    broken = spark.createDataFrame(
        [("e3", 0, {"baseline": {"relevance": 1.0, "accuracy": 9.0, "fluency": 5.0}}, "other")], evaluations.schema
    )
    rows = R.rating_violations(broken, tasks).collect()
    found = {tuple(r)[1:] for r in rows if r.model != "fine-tuned"}
    assert found == {
        ("baseline", "accuracy", "out_of_bounds"),
        (None, "preference", "not_an_option"),
    }
    missing = R.rating_violations(broken, tasks).filter("model = 'fine-tuned' AND problem = 'missing'")
    assert missing.count() == 3


def test_summary(spark):
    tasks, evaluations = review(spark)
    measured = C.model_metrics(predictions(spark))
    tuned = predictions(spark).filter("model = 'fine-tuned'")
    summary = C.evaluation_summary(
        tuned,
        measured.filter("model = 'fine-tuned'").select("metric", "value"),
        C.comparison_table(measured, "baseline", "fine-tuned"),
        R.rating_overall(R.rating_stats(R.explode_ratings(evaluations))),
    )
    found = {(r.section, r.name, r.measure): r.value for r in summary.collect()}
    assert found["prediction_stats", "prediction_length", "count"] == 2
    assert found["human_evaluation", "fine-tuned", "overall"] == 5
    assert {s for s, _, _ in found} == {"metrics", "prediction_stats", "improvement", "human_evaluation"}
