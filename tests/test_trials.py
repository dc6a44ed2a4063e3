from pyspark.sql import functions as F

from sparkprep.operators import trials as T
from sparkprep.sources.jsonl import read_trainer_states


def test_reads_states_and_picks_metrics(spark, tmp_path):
    states = {
        1: '{"best_metric": 0.5, "log_history": [{"step": 1, "eval_loss": 0.6}, {"step": 2, "eval_loss": 0.5}]}',
        2: '{"log_history": [{"step": 1, "loss": 3}, {"step": 2, "eval_loss": 0.7}, {"step": 3, "eval_loss": 0.4}]}',
        3: '{"log_history": []}',
        4: "{}",
    }
    for trial, text in states.items():
        folder = tmp_path / f"trial_{trial}" / "model"
        folder.mkdir(parents=True)
        (folder / "trainer_state.json").write_text(text.replace(", ", ",\n"))
    history = T.explode_history(read_trainer_states(spark, str(tmp_path)))
    metrics = T.trial_metric(history)
    assert {r.trial: r.metric for r in metrics.collect()} == {1: 0.5, 2: 0.4, 3: float("inf"), 4: float("inf")}
    assert tuple(T.best_trial(metrics).first()) == (2, 0.4)
    best = [r.best_so_far for r in T.running_best(metrics).orderBy("trial").collect()]
    assert best == [0.5, 0.4, 0.4, 0.4]


def test_ties_and_parameters(spark):
    metrics = spark.createDataFrame([(2, 0.1), (1, 0.1), (3, 0.5)], "trial bigint, metric double")
    assert T.best_trial(metrics).first().trial == 1
    params = spark.range(1, 4).select(F.col("id").alias("trial"), F.struct((F.col("id") * 8).alias("batch_size")).alias("params"))
    assert {r.trial: r.batch_size for r in T.trial_params(metrics, params).collect()} == {1: 8, 2: 16, 3: 24}


def test_schedule(spark):
    config = {"batch_size": 8, "accumulation": 4, "epochs": 3, "warmup_ratio": 0.1}
    row = T.training_schedule(spark.range(1000), [config]).first()
    assert row.steps == 1000 // 32 * 3 and row.warmup_steps == int(row.steps * 0.1)
