"""Analysis of finished tuning trials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.operators.ordered import running


def explode_history(states: DataFrame) -> DataFrame:
    """Trainer states to ``trial, best_metric, step, eval_loss``; empty histories keep a row."""
    return states.select(
        "trial", "best_metric", F.explode_outer("log_history").alias("entry")
    ).select("trial", "best_metric", "entry.step", "entry.eval_loss")


def trial_metric(history: DataFrame) -> DataFrame:
    """``trial, metric``: the best metric, else the least loss, else infinity."""
    return history.groupBy("trial").agg(
        F.coalesce(
            F.min("best_metric"), F.min("eval_loss"), F.lit(float("inf"))
        ).alias("metric")
    )


def best_trial(metrics: DataFrame) -> DataFrame:
    """The trial with the least metric; the smaller number wins a tie."""
    best = F.min_by(F.struct("trial", "metric"), F.struct("metric", "trial"))
    return metrics.agg(best.alias("best")).select("best.*")


def running_best(metrics: DataFrame) -> DataFrame:
    """``trial, metric, best_so_far`` in the order of trials."""
    return running(metrics, "metric", "min", "best_so_far", ["trial"])


def trial_params(metrics: DataFrame, trials: DataFrame) -> DataFrame:
    """One row per trial: its parameters (struct ``params``) as columns, and the metric."""
    return trials.join(metrics, "trial").select("trial", "params.*", "metric")


def training_schedule(examples: DataFrame, configs: list[dict]) -> DataFrame:
    """Steps and warm-up steps of each training configuration for these examples.

    A configuration has ``batch_size, accumulation, epochs`` and ``warmup_ratio``.
    """

    def plan(config: dict) -> Column:
        per_step = config["batch_size"] * config["accumulation"]
        steps = F.floor(F.col("examples") / per_step) * config["epochs"]
        return F.struct(
            *(F.lit(config[k]).alias(k) for k in ("batch_size", "accumulation", "epochs")),
            F.lit(float(config["warmup_ratio"])).alias("warmup_ratio"),
            steps.alias("steps"),
            F.floor(steps * float(config["warmup_ratio"])).alias("warmup_steps"),
        )

    counted = examples.agg(F.count(F.lit(1)).alias("examples"))
    return counted.select("examples", F.inline(F.array(*map(plan, configs))))
