"""Human evaluation: criteria, tasks, ratings and their analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.functions.stats import exact_median

LIKERT, BINARY = "likert", "binary"


def criterion(
    kind: str,
    name: str,
    description: str,
    min_value: float | None = None,
    max_value: float | None = None,
    options: list[str] | None = None,
    required: bool = True,
) -> Column:
    """A criterion as a constant struct column."""
    return F.struct(
        F.lit(kind).alias("type"),
        F.lit(name).alias("name"),
        F.lit(description).alias("description"),
        F.lit(min_value).cast("double").alias("min_value"),
        F.lit(max_value).cast("double").alias("max_value"),
        (F.array(*map(F.lit, options)) if options else F.lit(None))
        .cast("array<string>")
        .alias("options"),
        F.lit(required).alias("required"),
    )


def default_criteria(models: list[str]) -> Column:
    """Relevance, accuracy and fluency from 1 to 5, and the preferred model."""
    scales = [
        criterion(LIKERT, "relevance", "Does the response address the input?", 1, 5),
        criterion(LIKERT, "accuracy", "Is the response correct?", 1, 5),
        criterion(LIKERT, "fluency", "Is the response well written?", 1, 5),
    ]
    return F.array(
        *scales, criterion(BINARY, "preference", "Which response is better?", options=models)
    )


def review_tasks(
    examples: DataFrame, outputs: DataFrame, models: list[str], criteria: Column | None = None
) -> DataFrame:
    """``task_id, input_text, reference_output, model_outputs, more_outputs, evaluation_criteria``.

    ``examples`` has ``id, input, output`` and ``outputs`` has ``id, model, prediction``
    with one row per model; only ``models`` are taken. Were there several outputs of a
    model, the least is its output and ``more_outputs`` holds the others.
    """
    given = outputs.filter(F.col("model").isin(models) & F.col("prediction").isNotNull())
    pairs = F.sort_array(F.collect_list(F.struct("model", "prediction")))
    by_model = given.groupBy("id").agg(pairs.alias("pairs"))
    first = lambda pair, i: (i == 0) | (F.get("pairs", i - 1)["model"] != pair["model"])
    by_model = by_model.select(
        "id",
        F.map_from_entries(F.filter("pairs", first)).alias("model_outputs"),
        F.filter("pairs", lambda pair, i: ~first(pair, i)).alias("more_outputs"),
    )
    return examples.join(by_model, "id").select(
        F.col("id").alias("task_id"),
        F.col("input").alias("input_text"),
        F.col("output").alias("reference_output"),
        "model_outputs",
        "more_outputs",
        (default_criteria(models) if criteria is None else criteria).alias("evaluation_criteria"),
    )


def explode_ratings(evaluations: DataFrame) -> DataFrame:
    """``ratings map<model, map<criterion, value>>`` to one row per rating."""
    kept = [c for c in evaluations.columns if c not in ("ratings", "comments")]
    per_model = evaluations.select(*kept, F.explode("ratings").alias("model", "scores"))
    return per_model.select(*kept, "model", F.explode("scores").alias("criterion", "value"))


def rating_stats(ratings: DataFrame) -> DataFrame:
    """``model, criterion, count, mean, median, std`` of long ratings; the median is exact on any scale."""
    keys = ["model", "criterion"]
    measured = ratings.groupBy(*keys).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"),
    )
    medians = exact_median(ratings, "value", keys)
    return measured.join(medians, keys, "left").select(*keys, "count", "mean", "median", "std")


def rating_overall(stats: DataFrame) -> DataFrame:
    """``model, overall``: the mean of a model's criterion means."""
    return stats.groupBy("model").agg(F.avg("mean").alias("overall"))


def preferences(evaluations: DataFrame) -> DataFrame:
    """``preference, count``."""
    stated = evaluations.filter(F.col("preference").isNotNull())
    return stated.groupBy("preference").agg(F.count(F.lit(1)).alias("count"))


def rating_violations(evaluations: DataFrame, tasks: DataFrame) -> DataFrame:
    """``evaluation_id, model, criterion, problem`` for ratings that break their task's rules.

    Problems: ``missing`` (required, not rated), ``out_of_bounds`` (scale),
    ``not_an_option`` (choice). A scale is rated for each model of the task, a choice
    once per evaluation. Task and evaluation are joined once and then checked in the row.
    """
    joined = evaluations.join(
        tasks.select("task_id", "model_outputs", "evaluation_criteria"), "task_id"
    )

    def finding(model: Column, name: Column, problem: Column) -> Column:
        return F.struct(
            model.alias("model"), name.alias("criterion"), problem.alias("problem")
        )

    def scale_problem(rule: Column, value: Column) -> Column:
        outside = (value < rule["min_value"]) | (value > rule["max_value"])
        return F.when(value.isNull() & rule["required"], "missing").when(outside, "out_of_bounds")

    def choice_problem(rule: Column, value: Column) -> Column:
        return F.when(value.isNull() & rule["required"], "missing").when(
            ~F.array_contains(rule["options"], value), "not_an_option"
        )

    rules = F.col("evaluation_criteria")
    scales = F.filter(rules, lambda r: r["type"] == LIKERT)
    choices = F.filter(rules, lambda r: r["type"] == BINARY)
    per_model = F.flatten(
        F.transform(
            F.map_keys("model_outputs"),
            lambda m: F.transform(
                scales,
                lambda r: finding(
                    m, r["name"], scale_problem(r, F.try_element_at("ratings", m)[r["name"]])
                ),
            ),
        )
    )
    once = F.transform(
        choices,
        lambda r: finding(
            F.lit(None).cast("string"), r["name"], choice_problem(r, F.col("preference"))
        ),
    )
    found = F.filter(F.concat(per_model, once), lambda f: f["problem"].isNotNull())
    return joined.select("evaluation_id", F.inline(found))
