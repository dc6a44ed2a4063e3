"""Compare models by metrics, outputs and answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.functions.stats import MEASURES
from sparkprep.operators.metrics import TEXT_METRICS, text_metrics
from sparkprep.operators.quality import field_stats


def model_metrics(
    predictions: DataFrame, metrics: tuple[str, ...] = TEXT_METRICS, unicode: bool = True
) -> DataFrame:
    """``model, metric, value``."""
    return text_metrics(predictions, metrics, by=["model"], unicode=unicode)


def improvement_columns(baseline: Column, tuned: Column) -> tuple[Column, Column]:
    """(absolute, relative in %) improvement; relative is null on a zero baseline.

    Rounded to 10 digits, so that 0.7 - 0.5 is 0.2.
    """
    gain = tuned - baseline
    return F.round(gain, 10), F.round(F.try_divide(gain, baseline) * 100, 10)


def improvement(baseline: DataFrame, tuned: DataFrame) -> DataFrame:
    """``metric, absolute, relative`` of two ``metric, value`` tables."""
    absolute, relative = improvement_columns(F.col("b.value"), F.col("t.value"))
    return (
        baseline.alias("b")
        .join(tuned.alias("t"), "metric")
        .select("metric", absolute.alias("absolute"), relative.alias("relative"))
    )


def comparison_table(measured: DataFrame, baseline: str, tuned: str) -> DataFrame:
    """``metric``, both values and both improvements, from ``model, metric, value``."""
    wide = measured.groupBy("metric").pivot("model", [baseline, tuned]).agg(F.first("value"))
    absolute, relative = improvement_columns(F.col(f"`{baseline}`"), F.col(f"`{tuned}`"))
    return wide.select(
        "metric",
        F.col(f"`{baseline}`").alias("baseline"),
        F.col(f"`{tuned}`").alias("tuned"),
        absolute.alias("absolute_improvement"),
        relative.alias("relative_improvement"),
    )


def align_outputs(
    baseline: DataFrame, tuned: DataFrame, reference: DataFrame, row_id: str = "id"
) -> DataFrame:
    """Join three ``id, text`` tables to ``id, baseline, tuned, reference``."""
    sides = {"baseline": baseline, "tuned": tuned, "reference": reference}
    named = [df.select(row_id, F.col("text").alias(name)) for name, df in sides.items()]
    return named[0].join(named[1], row_id).join(named[2], row_id)


def compare_outputs(aligned: DataFrame) -> DataFrame:
    """``model, mean_length, median_length, min_length, max_length, reference_match,
    reference_match_percentage, exact_match, exact_match_percentage``.

    ``aligned`` has ``baseline, tuned, reference``. Exact match counts rows where both
    models agree; lengths are in characters.
    """

    def percent(count: Column) -> Column:
        return F.coalesce(F.try_divide(count, F.count(F.lit(1))) * 100, F.lit(0.0))

    def summary(model: str) -> Column:
        length = F.length(model)
        matches = F.count_if(F.col(model) == F.col("reference"))
        agreed = F.count_if(F.col("baseline") == F.col("tuned"))
        return F.struct(
            F.lit(model).alias("model"),
            F.avg(length).alias("mean_length"),
            F.median(length).alias("median_length"),
            F.min(length).alias("min_length"),
            F.max(length).alias("max_length"),
            matches.alias("reference_match"),
            percent(matches).alias("reference_match_percentage"),
            agreed.alias("exact_match"),
            percent(agreed).alias("exact_match_percentage"),
        )

    both = aligned.agg(F.array(summary("baseline"), summary("tuned")).alias("models"))
    return both.select(F.inline("models"))


def answers_by_model(answers: DataFrame, models: list[str]) -> DataFrame:
    """One row per ``id, question`` with a column of answers per model.

    An id has one answer per model; were there several, the least would be shown.
    """
    return answers.groupBy("id", "question").pivot("model", models).agg(F.min("answer"))


def example_predictions(predictions: DataFrame, count: int = 5, row_id: str = "id") -> DataFrame:
    """The first rows by id, for a report."""
    return predictions.orderBy(row_id).limit(count)


def prediction_stats(predictions: DataFrame) -> DataFrame:
    """``field, count, min, …, std`` of input, output and prediction length."""
    fields = ("input_length", "output_length", "prediction_length")
    lengths = predictions.select(
        *(F.length(f.removesuffix("_length")).alias(f) for f in fields)
    )
    return field_stats(lengths.groupBy(), fields, [])


def evaluation_summary(
    predictions: DataFrame,
    metrics: DataFrame,
    comparison: DataFrame | None = None,
    human_overall: DataFrame | None = None,
) -> DataFrame:
    """``section, name, measure, value``: everything a report shows, in one table."""

    def part(df: DataFrame, section: str, name: str, measure: Column, value: str) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"),
            F.col(name).alias("name"),
            measure.alias("measure"),
            F.col(value).cast("double").alias("value"),
        )

    stats = prediction_stats(predictions).unpivot(
        "field", [F.col(m).cast("double").alias(m) for m in MEASURES], "measure", "value"
    )
    result = part(metrics, "metrics", "metric", F.lit("value"), "value").unionByName(
        part(stats, "prediction_stats", "field", F.col("measure"), "value")
    )
    if comparison is not None:
        gains = comparison.unpivot(
            "metric", ["absolute_improvement", "relative_improvement"], "measure", "value"
        )
        result = result.unionByName(
            part(gains, "improvement", "metric", F.col("measure"), "value")
        )
    if human_overall is not None:
        result = result.unionByName(
            part(human_overall, "human_evaluation", "model", F.lit("overall"), "overall")
        )
    return result
