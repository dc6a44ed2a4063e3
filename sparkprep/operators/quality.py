"""Length statistics and quality metrics of split training data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.functions.stats import MEASURES, basic_stats

FIELDS = ("input_length", "output_length")

# Weights of the overall score.
RATIO_WEIGHT, BALANCE_WEIGHT, VARIABILITY_WEIGHT = 0.3, 0.3, 0.4

# Fixed values: (medium, good) thresholds of the ratings.
RATING_THRESHOLDS = {
    "input_output_ratio": (0.5, 2.0),
    "split_balance": (0.7, 0.9),
    "length_variability": (0.3, 0.7),
    "overall_quality": (0.5, 0.8),
}


def with_lengths(examples: DataFrame) -> DataFrame:
    """Text lengths of the rows that have both fields; rows that come with lengths stay as they are."""
    if set(FIELDS) <= set(examples.columns):
        return examples
    both = F.col("input_text").isNotNull() & F.col("output_text").isNotNull()
    return examples.filter(both).select(
        *(c for c in examples.columns if c not in ("input_text", "output_text")),
        F.length("input_text").alias(FIELDS[0]),
        F.length("output_text").alias(FIELDS[1]),
    )


def field_stats(grouped, fields: tuple[str, ...], keys: list[str]) -> DataFrame:
    """Aggregate ``grouped`` and turn it into one row per field.

    All fields are measured in one pass; only the few result rows are unfolded.
    """
    measured = grouped.agg(
        *(F.struct(*(c.alias(m) for m, c in basic_stats(f).items())).alias(f) for f in fields)
    )
    rows = F.array(
        *(F.struct(F.lit(f).alias("field"), *(F.col(f)[m].alias(m) for m in MEASURES)) for f in fields)
    )
    return measured.select(*keys, F.inline(rows))


def length_stats(examples: DataFrame) -> DataFrame:
    """``split, field, count, min, max, mean, median, std``; a split without rows has none."""
    return field_stats(with_lengths(examples).groupBy("split"), FIELDS, ["split"])


def length_pivot(stats: DataFrame) -> DataFrame:
    """Min, mean and max of both fields side by side, one row per split."""
    return (
        stats.groupBy("split")
        .pivot("field", list(FIELDS))
        .agg(*(F.first(m).alias(m) for m in ("min", "mean", "max")))
    )


def dataset_summary(examples: DataFrame) -> DataFrame:
    """Length statistics per split and, with split ``total``, over everything."""
    lengths = with_lengths(examples)
    grouped = lengths.groupingSets([[F.col("split")], []], F.col("split"))
    return field_stats(grouped, FIELDS, ["split"]).withColumn(
        "split", F.coalesce("split", F.lit("total"))
    )


def quality_metrics(stats: DataFrame) -> DataFrame:
    """One row: input/output ratio, split balance, length variability, overall quality.

    ``stats`` is the result of :func:`length_stats`.
    """
    is_input = F.col("field") == FIELDS[0]
    splits = stats.agg(
        F.avg(F.when(is_input, F.col("mean"))).alias("input_mean"),
        F.avg(F.when(~is_input, F.col("mean"))).alias("output_mean"),
        F.count(F.when(is_input, 1)).alias("splits"),
        F.sum(F.when(is_input, F.col("count"))).cast("double").alias("n"),
        F.sum(
            F.when(is_input & (F.col("count") > 0), F.col("count") * F.log2("count"))
        ).alias("n_log_n"),
        (F.avg("std") / 100).alias("length_variability"),
    )
    # Entropy of shares c/n is log2(n) - sum(c*log2(c))/n.
    entropy = F.log2("n") - F.col("n_log_n") / F.col("n")
    measured = splits.select(
        F.when(F.col("input_mean") > 0, F.col("output_mean") / F.col("input_mean"))
        .otherwise(0.0)
        .alias("input_output_ratio"),
        F.when((F.col("n") > 0) & (F.col("splits") > 1), entropy / F.log2("splits"))
        .otherwise(0.0)
        .alias("split_balance"),
        F.coalesce("length_variability", F.lit(0.0)).alias("length_variability"),
    )
    return measured.withColumn(
        "overall_quality",
        RATIO_WEIGHT * F.least("input_output_ratio", F.lit(1.0))
        + BALANCE_WEIGHT * F.col("split_balance")
        + VARIABILITY_WEIGHT * F.least("length_variability", F.lit(1.0)),
    )


def rating(value: Column, medium: float | Column, good: float | Column) -> Column:
    """``good``, ``medium`` or ``poor``."""
    return F.when(value >= good, "good").when(value >= medium, "medium").otherwise("poor")


def quality_ratings(metrics: DataFrame) -> DataFrame:
    """``metric, value, formatted, rating, label`` for each quality metric."""
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("metric"),
                F.col(name).alias("value"),
                rating(F.col(name), *RATING_THRESHOLDS[name]).alias("rating"),
            )
            for name in RATING_THRESHOLDS
        )
    )
    return metrics.select(F.inline(rows)).select(
        "metric",
        "value",
        F.format_string("%.2f", "value").alias("formatted"),
        "rating",
        F.initcap("rating").alias("label"),
    )


def quality_report_rows(stats: DataFrame) -> DataFrame:
    """``section, name, measure, value``: the same contents as :func:`quality_report`, as a table.

    ``stats`` is the result of :func:`length_stats`; it is read twice.
    """
    values = [F.col(m).cast("double").alias(m) for m in MEASURES]
    name = F.concat_ws("/", "split", "field").alias("name")
    lengths = stats.select(F.lit("stats").alias("section"), name, *values).unpivot(["section", "name"], list(MEASURES), "measure", "value")
    measured = quality_metrics(stats)
    metrics = measured.select(F.lit("metrics").alias("section"), *measured.columns).unpivot("section", measured.columns, "name", "value")
    return lengths.unionByName(metrics.select("section", "name", F.lit("value").alias("measure"), "value"))


def quality_report(examples: DataFrame) -> DataFrame:
    """One row with a JSON document of the statistics and the metrics."""
    stats = length_stats(examples)
    listed = stats.agg(F.sort_array(F.collect_list(F.struct("split", "field", *MEASURES))).alias("stats"))
    measured = quality_metrics(stats).select(F.struct("*")).scalar()
    return listed.select(
        F.to_json(F.struct("stats", measured.alias("metrics"))).alias("report")
    )
