"""Text, classification and question-answering metrics.

Rows hold ``output`` (expected), ``prediction`` and, for classification, ``label``.
Every text metric is worked out inside the row and then averaged or summed, so the only
shuffle is that of the final aggregate. Pass ``by`` to get results per model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.functions.overlap import f_measure, lcs_length, ngram_overlaps, tokens
from sparkprep.functions.text import strip

TEXT_METRICS = ("rouge", "bleu")
BLEU_ORDER = 4


def read_names(rows: DataFrame) -> DataFrame:
    """Accept training rows too: ``input_text/output_text`` become ``input/output``."""
    return rows.withColumnsRenamed({"input_text": "input", "output_text": "output"})


def with_tokens(rows: DataFrame, unicode: bool = True) -> DataFrame:
    return rows.withColumn(
        "_expected", tokens(F.coalesce("output", F.lit("")), unicode)
    ).withColumn("_predicted", tokens(F.coalesce("prediction", F.lit("")), unicode))


def overlap_counts(rows: DataFrame, top: int = BLEU_ORDER, unicode: bool = True) -> DataFrame:
    """Per row and n up to ``top``: ``hits<n>`` (clipped matches), ``predicted<n>`` and
    ``expected<n>`` (n-grams)."""
    ready = with_tokens(rows, unicode)
    hits = ngram_overlaps(F.col("_predicted"), F.col("_expected"), top)

    def total(side: str, n: int) -> Column:
        return F.greatest(F.size(side) - (n - 1), F.lit(0))

    counts = []
    for n in range(1, top + 1):
        counts += [
            F.get("_hits", F.lit(n - 1)).alias(f"hits{n}"),
            total("_predicted", n).alias(f"predicted{n}"),
            total("_expected", n).alias(f"expected{n}"),
        ]
    return ready.withColumn("_hits", hits).select(*ready.columns, *counts)


def _rouge(n: int) -> Column:
    return f_measure(F.col(f"hits{n}"), F.col(f"predicted{n}"), F.col(f"expected{n}"))


def _with_longest(counted: DataFrame) -> DataFrame:
    return counted.withColumn("_lcs", lcs_length()("_expected", "_predicted"))


def rouge_scores(rows: DataFrame, unicode: bool = True, longest: bool = True) -> DataFrame:
    """ROUGE-1 and ROUGE-2 F1 per row, and ROUGE-L unless ``longest`` is off."""
    counted = overlap_counts(rows, 2, unicode)
    scores = [_rouge(1).alias("rouge1"), _rouge(2).alias("rouge2")]
    if longest:
        counted = _with_longest(counted)
        scores.append(f_measure(F.col("_lcs"), *map(F.col, _LENGTHS)).alias("rougeL"))
    return counted.select(*rows.columns, *scores)


_LENGTHS = ("predicted1", "expected1")


def _mean(score: Column) -> Column:
    return F.coalesce(F.avg(score), F.lit(0.0))


def bleu_of_sums() -> Column:
    """Corpus BLEU from the summed ``hits<n>``, ``predicted<n>`` and ``expected1``.

    Without smoothing: 0 if some n-gram order has no match.
    """
    orders = range(1, BLEU_ORDER + 1)
    logs = [F.log(F.sum(f"hits{n}") / F.sum(f"predicted{n}")) for n in orders]
    predicted, expected = (F.sum(c) for c in _LENGTHS)
    penalty = F.when(predicted > expected, F.lit(0.0)).otherwise(1 - expected / predicted)
    matched = F.least(*(F.sum(f"hits{n}") for n in orders)) > 0
    mean_log = sum(logs[1:], logs[0]) / BLEU_ORDER
    return F.when(matched, F.exp(penalty + mean_log)).otherwise(0.0)


def bleu(rows: DataFrame, by: list[str] | None = None, unicode: bool = True) -> DataFrame:
    """Corpus BLEU in [0, 1]."""
    return overlap_counts(rows, unicode=unicode).groupBy(*(by or [])).agg(
        bleu_of_sums().alias("bleu")
    )


def text_metrics(
    rows: DataFrame,
    metrics: tuple[str, ...] = TEXT_METRICS,
    by: list[str] | None = None,
    unicode: bool = True,
) -> DataFrame:
    """``metric, value`` (per ``by``): rouge1, rouge2, rougeL and bleu as asked for.

    All of them come from one pass over the rows.
    """
    if not set(metrics) & set(TEXT_METRICS):
        raise ValueError(f"metrics must name some of {TEXT_METRICS}")
    top = BLEU_ORDER if "bleu" in metrics else 2
    counted, wanted = overlap_counts(rows, top, unicode), []
    if "rouge" in metrics:
        counted = _with_longest(counted)
        wanted += [
            _mean(_rouge(1)).alias("rouge1"),
            _mean(_rouge(2)).alias("rouge2"),
            _mean(f_measure(F.col("_lcs"), *map(F.col, _LENGTHS))).alias("rougeL"),
        ]
    if "bleu" in metrics:
        wanted.append(bleu_of_sums().alias("bleu"))
    return to_long(counted.groupBy(*(by or [])).agg(*wanted), by)


def to_long(wide: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Metric columns to ``metric, value`` rows."""
    by = by or []
    names = [c for c in wide.columns if c not in by]
    rows = F.array(
        *(F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names)
    )
    return wide.select(*by, F.inline(rows))


def confusion_matrix(
    rows: DataFrame, label: str = "label", by: list[str] | None = None
) -> DataFrame:
    """``label, prediction, count``."""
    return rows.groupBy(*(by or []), F.col(label).alias("label"), "prediction").agg(
        F.count(F.lit(1)).alias("count")
    )


def class_scores(confusion: DataFrame) -> DataFrame:
    """``class, support, precision, recall, f1`` from a confusion matrix.

    A ratio without cases is 0.
    """
    each = F.explode(
        F.array(
            F.struct(
                F.col("label").alias("class"),
                F.col("count").alias("expected"),
                F.lit(0).cast("bigint").alias("predicted"),
                F.when(F.col("label") == F.col("prediction"), F.col("count"))
                .otherwise(0)
                .alias("right"),
            ),
            F.struct(
                F.col("prediction").alias("class"),
                F.lit(0).cast("bigint").alias("expected"),
                F.col("count").alias("predicted"),
                F.lit(0).cast("bigint").alias("right"),
            ),
        )
    )
    totals = (
        confusion.select(each.alias("c"))
        .select("c.*")
        .groupBy("class")
        .agg(*(F.sum(c).alias(c) for c in ("expected", "predicted", "right")))
    )
    return totals.select(
        "class",
        F.col("expected").alias("support"),
        F.coalesce(F.try_divide("right", "predicted"), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide("right", "expected"), F.lit(0.0)).alias("recall"),
        F.coalesce(
            F.try_divide(F.col("right") * 2, F.col("predicted") + F.col("expected")), F.lit(0.0)
        ).alias("f1"),
    )


def classification_metrics(rows: DataFrame, label: str = "label") -> DataFrame:
    """One row: accuracy, and precision, recall and F1 weighted by class size.

    The ``macro_`` columns weigh all classes that occur, expected or predicted, alike.
    """
    scores = class_scores(confusion_matrix(rows, label))
    names = ("precision", "recall", "f1")
    total = F.sum("support")
    weighted = [
        F.coalesce(F.sum(F.col(n) * F.col("support")) / total, F.lit(0.0)).alias(n) for n in names
    ]
    macro = [F.coalesce(F.avg(n), F.lit(0.0)).alias(f"macro_{n}") for n in names]
    # Weighted recall is the share of right predictions, which is the accuracy.
    accuracy = F.coalesce(F.sum(F.col("recall") * F.col("support")) / total, F.lit(0.0))
    return scores.agg(accuracy.alias("accuracy"), *weighted, *macro)


def qa_metrics(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Exact match and contains-answer, both after lower-casing and stripping.

    Contains-answer holds when either text is part of the other and neither is blank.
    """
    predicted, expected = strip(F.lower("prediction")), strip(F.lower("output"))
    within = (predicted != "") & (expected != "")
    contains = within & (predicted.contains(expected) | expected.contains(predicted))

    def share(condition: Column) -> Column:
        return F.coalesce(F.avg(F.coalesce(condition, F.lit(False)).cast("double")), F.lit(0.0))

    return rows.groupBy(*(by or [])).agg(
        share(predicted == expected).alias("exact_match"),
        share(contains).alias("contains_answer"),
    )


def task_metrics(
    rows: DataFrame, metrics: tuple[str, ...] = TEXT_METRICS, task_type: str = "general"
) -> DataFrame:
    """``metric, value``: text metrics and those of the task type."""
    rows = read_names(rows)
    result = text_metrics(rows, metrics)
    if task_type == "classification":
        own = classification_metrics(rows).select("accuracy", "precision", "recall", "f1")
        return result.unionByName(to_long(own))
    if task_type == "qa":
        return result.unionByName(to_long(qa_metrics(rows)))
    if task_type != "general":
        raise ValueError("task_type is general, classification or qa")
    return result
