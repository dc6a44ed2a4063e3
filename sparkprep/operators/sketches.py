"""Distinct counts by sketches that are stored per part of a data set and merged for any union of parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LG_K = 14
ERROR = 3 * 1.04 / 2 ** (LG_K / 2)  # three standard errors, as a share of the count


def distinct_sketches(rows: DataFrame, parts: list[str], value: str = "input_text", lg_k: int = LG_K) -> DataFrame:
    """``<parts>, rows, sketch``: a sketch of the distinct values of each part, of a fixed size.

    Sketches are made in the tasks and merged by the shuffle; a part with a large share of all rows is one
    sketch per task. Null values are not counted as a value.
    """
    return rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.md5(value), lg_k).alias("sketch"))


def merged_counts(sketches: DataFrame, by: list[str]) -> DataFrame:
    """``<by>, rows, estimate``: the parts' sketches merged; nothing but sketches is read.

    The estimate is within ``ERROR`` of the count with a probability above 0.99.
    """
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate")
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), union)
