"""Joins and sums for tables in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SHARE = 1000


def hot_classes(classes: DataFrame, rows: int, size: str = "group_size") -> DataFrame:
    """The classes that hold more than one row in ``SHARE``: fewer than ``SHARE`` by their definition.

    ``classes`` has one row per class, ``rows`` is the sum of their sizes. Because of the
    bound the result may be broadcast. ``shards`` says over how many parts to spread a class.
    """
    hot = classes.filter(F.col(size) * SHARE > rows)
    return hot.withColumn("shards", F.ceil(F.col(size) * SHARE / F.lit(max(rows, 1))).cast("int"))


def attach(rows: DataFrame, classes: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """``rows`` with the columns of their class; keys are not null, classes have them once.

    Rows of hot classes meet a broadcast of those few classes where they are; only the
    others are shuffled, and none of their keys holds more than one row in ``SHARE``.
    """
    hot = F.broadcast(hot.select(classes.columns))
    cold = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti").join(classes, keys)
    return rows.join(hot, keys).select(cold.columns).unionByName(cold)
