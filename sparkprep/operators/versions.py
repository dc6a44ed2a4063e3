"""The history of a data set over many versions, as runs of versions of each content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.operators.dataset import content_key
from sparkprep.plans.staging import delete, folder_names

RUN = "content_key string, count bigint, from_version bigint, to_version bigint"
CONTENT = ("input_text", "output_text")


def extend(history: str, data: DataFrame, version: int, before: int | None = None, columns: Sequence[str] = CONTENT) -> None:
    """Add a version to the history below the folder ``history``; ``before`` is the one that precedes it, None for the first.

    A content that has the same number of rows as before keeps its run. One that is new, gone or
    repeated more or less often ends its run with the version before and, if it is there, begins
    a new one. Ended runs are written to ``closed/version=…`` and never read again here; the others
    to ``open/version=…``. So an extension reads the new version and the open runs, however
    many versions there are. Both sides have a hash once, and rows are counted before they are
    shuffled. A repeated extension replaces its own output; of the open runs the last two versions stay.
    """
    spark = data.sparkSession
    if before is not None and before >= version:
        raise ValueError("versions must rise")
    counted = data.groupBy(content_key(*columns).alias("content_key")).agg(F.count(F.lit(1)).alias("rows"))
    if before is None:
        old = spark.createDataFrame([], RUN)
    else:
        old = spark.read.schema(RUN).parquet(f"{history}/open/version={before}")
    joined = old.join(counted, "content_key", "full")
    stays = F.coalesce(F.col("rows") == F.col("count"), F.lit(False))
    start = F.when(stays, F.col("from_version")).otherwise(F.lit(version).cast("bigint"))
    current = joined.filter("rows IS NOT NULL").select("content_key", F.col("rows").alias("count"), start.alias("from_version"), F.lit(None).cast("bigint").alias("to_version"))
    ended = joined.filter(F.col("count").isNotNull() & ~stays)
    ended = ended.select("content_key", "count", "from_version", F.lit(before).cast("bigint").alias("to_version"))
    ended.write.mode("overwrite").parquet(f"{history}/closed/version={version}")
    current.write.mode("overwrite").parquet(f"{history}/open/version={version}")
    for older in _versions(spark, history)[:-2]:
        delete(spark, f"{history}/open/version={older}")


def _versions(spark: SparkSession, history: str) -> list[int]:
    """The versions whose open runs are kept."""
    return sorted(int(name.removeprefix("version=")) for name in folder_names(spark, f"{history}/open"))


def runs(spark: SparkSession, history: str) -> DataFrame:
    """``content_key, count, from_version, to_version`` of every run; ``to_version`` is null for the contents of the last version."""
    ended = spark.read.schema(f"{RUN}, version bigint").parquet(f"{history}/closed").drop("version")
    last = _versions(spark, history)[-1]
    return ended.unionByName(spark.read.schema(RUN).parquet(f"{history}/open/version={last}"))


def state_at(spark: SparkSession, history: str, version: int) -> DataFrame:
    """``content_key, count`` of a version. A run that ended before is in a folder that is not listed."""
    ended = spark.read.schema(f"{RUN}, version bigint").parquet(f"{history}/closed").filter(F.col("version") > version).drop("version")
    last = _versions(spark, history)[-1]
    every = ended.unionByName(spark.read.schema(RUN).parquet(f"{history}/open/version={last}"))
    there = (F.col("from_version") <= version) & (F.coalesce("to_version", F.lit(version)) >= version)
    return every.filter(there).select("content_key", "count")


def changes(spark: SparkSession, history: str) -> DataFrame:
    """``version, added, removed, changed``: contents that are new, gone or have another number of rows, in each version that changed something.

    A run's begin and the end of the one before meet at the version of the change.
    """
    every = runs(spark, history)
    begins = every.select("content_key", F.col("from_version").alias("version"), F.lit(1).alias("begins"), F.lit(0).alias("ends"))
    folders = spark.read.schema(f"{RUN}, version bigint").parquet(f"{history}/closed")
    ends = folders.select("content_key", "version", F.lit(0).alias("begins"), F.lit(1).alias("ends"))
    per_content = begins.unionByName(ends).groupBy("version", "content_key").agg(F.max("begins").alias("begins"), F.max("ends").alias("ends"))
    return per_content.groupBy("version").agg(
        F.count_if((F.col("begins") == 1) & (F.col("ends") == 0)).alias("added"),
        F.count_if((F.col("begins") == 0) & (F.col("ends") == 1)).alias("removed"),
        F.count_if((F.col("begins") == 1) & (F.col("ends") == 1)).alias("changed"),
    )
