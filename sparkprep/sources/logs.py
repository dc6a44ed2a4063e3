"""Prediction and feedback logs as tables that are partitioned by day, appended to and compacted.

Every append and every compaction writes a folder of its own. A small file names the folders that
make up the log; each change writes the next one aside and gives it its name when all else is there. So a
reader sees the log before or after a change, never half of one.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.operators.monitoring import between
from sparkprep.plans.staging import delete, folder_names, read_text, rename, write_text

LIVE = "_live"


def _live(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """The number of the last change, and the folders that make up the log since then."""
    numbers = [int(name) for name in folder_names(spark, f"{path}/{LIVE}") if name.isdigit()]
    if not numbers:
        return 0, []
    return max(numbers), json.loads(read_text(spark, f"{path}/{LIVE}/{max(numbers)}"))


def _change(spark: SparkSession, path: str, number: int, folders: list[str]) -> None:
    """Make change ``number``; fails if another writer was faster, whose change then holds."""
    aside = f"{path}/{LIVE}/.{uuid.uuid4().hex}"
    write_text(spark, aside, json.dumps(folders))
    if str(number) in folder_names(spark, f"{path}/{LIVE}"):
        raise RuntimeError("another writer changed the log; try again")
    rename(spark, aside, f"{path}/{LIVE}/{number}")


def _read(spark: SparkSession, path: str, folders: list[str], schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reduce(DataFrame.unionByName, (reader.parquet(f"{path}/{f}") for f in folders))


def append_log(log: DataFrame, path: str) -> None:
    """Add entries to a log table."""
    spark, name = log.sparkSession, f"batch-{uuid.uuid4().hex}"
    log.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(f"{path}/{name}")
    number, folders = _live(spark, path)
    _change(spark, path, number + 1, [*folders, name])


def compact_log(spark: SparkSession, path: str) -> list[str]:
    """Rewrite the log into few files, each day's sorted by endpoint and time; returns the folders that are no longer part of it.

    Files are cut by ranges of day, endpoint and time, so a busy endpoint spans several, and the sizes of
    row groups and files follow Spark's settings. Readers that began before go on with the old folders;
    :func:`drop_folders` deletes those when none needs them.
    """
    number, folders = _live(spark, path)
    if not folders:
        return []
    name, order = f"compact-{uuid.uuid4().hex}", ["day", "endpoint_id", "ts"]
    log = _read(spark, path, folders)
    sorted_log = log.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_log.write.partitionBy("day").parquet(f"{path}/{name}")
    _change(spark, path, number + 1, [name])
    return folders


def drop_folders(spark: SparkSession, path: str, folders: list[str]) -> None:
    """Delete folders that a compaction replaced."""
    live = set(_live(spark, path)[1])
    for name in folders:
        if name not in live:
            delete(spark, f"{path}/{name}")


def read_log(spark: SparkSession, path: str, schema: str, start=None, end=None) -> DataFrame:
    """Entries from ``start`` to ``end``, both inclusive.

    Days outside are not listed as input at all; within the days left, the filters reach the scan, and
    in compacted files an endpoint's entries are in few row groups. ``schema`` is that of the
    entries, without the day.
    """
    folders = _live(spark, path)[1]
    whole = f"{schema}, day date"
    log = _read(spark, path, folders, whole) if folders else spark.createDataFrame([], whole)
    if start is not None:
        log = log.filter(F.col("day") >= F.lit(start).cast("timestamp").cast("date"))
    if end is not None:
        log = log.filter(F.col("day") <= F.lit(end).cast("timestamp").cast("date"))
    return between(log, start, end).drop("day")


def stream_log(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """Entries as they are appended; compactions add nothing to it."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(f"{path}/batch-*")
