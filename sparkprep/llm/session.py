"""Session settings that the operators rely on."""

from __future__ import annotations

import gc

from pyspark.sql import SparkSession

BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound what goes to Python at once by bytes: texts differ too much in length for a bound on rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps, which it does once their plans are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
