"""Files as rows: scans, inventories and chunk files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkprep.operators.chunking import clean_chunks
from sparkprep.sources.listing import contents, list_files


def scan_files(
    spark: SparkSession, path: str, pattern: str = "*.pdf", recursive: bool = False, empty: bool = False
) -> DataFrame:
    """``path, modificationTime, length, content``; contents are read only if selected.

    Spark's scan leaves files of length 0 out, the driver lists for it, and a task gets no more files than
    ``spark.sql.files.openCostInBytes`` allows, 32 as a rule. With ``empty`` the tasks list and read instead: all
    files come, dealt over ``spark.sql.shuffle.partitions`` tasks, however many and small they are.
    """
    if empty:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = list_files(spark, path, pattern, recursive).repartition(parts, "path")
        time = F.date_trunc("millisecond", "modificationTime").alias("modificationTime")
        return found.select("path", time, "length", contents(path)("path").alias("content"))
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if there is something at ``path``; no file is opened."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as failure:
        if failure.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def file_inventory(files: DataFrame) -> DataFrame:
    """Number and total size of the files in each directory."""
    return (
        files.withColumn("directory", F.regexp_replace("path", "/[^/]*$", ""))
        .groupBy("directory")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def file_metadata(files: DataFrame, page_counts: DataFrame) -> DataFrame:
    """``path, FileName, FileSize, PageCount``; ``page_counts`` has ``path, page_count``."""
    return (
        files.select("path", file_name(F.col("path")).alias("FileName"), F.col("length").alias("FileSize"))
        .join(page_counts, "path", "left")
        .withColumn("PageCount", F.coalesce("page_count", F.lit(0)))
        .drop("page_count")
    )


def load_chunk_files(spark: SparkSession, path: str) -> DataFrame:
    """Chunk files below ``path`` to ``doc_id, chunk_index, chunk``.

    Accepts ``<doc>_chunks/chunk_<n>.txt`` and ``chunks/<doc>/chunk_<n>.txt``. The index
    is a number, so chunk 10 comes after chunk 2. Blank chunks are dropped.
    """
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "chunk_*.txt")
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("chunk"))
    )
    folder = F.element_at(F.split("path", "/"), -2)
    parsed = files.select(
        F.regexp_replace(folder, "_chunks$", "").alias("doc_id"),
        F.regexp_extract("path", r"chunk_(\d+)\.txt$", 1).try_cast("int").alias("chunk_index"),
        "chunk",
    )
    return clean_chunks(parsed)
