"""Chunk documents as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.operators.chunking import chunk_documents
from sparkprep.sources.files import file_stem


def text_file_stream(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """``doc_id, text`` of whole text files as they are added below ``path``."""
    files = spark.readStream.option("pathGlobFilter", pattern).text(path, wholetext=True)
    return files.select(
        file_stem(F.col("_metadata.file_path")).alias("doc_id"), F.col("value").alias("text")
    )


def chunk_stream(documents: DataFrame, **options) -> DataFrame:
    """Chunks of arriving documents. Stateless: a document is chunked when it is seen."""
    return chunk_documents(documents, **options)
