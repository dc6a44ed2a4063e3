"""Writers. Every path may be an object store that Spark has a connector for."""

from __future__ import annotations

import logging
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.operators.chunking import render_chunks
from sparkprep.sources.files import scan_files
from sparkprep.sources.listing import system_of

logger = logging.getLogger(__name__)

FORMATS = ("jsonl", "parquet")


def write_splits(examples: DataFrame, path: str, format: str = "jsonl") -> None:
    """One directory per split. An unknown format is written as JSON lines."""
    if format.lower() not in FORMATS:
        logger.warning("Unknown format %s; writing JSON lines", format)
        format = "jsonl"
    writer = examples.write.partitionBy("split")
    if format.lower() == "parquet":
        writer.parquet(path)
    else:
        writer.option("ignoreNullFields", "false").json(path)


def write_rendered(documents: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """``doc_id, rendered``: each document's ``chunks`` (an array) below numbered headers, sorted by document.

    For single files, give the rows to :func:`write_files`.
    """
    rendered = documents.select(doc_id, render_chunks(F.col("chunks")).alias("rendered"))
    rendered.repartitionByRange(doc_id).sortWithinPartitions(doc_id).write.parquet(path)


def write_chunks(chunks: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """A table of chunks, sorted, so that a document's chunks are read from few row groups."""
    order = [doc_id, "chunk_index"]
    chunks.select(*order, "chunk").repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)


def write_structure(structure: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """``doc_id, structure``: a JSON document of metadata, toc and sections per source document, sorted."""
    body = F.to_json(
        F.struct("metadata", "toc", "sections"), {"ignoreNullFields": "false"}
    ).alias("structure")
    structure.select(doc_id, body).repartitionByRange(doc_id).sortWithinPartitions(doc_id).write.parquet(path)


def write_evaluation(metrics: DataFrame, predictions: DataFrame, path: str) -> None:
    """Metrics and predictions as JSON lines in two directories."""
    metrics.write.json(f"{path}/metrics")
    predictions.write.json(f"{path}/predictions")


def write_files(files: DataFrame, target: str) -> int:
    """Write rows ``path, content`` as single files below ``target``; returns their number.

    ``path`` is relative to the target. The tasks write through Arrow's file systems, which
    reach local and shared folders and the common object stores. A task that runs again
    replaces its files. Without content a file is empty; rows without path are left out.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = system_of(target)
        for batch in batches:
            for path, content in zip(*(c.to_pylist() for c in batch.columns)):
                place = f"{base}/{path.lstrip('/')}"
                system.create_dir(place.rpartition("/")[0], recursive=True)
                with system.open_output_stream(place) as out:
                    out.write(content or b"")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    rows = files.select("path", F.col("content").cast("binary").alias("content")).filter("path IS NOT NULL")
    return rows.mapInArrow(write, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def manifest(
    spark: SparkSession, path: str, key: str = "split", pattern: str = "part-*"
) -> DataFrame:
    """``split, uri``: a row for each file below a ``split=…`` directory. Only listings are read."""
    files = scan_files(spark, path, pattern, recursive=True)
    return files.select(F.regexp_extract("path", f"{key}=([^/]+)/", 1).alias(key), F.col("path").alias("uri"))
