"""Documents to chunks, and chunk tables to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.functions.chunks import chunk_text
from sparkprep.functions.text import strip


def chunk_documents(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """One row per chunk: ``doc_id, chunk_index`` (from 1) and ``chunk``.

    Works inside each row, so there is no shuffle. ``options`` are those of
    :func:`sparkprep.functions.chunks.chunk_text`.
    """
    return documents.select(
        F.col(doc_id), F.posexplode(chunk_text(F.col(text), **options)).alias("pos", "chunk")
    ).select(doc_id, (F.col("pos") + 1).alias("chunk_index"), "chunk")


def clean_chunks(chunks: DataFrame) -> DataFrame:
    """Strip chunks and drop blank ones, and with them documents that have nothing left."""
    return chunks.withColumn("chunk", strip(F.col("chunk"))).filter(F.col("chunk") != "")


def render_chunks(chunk_list: Column) -> Column:
    """All chunks of a document as one text, each below a numbered header line."""
    return F.array_join(
        F.transform(
            chunk_list,
            lambda c, i: F.concat(
                F.lit("--- Chunk "), (i + 1).cast("string"), F.lit(" ---\n"), c, F.lit("\n\n")
            ),
        ),
        "",
    )
