"""Sample chunks, turn them into training examples and validate these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkprep.functions.bind import bind
from sparkprep.functions.hashing import row_key
from sparkprep.functions.text import context_preview, first_sentence, instruction, question

QA, INSTRUCTION = "qa", "instruction"


def _kind(rank: Column, sampled: Column, qa_ratio: float) -> Column:
    """The first ``floor(sampled * qa_ratio)`` become questions, the rest instructions."""
    quota = F.floor(sampled.cast("double") * qa_ratio)
    return F.when(rank <= quota, QA).otherwise(INSTRUCTION)


def sample_chunks(
    chunks: DataFrame,
    per_document: int = 10,
    qa_ratio: float = 0.5,
    seed: int = 0,
    doc_id: str = "doc_id",
) -> DataFrame:
    """Up to ``per_document`` chunks of each document, with ``sample_rank`` and ``kind``.

    For a table of chunks. Spark applies ``rank <= n`` in each partition before the
    shuffle, so a document with most of the rows sends only a few of them. Counting the
    sampled rows after the limit keeps that possible; it also equals
    ``min(per_document, chunks)``.
    """
    key = row_key(F.col(doc_id), F.col("chunk_index"), seed=seed)
    by_key = Window.partitionBy(doc_id).orderBy("sample_key", "chunk_index")
    ranked = (
        chunks.withColumn("sample_key", key)
        .withColumn("sample_rank", F.row_number().over(by_key))
        .filter(F.col("sample_rank") <= per_document)
    )
    sampled = F.count(F.lit(1)).over(Window.partitionBy(doc_id))
    return ranked.withColumn("kind", _kind(F.col("sample_rank"), sampled, qa_ratio))


def _sampled(chunk_list: Column, per_document: int, seed: int, doc_id: str) -> Column:
    """The chunks with the least keys, as ``array<struct<sample_key, chunk_index, chunk>>``."""
    keyed = F.transform(
        chunk_list,
        lambda chunk, i: F.struct(
            row_key(F.col(doc_id), i + 1, seed=seed).alias("sample_key"),
            (i + 1).alias("chunk_index"),
            chunk.alias("chunk"),
        ),
    )
    return F.slice(F.sort_array(keyed), 1, per_document)


def sample_chunk_lists(
    documents: DataFrame,
    chunk_list: Column,
    per_document: int = 10,
    qa_ratio: float = 0.5,
    seed: int = 0,
    doc_id: str = "doc_id",
) -> DataFrame:
    """:func:`sample_chunks` for documents that hold their chunks in one array.

    Same result, but inside the row and so without any shuffle.
    """
    rows = bind(
        _sampled(chunk_list, per_document, seed, doc_id),
        lambda sampled: F.transform(
            sampled,
            lambda s, i: F.struct(
                s["chunk_index"].alias("chunk_index"),
                s["chunk"].alias("chunk"),
                s["sample_key"].alias("sample_key"),
                (i + 1).alias("sample_rank"),
                _kind(i + 1, F.size(sampled), qa_ratio).alias("kind"),
            ),
        ),
    )
    return documents.select(doc_id, F.inline(rows))


def _input_text(kind: Column, chunk: Column, key: Column) -> Column:
    return F.when(kind == QA, question(chunk, key)).otherwise(instruction(chunk, key))


def make_examples(sampled: DataFrame) -> DataFrame:
    """``input_text`` (question or instruction) and ``output_text`` (the chunk)."""
    chunk, key = F.col("chunk"), F.col("sample_key")
    built = _input_text(F.col("kind"), chunk, key)
    kept = [c for c in sampled.columns if c not in ("chunk", "sample_key", "sample_rank")]
    return sampled.select(*kept, built.alias("input_text"), chunk.alias("output_text"))


def example_lists(
    documents: DataFrame,
    chunk_list: Column,
    per_document: int = 10,
    qa_ratio: float = 0.5,
    seed: int = 0,
    doc_id: str = "doc_id",
) -> DataFrame:
    """:func:`make_examples` of :func:`sample_chunk_lists`, built inside the row.

    A filter on the texts then reads finished columns. Built outside, Spark would work
    out the texts once for the filter and again for the result.
    """
    rows = bind(
        _sampled(chunk_list, per_document, seed, doc_id),
        lambda sampled: F.transform(
            sampled,
            lambda s, i: F.struct(
                s["chunk_index"].alias("chunk_index"),
                _kind(i + 1, F.size(sampled), qa_ratio).alias("kind"),
                _input_text(
                    _kind(i + 1, F.size(sampled), qa_ratio), s["chunk"], s["sample_key"]
                ).alias("input_text"),
                s["chunk"].alias("output_text"),
            ),
        ),
    )
    return documents.select(doc_id, F.inline(rows))


def is_valid(
    min_input: int = 10,
    max_input: int = 1024,
    min_output: int = 20,
    max_output: int = 2048,
    input_text: str = "input_text",
    output_text: str = "output_text",
) -> Column:
    """Both fields present and their lengths within the inclusive bounds; never null."""
    return F.coalesce(
        F.length(input_text).between(min_input, max_input)
        & F.length(output_text).between(min_output, max_output),
        F.lit(False),
    )


def valid_counts(examples: DataFrame, doc_id: str = "doc_id", **bounds) -> DataFrame:
    """Examples and valid examples per document."""
    return examples.groupBy(doc_id).agg(
        F.count(F.lit(1)).alias("examples"),
        F.sum(is_valid(**bounds).cast("bigint")).alias("valid"),
    )


def probe_questions(sampled: DataFrame, preview: int = 200) -> DataFrame:
    """A question, a context preview and the text length for each sampled chunk."""
    subject = first_sentence(F.col("chunk"))
    kept = [c for c in sampled.columns if c not in ("chunk", "sample_key", "kind")]
    return sampled.select(
        *kept,
        F.concat(F.lit("What can you tell me about "), subject, F.lit("?")).alias("question"),
        context_preview(F.col("chunk"), preview).alias("context"),
        F.length("chunk").alias("text_length"),
    )


def review_sample(
    examples: DataFrame, identity: list[str], size: int = 50, seed: int = 0
) -> DataFrame:
    """A reproducible fixed-size subset for human review (a top-k, not a sort)."""
    key = row_key(*map(F.col, identity), F.lit("review"), seed=seed)
    return examples.withColumn("_key", key).orderBy("_key").limit(size).drop("_key")
