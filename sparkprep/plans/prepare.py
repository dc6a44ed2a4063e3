"""Documents to a split training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkprep.functions.chunks import chunk_text
from sparkprep.operators.examples import example_lists, is_valid
from sparkprep.operators.quality import FIELDS, with_lengths
from sparkprep.operators.splitting import split_exact
from sparkprep.plans.staging import stage


def training_examples(
    documents: DataFrame,
    per_document: int = 10,
    qa_ratio: float = 0.5,
    seed: int = 0,
    bounds: dict | None = None,
    **chunking,
) -> DataFrame:
    """Valid examples of each document: chunk, sample, build, validate.

    Validation comes after sampling, so a document can end up with fewer examples. All
    of it is one pass over the documents without a shuffle. ``doc_id`` must identify a
    document.
    """
    chunks = chunk_text(F.col("text"), **chunking)
    examples = example_lists(documents, chunks, per_document, qa_ratio, seed)
    return examples.filter(is_valid(**(bounds or {})))


def prepare_training_data(
    documents: DataFrame,
    train_ratio: float = 0.8,
    val_ratio: float = 0.1,
    seed: int = 0,
    **options,
) -> DataFrame:
    """``doc_id, chunk_index, kind, input_text, output_text, split``.

    The examples are written once. Finding the split boundaries then reads only the two
    identity columns, and the texts are read a single time for the result.
    """
    examples = stage(training_examples(documents, seed=seed, **options), "examples")
    return split_exact(examples, ["doc_id", "chunk_index"], train_ratio, val_ratio, seed)


def prepare_lengths(documents: DataFrame, train_ratio: float = 0.8, val_ratio: float = 0.1, seed: int = 0, **options) -> DataFrame:
    """``doc_id, chunk_index, kind, input_length, output_length, split`` of the same training set, for statistics of lengths.

    Texts are measured where they are made and never written.
    """
    measured = with_lengths(training_examples(documents, seed=seed, **options))
    rows = stage(measured.select("doc_id", "chunk_index", "kind", *FIELDS), "example-lengths")
    return split_exact(rows, ["doc_id", "chunk_index"], train_ratio, val_ratio, seed)
