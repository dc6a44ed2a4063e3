"""Raw documents to packed training sequences: each stage is one operator of ``sparkprep.llm``.

Stages take and return tables with the columns of ``documents``; the last returns the pieces of
sequences. Each works on all documents that the one before kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.llm.fingerprints import exact_groups
from sparkprep.llm.jaccard import similar_documents
from sparkprep.llm.language import UNDETERMINED, identify, train
from sparkprep.llm.packing import pack_documents
from sparkprep.llm.substrings import remove_repeats
from sparkprep.plans.staging import stage_alone, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LEAST_SCORE = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OWN = ("doc_id", "text", "lang", "n_chars")


def columns_apart(step: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that sees the columns ``OWN`` under their names and all others under names that no operator uses.

    It returns the columns that it got. So extra columns of any name pass through.
    """

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: f"column_{i}" for i, c in enumerate(docs.columns) if c not in OWN}
        result = step(docs.withColumnsRenamed(names)).select([names.get(c, c) for c in docs.columns])
        return result.withColumnsRenamed({v: k for k, v in names.items()})

    return run


@columns_apart
def name_language(docs: DataFrame) -> DataFrame:
    """Documents of a known language stay: those with a letter that one language explains better than the others together.

    The contexts are learned from the documents' own language marks; a missing mark is filled in, and a
    mark that the text contradicts stays. Where no document has a mark, no language can be told from another, and all
    documents with a letter stay. A null or empty text goes, repeated rows are judged alike, and an
    empty table gives an empty result.
    """
    others = [c for c in docs.columns if c != "doc_id"]
    contexts = train(docs)
    if not contexts.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = identify(docs, contexts, keep=others)
    sure = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return found.filter(sure).withColumn("lang", F.coalesce("lang", "lang_pred"))


@columns_apart
def drop_copies(docs: DataFrame) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the document with the largest id stays, once.

    A null text counts as empty; a null id is smaller than any other. Of repeated rows one stays. An empty table
    gives an empty result.
    """
    known = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("known_id")
    kept = exact_groups(docs).filter("kept").select(known, "text_sha256").distinct()
    digest = F.sha2(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), 256).alias("text_sha256")
    keys = ["known_id", "text_sha256"]
    return docs.select("*", known, digest).join(kept.hint("merge"), keys, "left_semi").dropDuplicates(keys)


@columns_apart
def drop_near_copies(docs: DataFrame) -> DataFrame:
    """Of documents that links of similar word 5-grams connect, the one with the smallest id stays.

    A null or empty text is similar to nothing and stays, and so does a document with a null id. Rows with one id
    stay or go together. An empty table gives an empty result.
    """
    kept = similar_documents(docs).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept.hint("merge"), F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


@columns_apart
def drop_repeats(docs: DataFrame) -> DataFrame:
    """Words of repeated passages go, with the white space after each; all other text stays as it is.

    A document of which nothing is left stays with an empty text, and a null text becomes empty. Rows that
    repeat each other lose their windows in all copies. An empty table gives an empty result.
    """
    left = remove_repeats(docs, keep=[c for c in docs.columns if c not in ("doc_id", "text", "n_chars")], layout=True)
    return left.withColumn("n_chars", F.char_length("kept_text").cast("long")).withColumnRenamed("kept_text", "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 token ids, as pieces of documents with their ids.

    A null or empty text has one id, that of its end. Repeated rows are packed each. An empty table gives no
    sequence; other columns are ignored.
    """
    return pack_documents(docs, TOKENIZER, with_ids=True)


STAGES = [
    ("language_id", name_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("packing", pack),
]
# SQL cannot express the language model; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written as Parquet and read again.

    What a stage wrote for itself is deleted after it.
    """
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage_alone(lambda: step(spark, docs, sf_dir), name)
    return docs
