"""Hooks for user code that Spark has no expressions for: models, parsers, tokenizers.

Each runs in Arrow batches inside the tasks. ``load`` is called once per task and
returns the function to apply, so a model is not shipped with the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from sparkprep.functions.text import keywords

PAGE_TYPE = "array<struct<page_no:int,text:string>>"


def score_batch(
    prompts: DataFrame,
    load: Callable[[], Callable[[list[str], dict], list[str]]],
    parameters: dict | None = None,
    prompt: str = "prompt",
    output: str = "prediction",
) -> DataFrame:
    """Add the model's answer to each prompt.

    ``parameters`` (for instance ``temperature`` and ``max_tokens``) go to every call.
    """
    parameters = dict(parameters or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            yield batch.assign(**{output: model(batch[prompt].tolist(), parameters)})

    schema = T.StructType(prompts.schema.fields + [T.StructField(output, T.StringType())])
    return prompts.mapInPandas(run, schema)


def extract_pages(
    files: DataFrame, load: Callable[[], Callable[[bytes], list[str]]]
) -> DataFrame:
    """``path, pages, error`` from ``path, content``: one row per file.

    A file the parser fails on gets its message in ``error`` and no pages, and the rest
    goes on.
    """

    def parse(parser, content: bytes):
        try:
            texts = parser(bytes(content))
            return [{"page_no": i, "text": t} for i, t in enumerate(texts, 1)], None
        except Exception as failure:  # whatever a parser raises belongs to its file
            return None, f"{type(failure).__name__}: {failure}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = load()
        for batch in batches:
            results = [parse(parser, content) for content in batch["content"]]
            yield pd.DataFrame(
                {
                    "path": batch["path"],
                    "pages": [pages for pages, _ in results],
                    "error": [error for _, error in results],
                }
            )

    path_type = files.schema["path"].dataType.simpleString()
    return files.select("path", "content").mapInPandas(
        run, f"path {path_type}, pages {PAGE_TYPE}, error string"
    )


def quarantine(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, failed) rows of something with an ``error`` column."""
    good = extracted.filter(F.col("error").isNull()).drop("error")
    return good, extracted.filter(F.col("error").isNotNull()).select("path", "error")


def pad_tokens(rows: DataFrame, tokens: str, max_length: int, padding) -> DataFrame:
    """Replace array column ``tokens`` by ``input_ids, attention_mask, labels``.

    All have ``max_length`` entries; labels repeat the ids.
    """
    kept = F.slice(tokens, 1, max_length)
    missing = F.lit(max_length) - F.size(kept)
    ids = F.concat(kept, F.array_repeat(F.lit(padding), missing))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(kept)), F.array_repeat(F.lit(0), missing))
    return rows.select(
        *(c for c in rows.columns if c != tokens),
        ids.alias("input_ids"),
        mask.alias("attention_mask"),
        ids.alias("labels"),
    )


def token_budget(
    texts: DataFrame, max_length: int, text: str = "text", padding: str = "<pad>"
) -> DataFrame:
    """White-space tokens of each text, cut and padded; see :func:`pad_tokens`.

    A text is read up to its last token that counts.
    """
    cut = F.array_remove(F.split(keywords(F.col(text), max_length), " "), "")
    return pad_tokens(texts.withColumn("_tokens", cut), "_tokens", max_length, padding)


def tokenize(
    texts: DataFrame,
    load: Callable[[], Callable[[list[str]], list[list[int]]]],
    max_length: int,
    padding: int = 0,
    text: str = "text",
) -> DataFrame:
    """:func:`token_budget` with the ids of a tokenizer.

    Cutting and padding stay in Spark; only the tokenizer itself runs in Python.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load()
        for batch in batches:
            yield batch.assign(_tokens=encode(batch[text].tolist()))

    ids = T.StructField("_tokens", T.ArrayType(T.IntegerType()))
    encoded = texts.mapInPandas(run, T.StructType(texts.schema.fields + [ids]))
    return pad_tokens(encoded, "_tokens", max_length, padding)
