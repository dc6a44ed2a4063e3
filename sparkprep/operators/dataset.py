"""Checks of a training set as a whole: duplicates, leakage, coverage, diversity, relevance, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.functions.overlap import tokens
from sparkprep.functions.text import strip


def content_key(*columns: str) -> Column:
    """A hash of the columns' contents; null differs from empty."""
    return F.md5(F.concat(*(F.coalesce(F.md5(c), F.lit("-")) for c in columns)))


def duplicate_inputs(examples: DataFrame, text: str = "input_text", splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """``input_key, count, <split>…, leaked`` for each input that occurs more than once.

    Inputs are compared after stripping and lower-casing, by their MD5. There is a count for
    each split; ``leaked`` says that several splits have the input. Counts add up before the
    shuffle, so an input that is everywhere is a few rows.
    """
    counts = [F.count_if(F.col("split") == s).alias(s) for s in splits]
    grouped = examples.groupBy(F.md5(strip(F.lower(text))).alias("input_key")).agg(F.count("*").alias("count"), *counts)
    holding = sum((F.col(s) > 0).cast("int") for s in splits)
    return grouped.filter("count > 1").withColumn("leaked", (holding > 1).cast("int"))


def coverage(documents: DataFrame, used: DataFrame, text: str = "text", part: str = "output_text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, source_characters, covered_characters, coverage``: how much of each document its examples hold.

    A character counts once, however many parts hold it. Parts are found in the document,
    first occurrence first, after white space is dropped on both sides, because chunking
    rewrites it; a part that is not found covers nothing.
    """
    bare = lambda c: F.regexp_replace(c, r"[ \t\n\r\f\x0B]+", "")
    parts = used.groupBy(doc_id).agg(F.collect_set(bare(F.col(part))).alias("parts"))
    rows = documents.select(doc_id, bare(F.coalesce(F.col(text), F.lit(""))).alias("body")).join(parts, doc_id, "left")
    spans = F.transform(
        F.filter(F.coalesce("parts", F.array()), lambda p: (p != "") & (F.instr(F.col("body"), p) > 0)),
        lambda p: F.struct(F.instr(F.col("body"), p).alias("start"), (F.instr(F.col("body"), p) + F.length(p)).alias("end")),
    )
    start = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("end"))

    def add(state: Column, span: Column) -> Column:
        fresh = F.greatest(span["end"] - F.greatest(span["start"], state["end"]), F.lit(0))
        return F.struct((state["covered"] + fresh).alias("covered"), F.greatest(state["end"], span["end"]).alias("end"))

    covered = F.aggregate(F.sort_array(spans), start, add)["covered"]
    counted = rows.select(doc_id, F.length("body").alias("source_characters"), covered.alias("covered_characters"))
    return counted.withColumn("coverage", F.coalesce(F.try_divide("covered_characters", "source_characters"), F.lit(0.0)))


def diversity(examples: DataFrame, kind: str = "template", text: str = "input_text") -> DataFrame:
    """One row: ``examples, kinds, entropy, evenness, distinct_inputs``.

    Entropy is over the shares of the kinds, in bits; evenness relates it to the most there
    could be with as many kinds. Inputs are counted exactly.
    """
    kinds = examples.groupBy(kind).agg(F.count("*").alias("n"))
    total = F.sum("n")
    entropy = F.log2(total) - F.sum(F.col("n") * F.log2("n")) / total
    shares = kinds.agg(F.coalesce(total, F.lit(0)).alias("examples"), F.count("*").alias("kinds"), F.coalesce(entropy, F.lit(0.0)).alias("entropy"))
    evenness = F.when(F.col("kinds") > 1, F.col("entropy") / F.log2("kinds")).otherwise(1.0)
    distinct = examples.agg(F.count_distinct(F.md5(text)))
    return shares.withColumn("evenness", evenness).withColumn("distinct_inputs", distinct.scalar())


def relevance(examples: DataFrame, left: str = "input_text", right: str = "output_text") -> DataFrame:
    """The rows with ``relevance``: the Jaccard similarity of the token sets of two texts."""
    a, b = F.array_distinct(tokens(F.col(left))), F.array_distinct(tokens(F.col(right)))
    both = F.size(F.array_intersect(a, b))
    return examples.withColumn("relevance", F.coalesce(F.try_divide(both, F.size(a) + F.size(b) - both), F.lit(0.0)))


def version_diff(old: DataFrame, new: DataFrame, columns: tuple[str, ...] = ("input_text", "output_text")) -> DataFrame:
    """``content_key, old_count, new_count, change`` for each content of two versions of a set.

    ``change`` is ``added``, ``removed`` or ``kept``; the counts tell about repeated rows. Each
    side is counted by the hash of its contents first, so the join gets a hash once.
    """
    counted = [
        df.groupBy(content_key(*columns).alias("content_key")).agg(F.count("*").alias(name)) for df, name in ((old, "old_count"), (new, "new_count"))
    ]
    joined = counted[0].join(counted[1], "content_key", "full").fillna(0, ["old_count", "new_count"])
    change = F.when(F.col("old_count") == 0, "added").when(F.col("new_count") == 0, "removed").otherwise("kept")
    return joined.withColumn("change", change)
