"""Token, n-gram and subsequence overlap between two texts of one row.

All of it works inside the row, so scoring a table needs no shuffle.
"""

import pandas as pd
from pyspark.sql import Column, functions as F

from sparkprep.functions.bind import bind

LATIN = "[^a-z0-9]+"
UNICODE = r"[^\p{L}\p{N}]+"


def tokens(text: Column, unicode: bool = True) -> Column:
    """Lower-case tokens. Without ``unicode`` only a-z and 0-9 make up tokens."""
    spaced = F.regexp_replace(F.lower(text), UNICODE if unicode else LATIN, " ")
    return F.array_remove(F.split(spaced, " "), "")


def ngrams(token_list: Column, n: int | Column) -> Column:
    """All n-grams in order, as text joined by one blank."""
    width = F.lit(n) if isinstance(n, int) else n
    return bind(
        token_list,
        lambda t: F.when(
            F.size(t) >= width,
            F.transform(
                F.sequence(F.lit(1), F.size(t) - width + 1),
                lambda i: F.array_join(F.slice(t, i, width), " "),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


def ngram_hashes(token_list: Column, n: Column) -> Column:
    """A 64-bit hash of each n-gram in order; numbers are compared and sorted without building texts.

    Two n-grams of a row have one hash with a probability below its number of pairs of n-grams over 2^64.
    """
    places = F.sequence(F.lit(1), F.size(token_list) - n + 1)
    grams = F.transform(places, lambda i: F.xxhash64(F.slice(token_list, i, n)))
    return F.when(F.size(token_list) >= n, grams).otherwise(F.array().cast("array<bigint>"))


def ngram_overlaps(left: Column, right: Column, top: int) -> Column:
    """``array<int>``: the clipped overlap of the n-grams for n = 1 to ``top``."""

    def overlap(tokens: Column, n: Column) -> Column:
        sides = F.struct(ngram_hashes(tokens["l"], n).alias("l"), ngram_hashes(tokens["r"], n).alias("r"))
        return bind(sides, lambda s: clipped_overlap(s["l"], s["r"], "bigint"))

    both = F.struct(left.alias("l"), right.alias("r"))
    return bind(both, lambda tokens: F.transform(F.sequence(F.lit(1), F.lit(top)), lambda n: overlap(tokens, n)))


def clipped_overlap(left: Column, right: Column, kind: str = "string") -> Column:
    """Size of the multiset intersection of two arrays of strings, or of ``kind``.

    The intersection of the distinct elements counts each shared one once. What occurs
    again, usually a small part, is intersected as multisets.
    """
    return F.size(F.array_intersect(left, right)) + _repeats_in_common(
        _repeats(left), _repeats(right), kind
    )


def _repeats(items: Column) -> Column:
    """Every occurrence of a string but its first."""
    return bind(
        F.sort_array(items), lambda s: F.filter(s, lambda v, i: v == F.get(s, i - 1))
    )


def _repeats_in_common(left: Column, right: Column, kind: str) -> Column:
    """Both sides are tagged, sorted together and read once.

    Equal strings stand next to each other; each run adds the smaller of its counts.
    """

    def tagged(items: Column, l: int, r: int) -> Column:
        return F.transform(
            items, lambda s: F.struct(s.alias("s"), F.lit(l).alias("l"), F.lit(r).alias("r"))
        )

    def state(s: Column, l: Column, r: Column, hits: Column) -> Column:
        return F.struct(s.alias("s"), l.alias("l"), r.alias("r"), hits.alias("hits"))

    def step(run: Column, item: Column) -> Column:
        same = state(run["s"], run["l"] + item["l"], run["r"] + item["r"], run["hits"])
        closed = run["hits"] + F.least(run["l"], run["r"])
        return F.when(run["s"] == item["s"], same).otherwise(
            state(item["s"], item["l"], item["r"], closed)
        )

    return F.aggregate(
        F.sort_array(F.concat(tagged(left, 1, 0), tagged(right, 0, 1))),
        state(F.lit(None).cast(kind), F.lit(0), F.lit(0), F.lit(0)),
        step,
        lambda run: run["hits"] + F.least(run["l"], run["r"]),
    )


def f_measure(hits: Column, predicted: Column, expected: Column) -> Column:
    """F1 of precision ``hits/predicted`` and recall ``hits/expected``; 0 without hits."""
    return F.when(hits > 0, F.lit(2.0) * hits / (predicted + expected)).otherwise(F.lit(0.0))


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two numeric arrays; null if one has no length."""

    def dot(a: Column, b: Column) -> Column:
        products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)

    return F.try_divide(
        dot(left, right), F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    )


LCS_BLOCK = 4096


def common_subsequence(a, b) -> int:
    """Length of the longest common subsequence of two token lists.

    A row of the dynamic-programming table is kept as bits, so the work per token is a few
    wide additions. The bits are those of ``LCS_BLOCK`` tokens at a time; what an addition
    carries out of a block goes into the next one. So the tokens' masks stay small, and
    book-sized texts need little more memory than themselves.
    """
    carry, unmatched = bytearray(len(b)), 0
    for begin in range(0, len(a), LCS_BLOCK):
        block = a[begin : begin + LCS_BLOCK]
        places: dict[str, int] = {}
        for i, token in enumerate(block):
            places[token] = places.get(token, 0) | (1 << i)
        size = len(block)
        row = full = (1 << size) - 1
        for j, token in enumerate(b):
            match = row & places.get(token, 0)
            grown = row + match + carry[j]
            carry[j] = grown >> size
            row = (grown | (row - match)) & full
        unmatched += row.bit_count()
    return len(a) - unmatched


def lcs_length():
    """:func:`common_subsequence` as a vectorised UDF.

    Spark has no two-sequence recurrence, so this is the one metric in Python.
    """

    @F.pandas_udf("int")
    def udf(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(
            [None if a is None or b is None else common_subsequence(a, b) for a, b in zip(left, right)],
            dtype="Int32",
        )

    return udf
