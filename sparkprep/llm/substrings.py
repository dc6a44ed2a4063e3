"""Removal of long repeated passages, found by recompression.

Each round names maximal runs of a symbol, then pairs of a left and a right symbol (a hash of
the symbol says which it is). Names are hashes of what they stand for, so all tasks give equal
names to equal strings without exchanging a dictionary, and equal passages get equal symbols
inside, except near their ends. A symbol's context is the span of words that fixes it.

Every window of words is assigned one of the symbols whose context it holds, chosen by the
window's content alone, so equal windows have equal symbols at equal places. Symbols whose
context occurs once clear all their windows; the others are verified.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.llm.batches import Spans, mix, signed, slices, utf8, word_hashes, words
from sparkprep.llm.session import bound_batches, release_shuffles
from sparkprep.plans.staging import stage, unstage

ROUNDS = 3


class Symbols:
    """The symbols of one level over all texts of a batch, with the context that fixes each.

    ``left`` and ``right`` bound the context in words; they lie outside the text for a symbol
    whose context would reach beyond it. Both rise with the position.
    """

    def __init__(self, hashes: np.ndarray, doc: np.ndarray):
        self.name, self.doc = hashes, doc
        self.start = self.left = np.arange(len(hashes))
        self.right = self.left + 1

    def _join(self, heads: np.ndarray, name: np.ndarray) -> None:
        """Make one symbol of those from each head up to the next."""
        lasts = np.append(heads[1:], len(self.name)) - 1
        doc = self.doc[heads]
        before, after = np.maximum(heads - 1, 0), np.minimum(lasts + 1, len(self.name) - 1)
        inside = (heads > 0) & (self.doc[before] == doc)
        self_left = np.where(inside, self.left[before], self.start[heads] - 1)
        inside = (lasts + 1 < len(self.name)) & (self.doc[after] == doc)
        ends = np.append(self.start[1:], self.words)[lasts]
        self.right = np.where(inside, self.right[after], ends + 1)
        self.left, self.start, self.doc, self.name = self_left, self.start[heads], doc, name

    def round(self, number: int) -> None:
        name, doc = self.name, self.doc
        self.words = getattr(self, "words", len(name))
        head = np.ones(len(name), bool)
        head[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(head)
        length = np.diff(heads, append=len(name)).astype(np.uint64)
        self._join(heads, np.where(length > 1, mix(name[heads] * np.uint64(3) + length), name[heads]))
        name, doc = self.name, self.doc
        right = (mix(name + np.uint64(number * 2 + 1)) & np.uint64(1)).astype(bool)
        head = np.ones(len(name), bool)
        head[1:] = ~(right[1:] & ~right[:-1] & (doc[1:] == doc[:-1]))
        heads = np.flatnonzero(head)
        paired = np.diff(heads, append=len(name)) > 1
        second = name[np.minimum(heads + 1, len(name) - 1)]
        self._join(heads, np.where(paired, mix(mix(name[heads]) + second), name[heads]))


def anchors(hashes: np.ndarray, doc: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """Each window of ``size`` words, in groups of neighbours that have one symbol, or one content, in common.

    ``first`` and ``last`` are the group's windows, ``name`` stands for the symbol with its
    context, and ``f1, f2`` for all words of the group's windows and the symbol's place there.
    Windows that hold no symbol's context, as inside long runs, stand for themselves: ``name``
    and ``f1`` are the window's own hash, and all windows of a group are equal.
    """
    at = np.flatnonzero(doc[: len(doc) - size + 1] == doc[size - 1 :]) if len(doc) >= size else np.zeros(0, int)
    if not len(at):
        return {c: np.zeros(0, np.int64) for c in ("doc", "name", "f1", "f2", "first", "last")}
    level = Symbols(hashes, doc)
    for number in range(ROUNDS):
        level.round(number)
    low, high = np.searchsorted(level.left, at), np.searchsorted(level.right, at + size, "right") - 1
    symbol = np.where(low <= high, _least(mix(level.name), low, np.maximum(high, low)), -1)

    spans, others = Spans(hashes), Spans(hashes, 1)
    alone = symbol < 0
    own = np.where(alone, spans(at, at + size), symbol.astype(np.uint64))
    new = np.ones(len(at), bool)
    new[1:] = (own[1:] != own[:-1]) | (alone[1:] != alone[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    first, last = at[begin], at[np.append(begin[1:], len(at)) - 1]
    k, alone = symbol[begin], alone[begin]
    place = (level.start[k] - first).astype(np.uint64)
    name = np.where(alone, own[begin], mix(spans(np.maximum(level.left[k], 0), np.minimum(level.right[k], len(doc))) + (level.start[k] - level.left[k]).astype(np.uint64)))
    last_word = np.where(alone, first, last) + size
    f1 = np.where(alone, name, mix(spans(first, last_word) + place + np.uint64(1)))
    f2 = np.where(alone, others(first, last_word), mix(others(first, last_word) + place))
    return {"doc": doc[first], "name": signed(name), "f1": signed(f1), "f2": signed(f2), "first": first, "last": last}


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each range ``low..high`` the index of the least value, the leftmost of equals."""
    tables = [np.arange(len(values))]
    widest = int((high - low).max()) + 1
    while (2 << (len(tables) - 1)) <= widest:
        left, step = tables[-1], 1 << (len(tables) - 1)
        right = left[np.minimum(np.arange(len(left)) + step, len(left) - 1)]
        tables.append(np.where(values[left] <= values[right], left, right))
    power = np.log2(high - low + 1).astype(int)
    table, low, high = np.stack(tables), np.minimum(low, len(values) - 1), np.minimum(high, len(values) - 1)
    left, right = table[power, low], table[power, np.maximum(high - (1 << power) + 1, low)]
    return np.where(values[left] <= values[right], left, right)


KEY = ["doc_id", "text_key"]


def _doc_words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets, word starts, word ends, document and first word of each document."""
    raw, offsets = utf8(batch.column("text"))
    starts, ends, doc = words(raw, offsets)
    return raw, offsets, starts, ends, doc, np.searchsorted(doc, np.arange(batch.num_rows + 1))


def _keys(batch: pa.RecordBatch, rows: np.ndarray) -> list[pa.Array]:
    return [batch.column(c).take(pa.array(rows)) for c in KEY]


def _find_anchors(documents: DataFrame, size: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, _, starts, ends, doc, base = _doc_words(batch)
            found = anchors(word_hashes(raw, starts, ends), doc, size)
            of = found.pop("doc")
            for c in ("first", "last"):
                found[c] = (found[c] - base[of]).astype(np.int32)
            found["f2"] = found["f2"].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*_keys(batch, of), *map(pa.array, found.values())], [*KEY, *found])

    return documents.mapInArrow(find, f"{_key_types(documents)}, name long, f1 long, f2 int, first int, last int")


def _key_types(documents: DataFrame) -> str:
    return ", ".join(f"{c} {documents.schema[c].dataType.simpleString()}" for c in KEY)


def _same_document(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the key; the id may be null. The hint keeps the plan the same at every size."""
    right = right.withColumnsRenamed({c: f"other_{c}" for c in KEY}).hint("merge")
    same = left["doc_id"].eqNullSafe(F.col("other_doc_id")) & (left["text_key"] == F.col("other_text_key"))
    return left.join(right, same, how).drop(*(f"other_{c}" for c in KEY))


def _windows(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``w1, w2, at, copies`` of each window in the wanted ranges; known repeats count as two copies."""
    ranges = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("first", "last", "known")).alias("ranges"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, _, starts, ends, doc, base = _doc_words(batch)
            hashes = word_hashes(raw, starts, ends)
            lists = batch.column("ranges")
            counts = np.diff(lists.offsets.to_numpy())
            of = np.repeat(np.arange(batch.num_rows), counts)
            first, last, known = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
            many = (last - first + 1).astype(np.int64)
            of, known = np.repeat(of, many), np.repeat(known, many)
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
            begin = at + base[of]
            found = [signed(Spans(hashes, k)(begin, begin + size)) for k in (0, 1)]
            arrays = [*_keys(batch, of), *map(pa.array, found), pa.array(at.astype(np.int32)), pa.array(1 + known.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, [*KEY, "w1", "w2", "at", "copies"])

    joined = _same_document(documents, ranges).select(*KEY, "text", "ranges")
    return joined.mapInArrow(hashed, f"{_key_types(documents)}, w1 long, w2 long, at int, copies int")


def repeated_windows(documents: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_key, first, last``: ranges of windows whose words also start elsewhere.

    1. Groups of windows with one symbol are counted by the symbol's context. Those of a
       context that occurs once are unique.
    2. Of the others, a group whose words, all of them, occur again is repeated.
    3. Only where groups share a context but not all words, single windows are counted; of
       equal groups one stands for all.

    Counting adds up in the tasks before it shuffles. Counts are written before they are
    joined back, so that the joins have nothing to keep together and Spark splits the rows of
    a frequent key. Where hashes decide, they are of 61 and 32 bits by independent bases, over
    keyed hashes of the words.
    """
    spark = documents.sparkSession
    groups = stage(_find_anchors(documents, size), "window-groups")
    copies = F.sum(F.when(F.col("name") == F.col("f1"), F.col("last") - F.col("first") + 1).otherwise(1)).alias("copies")
    uniform = (F.min("f1") == F.max("f1")) & (F.min("f2") == F.max("f2"))
    names = groups.groupBy("name").agg(copies, uniform.alias("uniform")).filter("copies > 1").drop("copies")
    names = stage(names, "shared-names")
    shared = stage(groups.join(names.hint("merge"), "name"), "shared-groups")
    unstage(groups)
    release_shuffles(spark)

    mixed = shared.filter("NOT uniform")
    spot = F.struct(*KEY, "first")
    fulls = stage(mixed.groupBy("name", "f1", "f2").agg(copies, F.min(spot).alias("lead")), "full-groups")
    mixed = stage(mixed.join(fulls.hint("merge"), ["name", "f1", "f2"]).withColumn("leads", spot.eqNullSafe(F.col("lead"))), "mixed-groups")
    known = F.col("copies") > 1
    wanted = mixed.filter(~known | F.col("leads")).select(*KEY, "first", "last", known.alias("known"))
    windows = stage(_windows(documents, wanted, size), "windows")
    release_shuffles(spark)
    again = stage(windows.groupBy("w1", "w2").agg(F.sum("copies").alias("n")).filter("n > 1").drop("n"), "window-counts")
    single = windows.filter("copies = 1").join(again.hint("merge"), ["w1", "w2"])
    ranges = [
        shared.filter("uniform").select(*KEY, "first", "last"),
        mixed.filter(known).select(*KEY, "first", "last"),
        single.select(*KEY, F.col("at").alias("first"), F.col("at").alias("last")),
    ]
    result = stage(ranges[0].unionByName(ranges[1]).unionByName(ranges[2]), "repeated-windows")
    for used in (names, shared, fulls, mixed, windows, again):
        unstage(used)
    release_shuffles(spark)
    return result


def remove_repeats(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = 35, keep: list[str] = (), layout: bool = False
) -> DataFrame:
    """``<id>, n_words, n_removed, kept_sha256, kept_text`` and the columns ``keep``, for each row.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` of the whole text, unchanged. A word goes if it
    lies in a window of ``size`` consecutive words that also starts anywhere else, in the same
    document or another; the input alone decides, not what is left. ``kept_text`` joins the
    other words by one space; with ``layout`` it is the text itself without the removed words and the
    white space after each. A null or empty text has no words and an empty kept text, and so
    has a text of white space; texts shorter than ``size`` words lose nothing. A row that
    repeats another repeats all its windows. Ids may be null or shared: a row is known by id
    and text together. An empty table gives an empty result; other columns are ignored.
    """
    bound_batches(documents.sparkSession)
    renamed = {f"keep{i}": c for i, c in enumerate(keep)}
    source = documents.select(
        F.col(id).alias("doc_id"), F.hash(text).alias("text_key"), F.col(text).alias("text"), *(F.col(c).alias(k) for k, c in renamed.items())
    )
    found = repeated_windows(source.select(*KEY, "text"), size)
    ranges = found.groupBy(*KEY).agg(F.collect_list(F.struct("first", "last")).alias("ranges"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, offsets, starts, ends, doc, base = _doc_words(batch)
            lists = batch.column("ranges").fill_null([])
            of = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            first, last = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in lists.flatten().flatten())
            change = np.zeros(len(starts) + 1, np.int64)
            np.add.at(change, base[of] + first, 1)
            np.add.at(change, base[of] + last + size, -1)
            stays = np.cumsum(change)[:-1] == 0
            total = np.diff(base)
            sums = np.concatenate([[0], np.cumsum(stays)])
            left = sums[base[1:]] - sums[base[:-1]]
            texts, spared = [], []
            if layout:
                following = np.append(starts[1:], len(raw))
                following[base[1:][total > 0] - 1] = offsets[1:][total > 0]  # the last word's white space ends with its text
                gone = np.zeros(len(raw) + 1, np.int64)
                np.add.at(gone, starts[~stays], 1)
                np.add.at(gone, following[~stays], -1)
                visible = np.cumsum(gone)[:-1] == 0
                whole = batch.column("text")
                for row in range(batch.num_rows):
                    span = slice(offsets[row], offsets[row + 1])
                    spared.append(raw[span][visible[span]].tobytes().decode() if left[row] < total[row] else whole[row].as_py() or "")
            for row in range(batch.num_rows):
                chosen = stays[base[row] : base[row + 1]]
                whole = raw[starts[base[row]] : ends[base[row + 1] - 1]].tobytes().split() if len(chosen) else []
                texts.append(b" ".join([w for w, s in zip(whole, chosen.tolist()) if s] if left[row] < total[row] else whole))
            arrays = [
                batch.column("doc_id"),
                *(batch.column(c) for c in renamed),
                pa.array(total),
                pa.array(total - left),
                pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                pa.array(spared if layout else [x.decode() for x in texts], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *renamed, "n_words", "n_removed", "kept_sha256", "kept_text"])

    joined = _same_document(source, ranges, "left").select("doc_id", *renamed, "text", "ranges")
    kinds = ", ".join(f"{c} {joined.schema[c].dataType.simpleString()}" for c in ["doc_id", *renamed])
    rows = joined.mapInArrow(clean, f"{kinds}, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return rows.withColumnsRenamed({"doc_id": id, **renamed})
