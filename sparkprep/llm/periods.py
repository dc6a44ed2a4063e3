"""Periodic runs of words, found online by catchers over completed power-of-two blocks.

A stream of words is cut into blocks of 1, 2, 4, ... words. The catcher of a block compares the
block with the words that follow at a distance of one block up to two; where they are equal, two
neighbouring parts of the text may be a square. The suffix comparison of such a catch advances with
each appended word. Squares of one period that touch merge into one run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkprep.llm.batches import mix, slices, utf8, word_ids, words
from sparkprep.llm.session import bound_batches

CHUNK = 1 << 16
LEAST_EXPONENT = 4


class Catchers:
    """The runs of a growing sequence of word numbers whose period occurs ``exponent`` times or more.

    A run with period q and 2^k <= q < 2^(k+1) holds the first whole block of 2^k words after its
    start, and from there three periods at least, as the exponent is four or more. So that
    block's catcher meets it. Names of blocks are hashes, which only suggest catches: the words
    are compared. ``longest`` bounds the length of runs where it is known, as for many short texts.

    Levels hold the names of as many words as their blocks may still be compared with, so the
    state is a few numbers for each word.
    """

    def __init__(self, exponent: int = LEAST_EXPONENT, longest: int | None = None):
        if exponent < LEAST_EXPONENT:
            raise ValueError(f"the exponent must be {LEAST_EXPONENT} or more")
        self.exponent, self.longest = exponent, longest
        self.ids = np.zeros(0, np.int64)
        self.names: list[np.ndarray] = []
        self.first: list[int] = []  # the position of each level's first name
        self.waiting: list[np.ndarray] = []  # each level's catches whose third period is not complete
        self.last: dict[int, list[int]] = {}  # the latest stretch of each period
        self.open: list[list[int]] = []
        self.closed: list[list[int]] = []
        self.known = np.zeros((0, 3), np.int64)  # closed runs, as far as they were moved here

    def append(self, ids: np.ndarray) -> None:
        """Advance all comparisons over further words."""
        self.ids = np.concatenate([self.ids, ids])
        self.known = np.concatenate([self.known, self._whole(self.closed)])
        still, self.open, self.closed = self.open, [], []
        for stretch in still:
            stretch[1] = self._right(stretch[1] - stretch[2], stretch[2])
            self._place(stretch)
        for k in range(self._levels()):
            b, q = self._new(np.concatenate([*self.waiting[k : k + 1], self._catch(k)], axis=1), 1 << k)
            ready = b + 3 * q <= len(self.ids)
            self.waiting[k : k + 1] = [np.stack([b[~ready], q[~ready]])]
            self._verify(b[ready], q[ready])

    def runs(self) -> np.ndarray:
        """``start, end, period`` of the runs so far, one in a row, by start and period."""
        found = np.concatenate([self.known, self._whole([*self.closed, *self.open])])
        return found[np.lexsort((found[:, 2], found[:, 0]))]

    def _whole(self, stretches: list[list[int]]) -> np.ndarray:
        rows = np.array(stretches, np.int64).reshape(-1, 3)
        return rows[rows[:, 1] - rows[:, 0] >= self.exponent * rows[:, 2]]

    def _new(self, catches: np.ndarray, size: int) -> np.ndarray:
        """The catches at a distance q that no run of a period up to ``size`` holds with both blocks.

        Within such a run q is a multiple of its period, so a square of q that goes on for a third
        period is part of that run.
        """
        if not catches.shape[1]:
            return catches
        runs = np.concatenate([self.known[self.known[:, 1] > catches[0].min()], self._whole([*self.closed, *self.open])])
        runs = runs[runs[:, 2] <= size]
        if not len(runs):
            return catches
        runs = runs[np.argsort(runs[:, 0], kind="stable")]
        at = np.searchsorted(runs[:, 0], catches[0], "right") - 1
        end = np.maximum.accumulate(runs[:, 1])[np.maximum(at, 0)]
        return catches[:, (at < 0) | (end < catches.sum(axis=0) + size)]

    def _levels(self) -> int:
        longest = len(self.ids) if self.longest is None else min(self.longest, len(self.ids))
        return (longest // self.exponent).bit_length()

    def _catch(self, k: int) -> np.ndarray:
        """Name the windows of 2^k words that became whole; blocks and distances at which they recur."""
        size = 1 << k
        if k == len(self.names):  # a new level names all words there are
            self.names.append(np.zeros(0, np.uint64))
            self.first.append(0)
        names, first = self.names[k], self.first[k]
        begin = first + len(names)
        if k == 0:
            new = mix(self.ids[begin:].view(np.uint64) + np.uint64(1))
        else:
            below, shift = self.names[k - 1], self.first[k - 1]
            left = below[begin - shift :]
            half = size >> 1
            new = mix(left[:-half] * np.uint64(0x9E3779B97F4A7C15) + left[half:]) if len(left) > half else left[:0]
        names = np.concatenate([names, new])
        at = np.arange(max(begin, size), begin + len(new))
        block = ((at >> k) - 1) << k
        hit = np.flatnonzero(names[at - first] == names[block - first])
        above = self.first[k + 1] + len(self.names[k + 1]) if k + 1 < len(self.names) else 0
        spare = max(0, min(((begin + len(new)) >> k) - 2 << k, above) - first)
        self.names[k], self.first[k] = names[spare:], first + spare
        return np.stack([block[hit], at[hit] - block[hit]])

    def _verify(self, b: np.ndarray, q: np.ndarray) -> None:
        """Extend catches to the stretches that have their periods."""
        ids = self.ids
        order = np.lexsort((b, q))
        b, q = b[order], q[order]
        for place in (0, 1, 2, 3):  # most wrong ones differ in the first or last word of a period
            step = [0 * q, q - 1, q, 2 * q - 1][place]
            equal = ids[b + step] == ids[b + step + q]
            b, q = b[equal], q[equal]
        for begin, period in zip(b.tolist(), q.tolist()):
            known = self.last.get(period)
            if known and begin < known[1] - period:
                continue
            end = self._right(begin, period)
            if end < begin + 3 * period:
                continue
            stretch = [self._left(begin, period), end, period]
            self.last[period] = stretch
            self._place(stretch)

    def _place(self, stretch: list[int]) -> None:
        (self.open if stretch[1] == len(self.ids) else self.closed).append(stretch)

    def _right(self, at: int, period: int) -> int:
        """Where the stretch that has the period around ``at`` ends."""
        ids, step = self.ids, 64
        while at + period < len(ids):
            stop = min(at + step, len(ids) - period)
            other = ids[at:stop] != ids[at + period : stop + period]
            if other.any():
                return at + int(other.argmax()) + period
            at, step = stop, step * 2
        return len(ids)

    def _left(self, at: int, period: int) -> int:
        """Where the stretch that has the period around ``at`` starts."""
        ids, step = self.ids, 64
        while at:
            stop = max(at - step, 0)
            other = ids[stop:at] != ids[stop + period : at + period]
            if other.any():
                return at - int(other[::-1].argmax())
            at, step = stop, step * 2
        return 0


def text_runs(ids: np.ndarray, counts: np.ndarray, exponent: int = LEAST_EXPONENT) -> tuple[np.ndarray, np.ndarray]:
    """Text and ``start, end, period`` of the runs of texts with ``counts`` words each, one after the other."""
    base = np.concatenate([[0], np.cumsum(counts)])
    marks = -1 - np.arange(len(counts))  # a value of its own after each text
    joined = np.insert(ids.astype(np.int64), base[1:], marks)
    catchers = Catchers(exponent, int(counts.max(initial=0)))
    for begin in range(0, len(joined), CHUNK):
        catchers.append(joined[begin : begin + CHUNK])
    runs = catchers.runs()
    starts = base[:-1] + np.arange(len(counts))
    owner = np.searchsorted(starts, runs[:, 0], "right") - 1
    return owner, runs - np.stack([starts[owner], starts[owner], np.zeros(len(runs), np.int64)], axis=1)


def periodic_runs(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text", least: int = 6, exponent: int = LEAST_EXPONENT
) -> DataFrame:
    """``<id>, n_words, runs, collapsed`` for each row.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` of the whole text. ``runs`` lists, by start and
    period, ``start, length, period`` of each stretch of consecutive words with smallest period
    q (words q apart are identical) that is at least ``least`` words and ``exponent`` periods long
    and that no neighbouring word extends. ``collapsed`` joins by one space the words that lie
    in no run after the run's first period. A null, empty or blank text has no words, no runs and
    an empty ``collapsed``. Rows are judged by themselves, repeated ones and those with a null
    id too, without a shuffle. An empty table gives an empty result; other columns are ignored.

    A batch of texts is one stream for the catchers, with a word of its own after each text.
    """
    bound_batches(documents.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, offsets = utf8(batch.column("text"))
            first, last, doc = words(raw, offsets)
            base = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            owner, runs = text_runs(word_ids(raw, first, last)[0], np.diff(base), exponent)
            long = runs[:, 1] - runs[:, 0] >= least
            owner, runs = owner[long], runs[long]
            change = np.zeros(len(first) + 1, np.int64)
            np.add.at(change, base[owner] + runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, base[owner] + runs[:, 1], -1)
            stays = np.cumsum(change)[:-1] == 0
            some = np.zeros(batch.num_rows, bool)
            some[owner] = True
            left = []
            for row in range(batch.num_rows):
                a, b = base[row], base[row + 1]
                whole = raw[first[a] : last[b - 1]].tobytes().split() if b > a else []
                left.append(b" ".join([w for w, s in zip(whole, stays[a:b].tolist()) if s] if some[row] else whole).decode())
            fields = [runs[:, 0], runs[:, 1] - runs[:, 0], runs[:, 2]]
            rows = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in fields], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)), rows)
            arrays = [batch.column("id"), pa.array(np.diff(base)), lists, pa.array(left, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "runs", "collapsed"])

    columns = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = columns.schema["id"].dataType.simpleString()
    found = columns.mapInArrow(find, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return found.withColumnRenamed("id", id)
