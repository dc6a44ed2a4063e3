"""A quality score: random Fourier features, ridge regression from summed normal equations, isotonic calibration."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkprep.llm.batches import slices, utf8, word_hashes, words
from sparkprep.llm.cache import built
from sparkprep.llm.session import bound_batches
from sparkprep.plans.staging import stage

FEATURES = [
    "log_words", "word_length", "repeats_word_before", "different_words", "most_frequent_word", "short_words",
    "long_words", "capital_first", "upper_letters", "digits", "sentence_marks", "other_marks", "sentence_ends",
    "odd_ends", "lone_marks", "line_ends", "different_lines",
]
DIMENSIONS = 256
BINS = 4096
SUMMED = 32


def _marks(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    return table


UPPER, DIGIT, SENTENCE = _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _marks("0123456789"), _marks(".,;:?'")
LETTERS = np.arange(256) >= 128
LETTERS[[*range(65, 91), *range(97, 123)]] = True
ODD = ~(LETTERS | DIGIT | SENTENCE)
ODD[:33] = False


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for each text; all are 0 for a text without words."""
    n = len(offsets) - 1
    starts, ends, doc = words(raw, offsets)
    count = np.bincount(doc, minlength=n).astype(float)
    hashes = word_hashes(raw, starts, ends)

    def per_word(chosen: np.ndarray) -> np.ndarray:
        return np.bincount(doc[chosen], minlength=n) / np.maximum(count, 1)

    def per_byte(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    def different(values: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of different values of each text, and how often its most frequent one occurs."""
        keys, times = np.unique((of.astype(np.uint64) << np.uint64(40)) | (values >> np.uint64(24)), return_counts=True)
        owner, most = (keys >> np.uint64(40)).astype(np.int64), np.zeros(n)
        np.maximum.at(most, owner, times)
        return np.bincount(owner, minlength=n).astype(float), most

    size, first, last = ends - starts, raw[starts], raw[ends - 1]
    same = np.zeros(len(doc), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    kinds, most = different(hashes, doc)
    breaks = np.flatnonzero(raw == 10)
    line = np.searchsorted(breaks, starts)  # the line of each word, over the whole batch
    heads = np.flatnonzero((np.diff(line, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    place = np.arange(len(doc)) - np.repeat(heads, np.diff(heads, append=len(doc)))
    lines = np.add.reduceat(hashes * (2 * place + 1).astype(np.uint64), heads) if len(heads) else hashes
    line_kinds, _ = different(lines, doc[heads])
    line_count = np.bincount(doc[heads], minlength=n)
    letters, at_least = np.maximum(per_byte(LETTERS), 1), np.maximum(np.diff(offsets), 1)
    columns = [
        np.log1p(count), np.bincount(doc, size, n) / np.maximum(count, 1), per_word(same), kinds / np.maximum(count, 1),
        most / np.maximum(count, 1), per_word(size <= 3), per_word(size >= 12), per_word(UPPER[first]), per_byte(UPPER) / letters,
        per_byte(DIGIT) / at_least, per_byte(SENTENCE) / at_least, per_byte(ODD) / at_least, per_word(SENTENCE[last]),
        per_word(ODD[last] & (size > 1)), per_word(ODD[last] & (size == 1)), line_count / np.maximum(count, 1),
        line_kinds / np.maximum(line_count, 1),
    ]
    return np.column_stack(columns)


@dataclass
class Model:
    """Standardised statistics x give cos(w x + b) features; their weighted sum is calibrated by a rising function."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros(DIMENSIONS + 1))
    points: tuple[np.ndarray, np.ndarray] = ((0.0, 1.0), (0.5, 0.5))  # as long as nothing was learned
    seed: int = 20

    def fourier(self, x: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(self.seed)
        w = random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], DIMENSIONS))
        b = random.uniform(0, 2 * np.pi, DIMENSIONS)
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        return np.column_stack([np.cos(z @ w + b) * np.sqrt(2 / DIMENSIONS), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), *self.points)


def measure(documents: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<id>, x``: the statistics of each row's whole text; of a null text, as of an empty one, all 0."""
    bound_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = statistics(*utf8(batch.column(1)))
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["id", "x"])

    columns = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = columns.schema["id"].dataType.simpleString()
    return columns.mapInArrow(run, f"id {kind}, x array<double>").withColumnRenamed("id", id)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)) if len(column) else np.zeros((0, len(FEATURES)))


def _summed(rows: DataFrame, part) -> np.ndarray | None:
    """Sum of ``part(x, y)`` over all rows: in each task, then of ``SUMMED`` tasks at a time. None without rows."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((part(_matrix(b.column(0)), b.column(1).to_numpy()) for b in batches if b.num_rows), start=np.zeros(()))
        if total.ndim:
            yield pa.RecordBatch.from_arrays([pa.array([total])], ["v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((np.stack(b.column(0).to_numpy(zero_copy_only=False)).sum(axis=0) for b in batches if b.num_rows), start=np.zeros(()))
        if total.ndim:
            yield pa.RecordBatch.from_arrays([pa.array([total])], ["v"])

    sums, tasks = rows.select("x", "y").mapInArrow(each, "v array<double>"), rows.rdd.getNumPartitions()
    while tasks > 1:
        tasks = -(-tasks // SUMMED)
        sums = sums.repartition(tasks).mapInArrow(add, "v array<double>")
    found = sums.first()
    return None if found is None else np.array(found.v)


def rising(x: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of points in order of x: pools neighbours that fall. Returns blocks' mean x and value."""
    blocks: list[list[float]] = []
    for at, value, w in zip(x, mean, weight):
        blocks.append([value * w, w, at * w])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    values = np.array(blocks)
    return values[:, 2] / values[:, 1], values[:, 0] / values[:, 1]


def train(measured: DataFrame, labels: DataFrame, *, id: str = "doc_id", label: str = "quality", ridge: float = 1e-4) -> Model:
    """Fit on all rows of ``measured`` that have a label of 0 or 1; a row with several labels counts with each.

    Small rows of statistics meet the labels, never texts. Means, normal equations and
    the calibration's ``BINS`` counts per unit of raw score are sums of partitions' sums;
    only such sums, whose size is fixed, come to the driver. Null ids and labels teach nothing;
    without any labelled row every score is 0.5.
    """
    own = labels.filter(F.col(label).isin(0, 1)).select(F.col(id).alias("labelled"), F.col(label).cast("double").alias("y"))
    rows = measured.join(own.hint("merge"), F.col(id) == F.col("labelled")).select("x", "y")
    rows = stage(rows, "labelled-statistics")
    n = len(FEATURES)
    sums = _summed(rows, lambda x, y: np.concatenate([x.sum(axis=0), (x**2).sum(axis=0), [len(x)]]))
    if sums is None:
        return Model(np.zeros(n), np.ones(n))
    mean = sums[:n] / sums[-1]
    deviation = np.sqrt(np.maximum(sums[n : 2 * n] / sums[-1] - mean**2, 0))
    model = Model(mean, np.where(deviation > 1e-9, deviation, 1.0))

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.fourier(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    size = DIMENSIONS + 1
    sums = _summed(rows, normal)
    square = sums[: size * size].reshape(size, size)
    penalty = ridge * np.diag([square[-1, -1]] * DIMENSIONS + [0.0])  # the constant's square counts the rows
    model.weights = np.linalg.solve(square + penalty + 1e-9 * np.eye(size), sums[size * size :])

    def bins(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(np.round((model.raw(x) + 1) * BINS), 0, 3 * BINS).astype(int)
        return np.concatenate([np.bincount(at, minlength=3 * BINS + 1), np.bincount(at, y, 3 * BINS + 1)])

    times, ones = _summed(rows, bins).reshape(2, -1)
    at = np.flatnonzero(times)
    model.points = rising(at / BINS - 1, ones[at] / times[at], times[at])
    return model


def score(measured: DataFrame, model: Model, *, id: str = "doc_id") -> DataFrame:
    """``<id>, score`` from 0 to 1 for each row of :func:`measure`; higher means label 1 is likelier. No shuffle."""
    key, source = uuid.uuid4().hex, measured.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = built(key, source, lambda value: value)
            values = own.score(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["id", "score"])

    columns = measured.select(F.col(id).alias("id"), "x")
    kind = columns.schema["id"].dataType.simpleString()
    return columns.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id)
