"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from sparkprep.llm.batches import slices, utf8
from sparkprep.llm.cache import built
from sparkprep.llm.session import bound_batches
from sparkprep.plans.staging import stage, unstage

ORDER = 3
TRAIN_BYTES = 4_000_000
LEAST_COUNT = 8
MAX_LANGUAGES = 256
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass
class Contexts:
    """Frozen statistics of all languages, as tables that numpy looks up.

    ``symbols`` numbers the bytes; 0 is for the start of a text, the last for bytes not seen. ``state``
    leads from the last ``ORDER`` symbols to the longest context kept, and ``bits[state, symbol]``
    holds the exact code length of the next symbol in each language.
    """

    languages: list[str]
    symbols: np.ndarray
    state: np.ndarray
    bits: np.ndarray

    def lengths(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of each text in each language."""
        total = np.zeros((len(offsets) - 1, len(self.languages)))
        filled = np.flatnonzero(np.diff(offsets))
        if len(filled):
            size = self.bits.shape[1]
            last = context_symbols(self.symbols[raw], offsets)
            code = (last[0] * size + last[1]) * size + last[2]
            total[filled] = np.add.reduceat(self.bits[self.state[code], last[3]], offsets[filled], axis=0, dtype=np.float64)
        return total


NOTHING = Contexts([], np.zeros(256, np.int32), np.zeros(1, np.int32), np.zeros((1, 1, 0), np.float32))


def context_symbols(symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row ``ORDER``: each text's symbols; the rows before: the symbols 3, 2 and 1 before, 0 before the start."""
    rows = np.zeros((ORDER + 1, len(symbols)), np.int32)
    rows[ORDER] = symbols
    for back in range(1, ORDER + 1):
        rows[ORDER - back, back:] = symbols[:-back]
    for back in range(1, ORDER + 1):
        for shift in range(back):
            at = offsets[:-1] + shift
            rows[ORDER - back, at[at < offsets[1:]]] = 0
    return rows


def build(counts: list[tuple[str, int, int]]) -> Contexts:
    """The tables from ``language, gram, count``; a gram is four bytes plus one each, 0 before a text's start.

    Escape method C: in a context seen n times with q different next bytes, a byte seen c times
    has probability c / (n + q), and q / (n + q) leads to the next shorter context; below the
    empty context all 256 bytes are equally likely. Contexts seen fewer than ``LEAST_COUNT``
    times in every language are left out.
    """
    languages = sorted({language for language, _, _ in counts})
    number = {language: i for i, language in enumerate(languages)}
    who = np.array([number[c[0]] for c in counts], np.int64)
    grams = np.array([c[1] for c in counts], np.int64)
    times = np.array([c[2] for c in counts], np.float64)
    parts = np.stack([(grams >> (9 * k)) & 511 for k in (3, 2, 1, 0)])  # oldest first
    seen = np.unique(parts[3])
    symbols = np.full(256, len(seen) + 1, np.int32)
    symbols[seen - 1] = np.arange(1, len(seen) + 1)
    size, width = len(seen) + 2, len(languages)
    lookup = np.concatenate([[0], symbols])
    parts = lookup[parts]

    def order(k: int, shorter: np.ndarray | None, context: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the contexts of ``k`` symbols that are kept, and their bits for each next symbol."""
        own = np.zeros(len(grams), np.int64)
        for j in range(ORDER - k, ORDER):
            own = own * size + parts[j]
        codes, row = np.unique(own, return_inverse=True)
        total = np.zeros((len(codes), width), np.float32)
        np.add.at(total, (row, who), times)
        keep = total.max(axis=1) >= (LEAST_COUNT if k else 0)
        used, place = keep[row], np.cumsum(keep) - 1
        codes, total = codes[keep], total[keep][:, None]
        table = np.zeros((len(codes), size, width), np.float32)
        np.add.at(table, (place[row[used]], parts[ORDER][used], who[used]), times[used])
        different = (table > 0).sum(axis=1, keepdims=True)
        below = np.full((1, size, width), 8.0, np.float32) if shorter is None else shorter[context[codes % size ** max(k - 1, 0)]]
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(different / (total + different)), 0)
            bits = np.where(table > 0, -np.log2(table / (total + different)), escape + below)
        return codes, bits.astype(np.float32)

    _, bits = order(0, None, None)
    tables, state = [bits], np.zeros(1, np.int32)
    for k in range(1, ORDER + 1):
        codes, own = order(k, np.concatenate(tables), state)
        state = np.tile(state, size)  # without a context of its own, the shorter one's
        state[codes] = sum(map(len, tables)) + np.arange(len(codes))
        tables.append(own)
    return Contexts(languages, symbols, state, np.concatenate(tables))


def _lower(column: pa.Array) -> pa.Array:
    return pa.array([(x or "").lower() for x in column.to_pylist()], pa.string())


def train(documents: DataFrame, *, text: str = "text", lang: str = "lang", train_bytes: int = TRAIN_BYTES) -> Contexts:
    """Count contexts per language over the whole texts of a sample, in the tasks and then over all of them.

    Equal texts of a language teach once. A language of up to ``train_bytes`` bytes of different
    texts is used whole; of a larger one, texts are taken in the order of a hash until they
    have this many, the first in any case. Rows with a null text or language teach nothing; without any
    other, no language is learned. At most ``MAX_LANGUAGES`` languages are allowed. Only the counts of
    the bounded sample come to the driver.
    """
    rows = documents.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    rows = rows.withColumn("place", F.xxhash64(F.lit("train"), "text"))
    texts = rows.groupBy("lang", "place").agg(F.max(F.octet_length("text")).cast("long").alias("size"))
    texts = stage(texts.withColumn("bucket", F.shiftright("place", 52)), "training-texts")
    names = [name for (name,) in texts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if texts.filter("size > 0").isEmpty():
        return NOTHING
    sums = texts.groupBy("lang", "bucket").agg(F.sum("size").alias("size")).toPandas().sort_values(["lang", "bucket"])
    sums["before"] = sums.groupby("lang")["size"].cumsum() - sums["size"]
    last = sums[sums["before"] < train_bytes].groupby("lang").last()  # where each language gets full, or its end
    edge, before = (F.create_map(*(F.lit(v) for name, value in last[c].items() for v in (name, int(value)))) for c in ("bucket", "before"))
    taken = F.sum("size").over(Window.partitionBy("lang").orderBy("place")) - F.col("size") + before[F.col("lang")]
    full = texts.filter(F.col("bucket") == edge[F.col("lang")]).withColumn("taken", taken).filter(F.col("taken") < train_bytes)
    limits = full.groupBy("lang").agg(F.max("place")).collect()
    limit = F.create_map(*(F.lit(v) for name, value in limits for v in (name, value)))
    unstage(texts)
    sample = rows.filter(F.col("place") <= limit[F.col("lang")]).dropDuplicates(["lang", "place"]).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names = np.array(batch.column(1).to_pylist(), object)
            for name in set(names):
                chosen = batch.filter(pa.array(names == name))
                raw, at = utf8(_lower(chosen.column(0)))
                last = context_symbols(raw.astype(np.int32) + 1, at).astype(np.int64)
                grams, times = np.unique(((last[0] << 27) | (last[1] << 18) | (last[2] << 9) | last[3]), return_counts=True)
                arrays = [pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(times)]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "gram", "times"])

    grams = sample.mapInArrow(count, "lang string, gram long, times long")
    counts = grams.groupBy("lang", "gram").agg(F.sum("times").alias("times")).toPandas()
    return build(list(counts.itertuples(index=False, name=None)))


def identify(documents: DataFrame, contexts: Contexts, *, id: str = "doc_id", text: str = "text", keep: list[str] = ()) -> DataFrame:
    """``<id>, lang_pred, score`` and the columns ``keep``, for each row.

    The language is the one that codes the whole text, in lower case, in the fewest bits; of
    equals, the first by name. ``score`` is its share of the probability that all languages
    give to the text. A null text, or one without a letter, is ``und`` with score 0, and so is every
    text if no language was learned. Rows are
    judged by themselves, repeated ones too, without a shuffle; an empty table gives an empty
    result. The tables are broadcast: their size follows the training sample's bound.
    """
    bound_batches(documents.sparkSession)
    key, source = uuid.uuid4().hex, documents.sparkSession.sparkContext.broadcast(contexts)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = built(key, source, lambda value: value)
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in slices(batches):
            if not model.languages:
                arrays = [*batch.columns, pa.array([UNDETERMINED] * batch.num_rows), pa.array(np.zeros(batch.num_rows))]
                yield pa.RecordBatch.from_arrays(arrays[:1] + arrays[2:], ["id", *kept, "lang_pred", "score"])
                continue
            lowered = _lower(batch.column("text"))
            bits = model.lengths(*utf8(lowered))
            letters = np.array([LETTER.search(x) is not None for x in lowered.to_pylist()], bool)
            best = bits.argmin(axis=1)
            share = 1 / np.exp2(np.clip(bits.min(axis=1, keepdims=True) - bits, -1000, 0)).sum(axis=1)
            found = names[np.where(letters, best, len(model.languages))]
            arrays = [*batch.columns, pa.array(found, pa.string()), pa.array(np.where(letters, share, 0.0))]
            yield pa.RecordBatch.from_arrays(arrays[:1] + arrays[2:], ["id", *kept, "lang_pred", "score"])

    kept = [f"kept{i}" for i in range(len(keep))]
    columns = documents.select(F.col(id).alias("id"), F.col(text).alias("text"), *(F.col(c).alias(k) for c, k in zip(keep, kept)))
    kinds = ", ".join(f"{c} {columns.schema[c].dataType.simpleString()}" for c in ["id", *kept])
    rows = columns.mapInArrow(judge, f"{kinds}, lang_pred string, score double")
    return rows.withColumnsRenamed({"id": id, **dict(zip(kept, keep))})


def held_out(id: str = "doc_id"):
    """Whether a row is kept from training: the CRC-32 of its id as text leaves remainder 2 modulo 4. A null id is empty text."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % 4 == 2
