"""Quality rules: counts with fixed limits, and divergence from what texts of a language look like.

A language's reference holds two histograms, of character classes and of its common words. A
document is far from it if the Jensen-Shannon distance of one of its own histograms is.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from sparkprep.llm.batches import SPACE, mix, slices, utf8, word_ids, words
from sparkprep.llm.cache import built
from sparkprep.llm.session import bound_batches
from sparkprep.plans.staging import stage, unstage

PARTS = 16  # by the first hexadecimal digit of a text's MD5
COMMON = 64
LEAST_SHARE = 0.0005
LEAST_REFERENCE = 2_000
LANGUAGES = 4_096
HELD = 100_000
WORD_BYTES = 48
# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

CLASSES = 13


def _classes() -> np.ndarray:
    """The class of a character by its first byte; ``CLASSES`` for the bytes that follow."""
    table = np.full(256, 6, np.int64)
    table[:32], table[127] = 8, 8
    table[[*range(9, 14)]], table[32] = 4, 3
    table[97:123], table[65:91], table[48:58] = 0, 1, 2
    table[[ord(c) for c in ".,;:!?'\""]] = 5
    table[[ord(c) for c in SYMBOLS]] = 7
    table[0x80:0xC0] = CLASSES
    table[0xC0:0xCB], table[0xCB:0xE0], table[0xE0:0xF0], table[0xF0:] = 9, 10, 11, 12
    return table


CLASS = _classes()
SYMBOL = CLASS == 7
VISIBLE = ~SPACE & (CLASS < CLASSES)
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class Texts:
    """Words, lines and character classes of the texts of a batch."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets, self.rows = raw, offsets, len(offsets) - 1
        starts, ends, self.doc = words(raw, offsets)
        self.starts = starts
        self.ids, self.different = word_ids(raw, starts, ends)
        self.n_words = np.bincount(self.doc, minlength=self.rows)

    def per_byte(self, table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[self.raw], dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def classes(self) -> np.ndarray:
        """How many characters of each class each text has."""
        owner = np.repeat(np.arange(self.rows), np.diff(self.offsets))
        found = np.bincount(owner * (CLASSES + 1) + CLASS[self.raw], minlength=self.rows * (CLASSES + 1))
        return found.reshape(self.rows, CLASSES + 1)[:, :CLASSES]

    def plain(self) -> pa.Array:
        """Each different word in lower case without marks at its ends; null if it is not made of letters alone, or long."""
        short = pc.less_equal(pc.binary_length(self.different), WORD_BYTES)
        text = pc.utf8_lower(pc.utf8_trim(self.different.cast(pa.large_string()), characters=EDGES))
        return pc.if_else(pc.and_(short, pc.utf8_is_alpha(text)), text, None)

    def repeated_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of their text."""
        breaks = self.raw == 10
        heads = np.unique(np.concatenate([self.offsets[:-1], np.flatnonzero(breaks) + 1]))
        heads = heads[heads < len(self.raw)]
        kept = np.concatenate([[0], np.cumsum(~breaks)])[np.append(heads, len(self.raw))]
        data = np.ascontiguousarray(self.raw[~breaks])
        lines = pa.Array.from_buffers(pa.large_binary(), len(heads), [None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(data)])
        number = lines.dictionary_encode().indices.to_numpy()
        full = np.unique(np.searchsorted(heads, self.starts, "right") - 1)  # the lines with a word
        owner = np.searchsorted(self.offsets, heads[full], "right") - 1
        different = np.unique(owner.astype(np.int64) * (len(heads) + 1) + number[full]) // (len(heads) + 1)
        return np.bincount(owner, minlength=self.rows) - np.bincount(different, minlength=self.rows)

    def repeated_words(self, size: int = 3) -> np.ndarray:
        """Words in windows of ``size`` words that occur again in their text."""
        n = len(self.ids) - size + 1
        if n <= 0:
            return np.zeros(self.rows, np.int64)
        code = self.doc[:n].astype(np.uint64)
        for k in range(size):
            code = mix(code * np.uint64(3) + self.ids[k : k + n].astype(np.uint64))
        inside = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        code = code[inside]
        ordered = np.sort(code)
        again = inside[np.isin(code, ordered[1:][ordered[1:] == ordered[:-1]])]
        name = self.doc[again].astype(np.int64)
        for k in range(size):  # equal hashes suggest, equal words decide
            name = np.unique(name * len(self.different) + self.ids[again + k], return_inverse=True)[1]
        again = again[np.bincount(name, minlength=1)[name] > 1]
        change = np.zeros(len(self.ids) + 1, np.int64)
        np.add.at(change, again, 1)
        np.add.at(change, again + size, -1)
        return np.bincount(self.doc[np.cumsum(change)[:-1] > 0], minlength=self.rows)


@dataclass
class Reference:
    """Shares of a language's character classes, and of its common words followed by that of all other words."""

    classes: np.ndarray
    words: list[str]
    shares: np.ndarray


def divergence(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """The Jensen-Shannon distance, from 0 to 1, of each row of counts from a distribution.

    What a sample of the row's size would differ by on average is taken off first.
    """
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    p = counts / total
    middle = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)
        right = np.where(reference > 0, reference * np.log2(reference / middle), 0).sum(axis=1)
    chance = (np.count_nonzero(reference) - 1) / (8 * np.log(2) * total[:, 0])
    return np.sqrt(np.maximum((left + right) / 2 - chance, 0))


def _count_parts(documents: DataFrame) -> DataFrame:
    """``lang, kind, name`` with the counts of each part: of plain words, of all words, and of character classes.

    A task adds up until it holds ``HELD`` different words. Texts are dealt to parts by a hash, so copies of a text are in one.
    """
    sums = [f"n{i}" for i in range(PARTS)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[str, dict[str, int]] = {}  # by language, the row of each word in ``held``; marks begin the names of other counts
        held, used = np.zeros((HELD * 2, PARTS), np.int64), 0

        def row(own: dict[str, int], name: str) -> int:
            nonlocal used
            found = own.get(name)
            if found is None:
                found = own[name] = used
                used += 1
            return found

        def flush() -> pa.RecordBatch:
            rows = [(number, lang, name) for lang, own in places.items() for name, number in own.items()]
            order = np.array([r[0] for r in rows])
            kinds = [{"#": "words", "$": "class"}.get(r[2][0], "word") for r in rows]
            columns = [pa.array([r[1] for r in rows]), pa.array(kinds), pa.array([r[2].strip("#$") for r in rows])]
            columns += [pa.array(held[order, i]) for i in range(PARTS)]
            return pa.RecordBatch.from_arrays(columns, ["lang", "kind", "name", *sums])

        for batch in slices(batches):
            texts = Texts(*utf8(batch.column("text")))
            langs, part = np.array(batch.column("lang").to_pylist(), object), batch.column("part").to_numpy()
            plain, classes = texts.plain().to_numpy(zero_copy_only=False), texts.classes()
            names = sorted(set(langs.tolist()))
            most = len(names) * (len(plain) + CLASSES + 1)
            if used + most > len(held):
                if used:
                    yield flush()
                places.clear()
                held, used = np.zeros((max(HELD * 2, most), PARTS), np.int64), 0
            usable = np.array([x is not None for x in plain], bool)[texts.ids]
            for name in names:
                own, mine = places.setdefault(name, {}), langs == name
                chosen = usable & mine[texts.doc]
                different, inverse = np.unique(texts.ids[chosen], return_inverse=True)
                rows = np.array([row(own, word) for word in plain[different].tolist()], np.int64)
                np.add.at(held, (rows[inverse], part[texts.doc[chosen]]), 1)
                np.add.at(held[row(own, "#")], part[mine], texts.n_words[mine])
                for c in range(CLASSES):
                    np.add.at(held[row(own, f"${c}")], part[mine], classes[mine, c])
        if used:
            yield flush()

    part = F.conv(F.substring(F.md5("text"), 1, 1), 16, 10).cast("int").alias("part")
    rows = documents.filter("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text", part)
    counted = rows.mapInArrow(count, "lang string, kind string, name string, " + ", ".join(f"{c} long" for c in sums))
    return counted.groupBy("lang", "kind", "name").agg(*(F.sum(c).alias(c) for c in sums))


def learn_references(documents: DataFrame, *, text: str = "text", lang: str = "lang") -> dict[str, Reference]:
    """The references of the languages that ``lang`` names, from all rows in which neither it nor the text is null.

    Texts are dealt to ``PARTS`` parts by their content. A share is the median of the parts' shares, so a
    text with very many copies, which all lie in one part, moves no share. A language gets a reference
    if it has ``LEAST_REFERENCE`` words and one in ``LANGUAGES`` of all words; so there are at most ``LANGUAGES``.
    Its common words are the ``COMMON`` most frequent of those with a share of ``LEAST_SHARE``; they
    consist of letters, in lower case, without marks at their ends. An empty table gives no reference.
    Counts add up in the tasks before they are shuffled; only references come to the driver.
    """
    bound_batches(documents.sparkSession)
    counts = stage(_count_parts(documents.select(F.col(lang).alias("lang"), F.col(text).alias("text"))), "word-parts")
    sums = [F.col(f"n{i}") for i in range(PARTS)]
    totals = counts.filter("kind = 'words'").withColumn("n", sum(sums, F.lit(0)))
    everything = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    large = totals.filter((F.col("n") >= LEAST_REFERENCE) & (F.col("n") * LANGUAGES >= everything))
    large = large.select("lang", F.array(*sums).alias("words"))
    characters = counts.filter("kind = 'class'").groupBy("lang").agg(*(F.sum(c).alias(f"n{i}") for i, c in enumerate(sums)))
    large = large.join(characters.select("lang", F.array(*sums).alias("characters")), "lang")
    whole = F.when(F.col("kind") == "word", F.col("words")).otherwise(F.col("characters"))
    shares = F.filter(F.zip_with(F.array(*sums), whole, lambda a, b: F.when(b > 0, a / b)), lambda x: x.isNotNull())
    rows = counts.filter("kind != 'words'").join(F.broadcast(large), "lang").select("lang", "kind", "name", F.sort_array(shares).alias("shares"))
    half = F.floor((F.size("shares") - 1) / 2).cast("int")
    middle = (F.col("shares")[half] + F.col("shares")[F.size("shares") - 1 - half]) / 2
    rows = rows.select("lang", "kind", "name", middle.alias("share"))
    frequent = rows.filter((F.col("kind") == "word") & (F.col("share") >= LEAST_SHARE))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("share"), "name"))
    frequent = frequent.withColumn("rank", rank).filter(F.col("rank") <= COMMON).drop("rank")
    found: dict[str, dict[str, list]] = {}
    for name, kind, value, share in frequent.unionByName(rows.filter("kind = 'class'")).collect():
        found.setdefault(name, {"word": [], "class": []})[kind].append((value, share))
    unstage(counts)
    return {name: _reference(kinds["word"], kinds["class"]) for name, kinds in sorted(found.items())}


def _reference(frequent: list[tuple[str, float]], classes: list[tuple[str, float]]) -> Reference:
    frequent = sorted(frequent, key=lambda x: (-x[1], x[0]))
    own = np.zeros(CLASSES)
    for c, share in classes:
        own[int(c)] = share
    shares = np.array([share for _, share in frequent] + [0.0])
    shares[-1] = max(0.0, 1 - shares.sum())
    return Reference(own / max(own.sum(), 1e-300), [word for word, _ in frequent], shares / max(shares.sum(), 1e-300))


def distances(texts: Texts, reference: Reference, rows: np.ndarray, plain: pa.Array, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances of the ``rows`` of a batch from a reference, by character classes and by common words."""
    size = len(reference.shares)
    number = pc.index_in(plain, value_set=pa.array(reference.words, plain.type), skip_nulls=True)
    kind = number.fill_null(size - 1).to_numpy().astype(np.int64)
    place = np.full(texts.rows, -1)
    place[rows] = np.arange(len(rows))
    chosen = place[texts.doc] >= 0
    counts = np.bincount(place[texts.doc[chosen]] * size + kind[texts.ids[chosen]], minlength=len(rows) * size).reshape(len(rows), size)
    return divergence(classes[rows], reference.classes), divergence(counts, reference.shares)


def judge(
    documents: DataFrame,
    references: dict[str, Reference],
    *,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    least_words: int = 50,
    repeated: float = 0.5,
    class_limit: float = 0.25,
    word_limit: float = 0.35,
    least_chars: int = 200,
) -> DataFrame:
    """``<id>, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, kept``.

    Counts are of the whole text. Words are runs of ``[^\\x20\\x09-\\x0D]``, ``word_chars`` their code points,
    ``n_symbols`` the characters of ``[#*$%&|<>]``, ``n_dup_lines`` lines with a word that equal an
    earlier line, ``n_repeat_words`` words in 3-word windows found twice or more. The base rule fails
    texts of fewer than ``least_words`` words, or of which more than the share ``repeated`` lies in repeated windows.

    A document is compared with its language's reference; with a null ``lang``, with the one that is nearest by
    common words. It is kept if the base rule holds and neither distance is above its limit. Guards: the
    class distance is null below ``least_chars`` characters, the word distance below ``least_words``
    words, and both in a language without a reference; a null distance rejects nothing.

    A null, empty or blank text has no words and fails the base rule. Rows are judged by themselves,
    repeated ones and those with a null id too, without a shuffle. The references are
    broadcast; :func:`learn_references` bounds them. An empty table gives an empty result; other columns are ignored.
    """
    bound_batches(documents.sparkSession)
    key, source = uuid.uuid4().hex, documents.sparkSession.sparkContext.broadcast(references)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = built(key, source, lambda value: value)
        for batch in slices(batches):
            texts = Texts(*utf8(batch.column("text")))
            classes, plain, again = texts.classes(), texts.plain(), texts.repeated_words()
            by_class, by_word = np.full((2, batch.num_rows), np.nan)
            langs = np.array(batch.column("lang").to_pylist(), object)
            for name in set(langs.tolist()) & set(known):
                rows = np.flatnonzero(langs == name)
                by_class[rows], by_word[rows] = distances(texts, known[name], rows, plain, classes)
            unknown = np.flatnonzero(langs == None)  # noqa: E711
            if len(unknown) and known:
                every = np.array([distances(texts, r, unknown, plain, classes) for r in known.values()])
                nearest = every[:, 1].argmin(axis=0)
                by_class[unknown], by_word[unknown] = every[nearest, :, np.arange(len(unknown))].T
            n = texts.n_words
            by_class[classes.sum(axis=1) < least_chars] = np.nan
            by_word[n < least_words] = np.nan
            failed = (n < least_words) | (again > repeated * n)
            far = (by_class > class_limit) | (by_word > word_limit)
            counts = [n, texts.per_byte(VISIBLE), texts.per_byte(SYMBOL), texts.repeated_lines(), again]
            arrays = [batch.column("id"), *map(pa.array, counts), pa.array(failed)]
            arrays += [pa.array(d, mask=np.isnan(d)) for d in (by_class, by_word)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(~failed & ~far)], ["id", *COUNTS, "base_failed", "class_distance", "word_distance", "kept"])

    columns = documents.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    kind = columns.schema["id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    found = columns.mapInArrow(run, f"id {kind}, {counts}, base_failed boolean, class_distance double, word_distance double, kept boolean")
    return found.withColumnRenamed("id", id)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
