"""Texts of Arrow batches as byte arrays, their words, and hashes of words.

The operators that work on whole texts get them in Arrow batches. These helpers view a batch
as one array of bytes with document offsets, so that the work runs in numpy over many
documents at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``SLICE_BYTES`` of text, or one longer document."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        index = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(index)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes.astype(np.int64)) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            yield batch.slice(begin, end - begin)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, one text after the other, and the texts' offsets. Null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and document of each word; a word is a run of ``[^\\x20\\x09-\\x0D]``."""
    inside = ~SPACE[raw]
    before = np.zeros(len(raw), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(raw)]] = False
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_ids(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The number of each word among the batch's different words, and these words. Words are those of :func:`words`."""
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    data = raw[~SPACE[raw]]
    column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    encoded = column.dictionary_encode()
    return encoded.indices.to_numpy(), encoded.dictionary


LONG_WORD = 1 << 12


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every batch and task.

    The bytes are taken in eights, and each eight is mixed into what came before by products and shifts that
    no sum undoes, so words that differ in a regular way have hashes of their own, unlike with
    sums of powers modulo 2^64. Words of one length up to eight bytes never share one. Words beyond
    ``LONG_WORD`` bytes are hashed by BLAKE2.
    """
    size = ends - starts
    found = mix(size.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    eights = np.ndarray((len(raw) + 1,), "<u8", np.concatenate([raw, np.zeros(8, np.uint8)]), strides=(1,))  # the eight bytes from each place on
    live = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    at, left = starts[live], size[live]
    while len(live):
        bits = np.uint64(8) * np.minimum(left, 8).astype(np.uint64)
        chunk = eights[at] & (np.uint64(2**64 - 1) >> (np.uint64(64) - bits))
        found[live] = mix(found[live] * np.uint64(0xD6E8FEB86659FD93) ^ mix(chunk + np.uint64(0xA0761D6478BD642F)))
        on = left > 8
        live, at, left = live[on], at[on] + 8, left[on] - 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        digest = blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        found[i] = int.from_bytes(digest, "little")
    return found


def window_hashes(hashes: np.ndarray, size: int, seed: int = 7) -> np.ndarray:
    """A hash of each run of ``size`` consecutive values; entry i is for the run that starts at i."""
    factor = np.uint64(int(np.random.default_rng(seed).integers(0, 2**61)) * 8 + 5)
    n = len(hashes) - size + 1
    total = np.zeros(max(n, 0), np.uint64)
    for j in range(size if n > 0 else 0):
        total = total * factor + hashes[j : j + n]
    return mix(total)


PRIME = np.uint64(2**61 - 1)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime 2^61-1 of values below it, from halves of 30 and 31 bits."""
    half, rest = np.uint64(31), np.uint64(2**31 - 1)
    a1, a0, b1, b0 = a >> half, a & rest, b >> half, b & rest
    middle = a1 * b0 + a0 * b1
    total = (a1 * b1 << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & np.uint64(2**30 - 1)) << half) + a0 * b0
    return residue(total)


def residue(x: np.ndarray) -> np.ndarray:
    """64-bit values modulo 2^61-1."""
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """The first powers of a base modulo 2^61-1; a worker keeps the longest table of each base."""
    table = _POWERS.get(base, np.ones(1, np.uint64))
    while len(table) < count:
        table = np.concatenate([table, times(table, np.uint64(pow(base, len(table), int(PRIME))))])
    _POWERS[base] = table
    return table[:count]


class Spans:
    """Hashes of any spans of a sequence of 64-bit values: polynomials modulo the prime 2^61-1, from sums over prefixes.

    Different spans of n values have one hash with a probability of n / 2^61 at most, whatever the values are,
    as the base is drawn at random. ``which`` chooses one of several independent bases.
    """

    def __init__(self, values: np.ndarray, which: int = 0):
        base = int(np.random.default_rng(41 + which).integers(2**32, int(PRIME)))
        values = residue(mix(values + np.uint64(which * 0x5851F42D4C957F2D)))
        self.inverse = powers(pow(base, -1, int(PRIME)), len(values) + 1)
        terms = times(values, powers(base, len(values) + 1)[:-1])
        high, low = np.cumsum(terms >> np.uint64(31)), np.cumsum(terms & np.uint64(2**31 - 1))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        self.sums[1:] = residue((high >> np.uint64(30)) + ((high & np.uint64(2**30 - 1)) << np.uint64(31)) + low)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = times(residue(self.sums[end] + PRIME - self.sums[begin]), self.inverse[begin])
        return mix(found + (end - begin).astype(np.uint64))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the longs that Spark stores."""
    return x.view(np.int64)
