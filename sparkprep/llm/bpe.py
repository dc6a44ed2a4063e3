"""Byte-level BPE by dynamic programming over prefixes.

For each prefix of a piece of text there is exactly one token with which the prefix's
encoding ends. It is the only token that ends there and may follow the last token of the
prefix before it. So the table of last tokens grows by appending, without looking back
further than the longest token, and an edit changes it only near by.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from sparkprep.llm.batches import slices
from sparkprep.llm.cache import Memo, built
from sparkprep.llm.session import bound_batches

DECODED_AT_ONCE = 1 << 20
END = -1
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, with the token in base 64 and its rank."""
    lines = map(bytes.split, Path(path).read_bytes().splitlines())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


class Encoder:
    """The encoding that merging the adjacent pair of lowest rank, again and again, ends with."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.split = regex.compile(pattern).findall
        self.space = regex.compile(r"^\s|\s$|^$").search
        self.growth = Memo(self._growth, len(ranks))
        self.follows = Memo(self._follows, 250_000)
        self.pieces = Memo(self._piece, 30_000)
        self.letters = Memo(lambda word: self._piece(" " + word), 180_000)
        self.spaced = Memo(self._spaced, 150_000)

    @cached_property
    def trie(self) -> dict:
        """The tokens by their bytes; a node's ``END`` is the rank of the token that ends there."""
        root: dict = {}
        for token, rank in self.ranks.items():
            node = root
            for byte in token:
                node = node.setdefault(byte, {})
            node[END] = rank
        return root

    def merges(self, data: bytes) -> tuple[list[bytes], list[list[bytes]]]:
        """The definition, for single tokens: the encoding, and the parts after each merge."""
        parts, steps = [data[i : i + 1] for i in range(len(data))], []
        while True:
            steps.append(list(parts))
            pairs = [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
            if not pairs:
                return parts, steps
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _growth(self, token: int) -> tuple[list[bytes], list[bytes]] | None:
        """How a token's last and first part grow while it is merged; None if merging never makes it."""
        parts, steps = self.merges(self.tokens[token])
        if len(parts) > 1:
            return None
        return list(dict.fromkeys(s[-1] for s in steps)), list(dict.fromkeys(s[0] for s in steps))

    def _follows(self, pair: int) -> bool:
        """Whether the second token stays behind the first (-1: the start) when both are encoded as one.

        A pair is one number, ``(first + 1 << 24) | second``, which takes little room in the table.

        The parts at the border grow in the order of their ranks. The tokens stay apart unless
        at some moment the pair across the border is a token that comes before the next growth
        on either side; of equal ranks the left one is merged first.
        """
        before, second = (pair >> 24) - 1, self.growth[pair & 0xFFFFFF]
        if before < 0 or second is None:
            return second is not None
        left, right, ranks, never = self.growth[before][0], second[1], self.ranks, 1 << 60
        i = j = 0
        while True:
            left_next = ranks[left[i + 1]] if i + 1 < len(left) else never
            right_next = ranks[right[j + 1]] if j + 1 < len(right) else never
            across = ranks.get(left[i] + right[j], never)
            if across < left_next and across <= right_next and across < never:
                return False
            if left_next == right_next == never:
                return True
            if left_next <= right_next:
                i += 1
            else:
                j += 1

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        if data in self.ranks:
            return self.ranks[data].to_bytes(4, "little")
        return np.array(PrefixTable(self, data).tokens(), "<u4").tobytes()

    def _spaced(self, word: str) -> bytes | None:
        """The ids of a word after a space or, if it begins so, after a line end; None for other white space."""
        core = word.rstrip(MARKS)
        if core.isalpha():  # letters, then perhaps marks: a match each
            return self.letters[core] + self.pieces[word[len(core) :]] if core != word else self.letters[core]
        lead, word = ("", word[1:]) if word[:1] == "\n" else (" ", word)
        if self.space(word):
            return None
        found = [self.pieces[p] for p in self.split(lead + word)]
        return b"".join(found if lead else [self.pieces["\n"], *found])

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers.

        A space or a line end between two other characters always begins a new match of the
        pattern, so what lies between two of them is encoded by itself, and frequent words
        come from a table. A text with other white space next to them is split as a whole.
        """
        first, *rest = text.replace("\n", " \n").split(" ")
        if not self.space(first):
            found = [*map(self.spaced.__getitem__, rest)]
            if None not in found:
                return b"".join([*map(self.pieces.__getitem__, self.split(first)), *found])
        return b"".join([self.pieces[p] for p in self.split(text)])

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4")
        blocks = (numbers[i : i + DECODED_AT_ONCE].tolist() for i in range(0, len(numbers), DECODED_AT_ONCE))
        return b"".join([b"".join([*map(self.tokens.__getitem__, block)]) for block in blocks])


class PrefixTable:
    """The last token of each prefix of a piece, for appending and editing.

    ``last[i]`` is the last token of the encoding of ``data[:i]``.
    """

    def __init__(self, encoder: Encoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Encode on; nothing before the new bytes changes."""
        begin = len(self.data)
        self.data += more
        self.last += [-1] * len(more)
        self._fill(max(0, begin - self.encoder.longest + 1), len(self.data))

    def _fill(self, begin: int, end: int) -> None:
        """Enter the tokens that begin at ``begin`` up to ``end`` where a prefix has no last token yet."""
        data, last, follows, trie, size = self.data, self.last, self.encoder.follows, self.encoder.trie, len(self.data)
        for start in range(begin, end):
            node, before = trie, last[start] + 1 << 24
            for at in range(start, size):
                node = node.get(data[at])
                if node is None:
                    break
                if last[at + 1] < 0 and END in node and follows[before | node[END]]:
                    last[at + 1] = node[END]

    def replace(self, begin: int, end: int, new: bytes) -> int:
        """Replace ``data[begin:end]``; returns how many prefixes were encoded anew.

        Behind the edit, work ends as soon as as many last tokens as the longest token has
        bytes are the old ones: from there on all are.
        """
        old, moved, longest = self.last, len(new) - (end - begin), self.encoder.longest
        self.data = self.data[:begin] + new + self.data[end:]
        self.last = old[: begin + 1] + [-1] * (len(self.data) - begin)
        same = 0
        for at in range(max(0, begin - longest + 1), len(self.data)):
            self._fill(at, at + 1)
            done = at + 1
            if done > begin + len(new):
                same = same + 1 if self.last[done] == old[done - moved] else 0
                if same > longest and done < len(self.data):
                    self.last[done + 1 :] = old[done - moved + 1 :]
                    return done - begin
        return len(self.data) - begin

    def tokens(self) -> list[int]:
        """The encoding, read off from its end."""
        found, at = [], len(self.data)
        while at:
            found.append(self.last[at])
            at -= len(self.encoder.tokens[found[-1]])
        return found[::-1]


def _shared(documents: DataFrame, ranks_path: str, pattern: str):
    ranks = read_ranks(ranks_path)
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    source = documents.sparkSession.sparkContext.broadcast(ranks)
    return lambda: built(key, source, lambda value: Encoder(value, pattern))


def encode_documents(documents: DataFrame, ranks_path: str, pattern: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<id>, ids``: each whole text's token ids as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded separately, without special tokens. A null text
    counts as empty and has no ids. Every row is encoded by itself, repeated ones too; there
    is no shuffle. The vocabulary is broadcast; its size is that of its file. An empty table
    gives an empty result; other columns are ignored.
    """
    bound_batches(documents.sparkSession)
    encoder = _shared(documents, ranks_path, pattern)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = encoder().encode
        for batch in slices(batches):
            ids = [run(x or "") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    columns = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = columns.schema["id"].dataType.simpleString()
    return columns.mapInArrow(encode, f"id {kind}, ids binary").withColumnRenamed("id", id)


def decode_ids(encoded: DataFrame, ranks_path: str, *, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``<id>, ids, text``: the bytes for which the ids of :func:`encode_documents` stand.

    ``text`` is binary, as any ids may be decoded, also such that are not UTF-8. Null ids
    give null bytes; an id outside the vocabulary is an error. No shuffle.
    """
    bound_batches(encoded.sparkSession)
    encoder = _shared(encoded, ranks_path, "")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = encoder().decode
        for batch in slices(batches, "ids"):
            texts = [None if x is None else run(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], ["id", "ids", "text"])

    columns = encoded.select(F.col(id).alias("id"), F.col(ids).alias("ids"))
    kind = columns.schema["id"].dataType.simpleString()
    return columns.mapInArrow(decode, f"id {kind}, ids binary, text binary").withColumnRenamed("id", id)
