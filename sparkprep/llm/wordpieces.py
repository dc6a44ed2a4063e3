"""Token counts by greedy longest match, in time linear in the text and without building pieces."""

from __future__ import annotations

import hashlib
import json
from collections import deque
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkprep.llm.batches import slices
from sparkprep.llm.cache import Memo, built
from sparkprep.llm.session import bound_batches
from sparkprep.llm.wordtokens import Letters


class LongestMatch:
    """A trie of the vocabulary with failure links and the number of pieces that each link pops.

    Where a match cannot go on, the link of its node leads to what is left after the pieces
    that greedy matching takes off its front, and tells how many these are. No character is
    read twice.
    """

    def __init__(self, vocabulary: list[str]):
        self.children: list[dict[str, int]] = [{}]
        token, parent = [False], [0]
        for piece in vocabulary:
            node = 0
            for char in piece:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    token.append(False)
                    parent.append(node)
                node = self.children[node][char]
            token[node] = node > 0
        self.link: list[int] = [-1] * len(token)  # -1: no way on
        self.popped = [0] * len(token)
        queue = deque((char, child) for char, child in self.children[0].items())
        while queue:
            char, node = queue.popleft()
            if token[node]:
                self.link[node], self.popped[node] = 0, 1
            else:
                at, count = self.link[parent[node]], self.popped[parent[node]]
                while at >= 0 and char not in self.children[at]:
                    count += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[node], self.popped[node] = self.children[at][char], count
            queue.extend(self.children[node].items())

    def count(self, word: str) -> int:
        """The number of pieces of a word; 1, for an unknown word, if pieces cannot make it up."""
        node, pieces = 0, 0
        for char in word:
            while char not in self.children[node]:
                if self.link[node] < 0:
                    return 1
                pieces += self.popped[node]
                node = self.link[node]
            node = self.children[node][char]
        while node:
            if self.link[node] < 0:
                return 1
            pieces += self.popped[node]
            node = self.link[node]
        return pieces


class Counter:
    """Words and pieces of texts by a tokenizer file: its rules make the words, its vocabulary the pieces.

    A word ends with the file's mark for that, so pieces inside and at the end of words differ.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        model = json.loads(definition)["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.match = LongestMatch(list(model["vocab"]))
        self.tokenizer = Tokenizer.from_str(definition)
        self.letters = Letters(self.tokenizer)
        self.pieces = Memo(lambda word: self.match.count(word + self.end))
        self.words = Memo(self._word, 250_000)

    def split(self, text: str) -> list[str]:
        normal = self.tokenizer.normalizer.normalize_str(text)
        return [word for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def _word(self, text: str) -> complex:
        """Both counts in one number that adds up as they do."""
        symbols = self.letters.symbols(text)
        found = [symbols] if symbols else self.split(text) if text else []
        return complex(len(found), sum(map(self.pieces.__getitem__, found)))

    def count(self, text: str) -> tuple[int, int]:
        total = sum(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))
        return int(total.real), int(total.imag)


def count_tokens(documents: DataFrame, tokenizer_path: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<id>, n_words, n_tokens`` for each row: words, and pieces by greedy longest match, of the whole text.

    A word that the vocabulary cannot make up counts as one token. A null or empty text has
    none of either. Rows are counted by themselves, repeated ones too, without a shuffle; the
    file is broadcast. An empty table gives an empty result; other columns are ignored.
    """
    bound_batches(documents.sparkSession)
    definition = Path(tokenizer_path).read_text()
    key = "pieces" + hashlib.sha256(definition.encode()).hexdigest()
    source = documents.sparkSession.sparkContext.broadcast(definition)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = built(key, source, Counter).count
        for batch in slices(batches):
            found = np.array([run(x or "") for x in batch.column(1).to_pylist()], np.int64).reshape(-1, 2)
            arrays = [batch.column(0), pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "n_tokens"])

    columns = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = columns.schema["id"].dataType.simpleString()
    return columns.mapInArrow(count, f"id {kind}, n_words long, n_tokens long").withColumnRenamed("id", id)
