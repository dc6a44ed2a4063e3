"""Ids of the words of texts by a tokenizer file, with a table of frequent words."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame

from sparkprep.llm.cache import Memo, built

# ASCII marks that never join with a letter or digit before them; "'" may.
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


class Letters:
    """Words that are made of letters only, as a tokenizer's rules turn them into its symbols.

    Covers the Latin letters that the rules map one by one, and to a single word when together;
    the tokenizer itself is asked for each.
    """

    def __init__(self, tokenizer):
        self.map: dict[int, str] = {}
        for letter in filter(str.isalpha, map(chr, range(0x41, 0x250))):
            normal = tokenizer.normalizer.normalize_str(letter)
            found = tokenizer.pre_tokenizer.pre_tokenize_str(normal)
            if len(normal) == 1 and len(found) == 1:
                self.map[ord(letter)] = found[0][0]
        together = "".join(map(chr, self.map))
        found = tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(together))
        if [word for word, _ in found] != [together.translate(self.map)]:
            self.map = {}
        self.known = frozenset(map(chr, self.map))

    def symbols(self, word: str) -> str | None:
        """The word in the tokenizer's symbols; None if it needs the full rules."""
        return word.translate(self.map) if self.known.issuperset(word) else None


class WordTokens:
    """Ids by the tokenizer, for tokenizers that drop white space and lower-case letters.

    No token of such a tokenizer crosses white space, nor the border between a letter or digit
    and the marks that end a word, so words are encoded by themselves. Texts are cut at
    the contents of added tokens first, as the tokenizer does; if one of them is not special, or
    has rules of its own for what is around it, the tokenizer encodes each text as a whole.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {token.content: np.array([number], "<u4").tobytes() for number, token in added.items() if token.content}
        longest = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None
        self.whole = any(not t.special or t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values())
        self.tokenizer.encode_special_tokens = not self.whole  # in words no added token is left, but lower case could make one
        self.letters = Letters(self.tokenizer)
        self.cores = Memo(self._core, 150_000)
        self.words = Memo(self._word, 250_000)

    def _core(self, word: str) -> bytes:
        symbols = self.letters.symbols(word)
        if symbols:
            ids = [token.id for token in self.tokenizer.model.tokenize(symbols)]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if word.isascii():
            word = word.lower()
        core = word.rstrip(MARKS)
        if core and core != word and core[-1].isalnum():
            return self.cores[core] + self.cores[word[len(core) :]]
        return self.cores[word] if word else b""

    def encode(self, text: str) -> bytes:
        """All ids of a text as little-endian 32-bit integers."""
        if self.whole:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.cuts is None or self.cuts.search(text) is None:
            return self._plain(text)
        return b"".join([self.added[x] if i % 2 else self._plain(x) for i, x in enumerate(self.cuts.split(text))])

    def _plain(self, text: str) -> bytes:
        return b"".join([*map(self.words.__getitem__, text.replace("\n", " ").split(" "))])


def shared_tokens(documents: DataFrame, tokenizer_path: str) -> Callable[[], WordTokens]:
    """A function that gives the tokenizer on any worker; the file is read here only."""
    definition = Path(tokenizer_path).read_text()
    key = hashlib.sha256(definition.encode()).hexdigest()
    source = documents.sparkSession.sparkContext.broadcast(definition)
    return lambda: built(key, source, WordTokens)
