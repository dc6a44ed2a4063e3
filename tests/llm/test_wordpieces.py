import json

import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from sparkprep.llm.wordpieces import LongestMatch, count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def greedy(word, vocabulary):
    pieces = at = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return 1
        pieces, at = pieces + 1, end
    return pieces


@settings(max_examples=400, deadline=None)
@given(vocabulary=st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), word=st.text("abcd", max_size=12))
def test_counts_equal_greedy_matching(vocabulary, word):
    assert LongestMatch(sorted(vocabulary)).count(word) == greedy(word, vocabulary)


def reference(text, tokenizer, vocabulary):
    words = [w for w, _ in tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(text or ""))]
    return len(words), sum(greedy(w + "</w>", vocabulary) for w in words)


def test_data_and_odd_rows(spark, data, odd_documents, no_documents):
    tokenizer, vocabulary = Tokenizer.from_file(PATH), set(json.load(open(PATH))["model"]["vocab"])
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    for table in (docs, odd_documents):
        want = sorted((r.doc_id or -1, *reference(r.text, tokenizer, vocabulary)) for r in table.collect() if len(r.text or "") < 50_000)
        got = sorted((r.doc_id or -1, r.n_words, r.n_tokens) for r in count_tokens(table.filter("text IS NULL OR length(text) < 50000"), PATH).collect())
        assert got == want
    assert count_tokens(odd_documents, PATH).count() == 14 and count_tokens(no_documents, PATH).count() == 0
