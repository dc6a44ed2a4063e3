import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from sparkprep.llm.bpe import Encoder, PrefixTable, decode_ids, encode_documents, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(read_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


PARTS = st.sampled_from(["a", "The", "ing", " ", "  ", "\n", "\t", "'s", "'", "é", "12", "٣", "!", "\x85", "\u3000", "日本", "\x1c", "|||"])


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=40), st.lists(PARTS, max_size=14).map("".join)))
def test_ids_equal_the_library(encoder, library, text):
    assert ids(encoder.encode(text)) == library.encode_ordinary(text)
    assert encoder.decode(encoder.encode(text)) == text.encode()


@settings(max_examples=100, deadline=None)
@given(a=st.text(max_size=20), b=st.text(max_size=20))
def test_appending_equals_encoding_at_once(encoder, a, b):
    table = PrefixTable(encoder, a.encode())
    table.append(b.encode())
    assert table.last == PrefixTable(encoder, (a + b).encode()).last
    assert b"".join(encoder.tokens[t] for t in table.tokens()) == (a + b).encode()


@settings(max_examples=100, deadline=None)
@given(text=st.text(max_size=60), at=st.integers(0, 60), n=st.integers(0, 5), new=st.text(max_size=5))
def test_an_edit_equals_encoding_anew(encoder, text, at, n, new):
    data, new = text.encode(), new.encode()
    begin = min(at, len(data))
    end = min(begin + n, len(data))
    table = PrefixTable(encoder, data)
    table.replace(begin, end, new)
    assert table.last == PrefixTable(encoder, data[:begin] + new + data[end:]).last


def test_an_edit_stays_local(encoder):
    table = PrefixTable(encoder, b"international" * 500)
    assert table.replace(2000, 2001, b"X") < 200


def test_pairs_follow_the_definition(encoder):
    random = np.random.default_rng(5)
    for a, b in random.integers(0, 3000, (3000, 2)).tolist():
        first, second = encoder.tokens[a], encoder.tokens[b]
        whole = all(encoder.merges(t)[0] == [t] for t in (first, second))
        if whole:
            assert encoder.follows[(a + 1 << 24) | b] == (encoder.merges(first + second)[0] == [first, second])


def test_odd_rows_round_trip(odd_documents, no_documents, library):
    encoded = encode_documents(odd_documents, PATH, public_tokenizers.PATTERN)
    assert encoded.columns == ["doc_id", "ids"]
    rows = decode_ids(encoded, PATH).collect()
    want = sorted((r.doc_id or -1, (r.text or "").encode()) for r in odd_documents.collect())
    assert sorted((r.doc_id or -1, bytes(r.text)) for r in rows) == want
    long = next(r for r in rows if r.doc_id == 6)
    expected = np.array(library.encode_ordinary(bytes(long.text).decode()), "<u4").tobytes()
    assert hashlib.sha256(long.ids).digest() == hashlib.sha256(expected).digest()
    assert encode_documents(no_documents, PATH, public_tokenizers.PATTERN).count() == 0


def test_null_ids_stay_null(spark):
    assert decode_ids(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), PATH).first().text is None
