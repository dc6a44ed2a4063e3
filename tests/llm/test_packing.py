import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkprep.llm.packing import Windows, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def check(rows, documents, tokenizer, size):
    """Every id lies in one piece, and sequences have no gaps. Returns the share of padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, text in documents.items():
        ids, at = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4"), 0
        for r in sorted(pieces.pop(doc), key=lambda r: r.start):
            own = ids[r.start : r.start + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(own.tobytes()))
            if hasattr(r, "ids"):
                assert r.ids == own.tolist()
            at += r.length
        assert at == len(ids)
    assert not pieces
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    used = sum(r.length for r in rows)
    return 1 - used / (size * len(sequences)) if sequences else 0


@pytest.mark.parametrize("size, open_windows", [(4096, 64), (64, 4)])
def test_pieces_of_the_data(spark, data, tokenizer, size, open_windows):
    docs = spark.read.parquet(f"{data}/documents.parquet").repartition(40)
    rows = pack_documents(docs, PATH, size=size, open_windows=open_windows, with_ids=True).collect()
    padding = check(rows, {r.doc_id: r.text for r in docs.collect()}, tokenizer, size)
    assert padding < 0.1


def test_odd_rows(odd_documents, no_documents, tokenizer):
    unique = odd_documents.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    check(pack_documents(unique, PATH).collect(), {r.doc_id: r.text for r in unique.collect()}, tokenizer, 4096)
    rows = pack_documents(odd_documents, PATH).collect()
    assert sum(r.doc_id == 4 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 3
    assert pack_documents(no_documents, PATH).count() == 0


def test_windows_stay_bounded_and_fit_best():
    windows = Windows(10, 2)
    assert windows.place(6) == (0, 0, []) and windows.place(7) == (1, 0, [])
    assert windows.place(3) == (1, 7, [1])
    assert windows.place(5) == (2, 0, [])
    assert windows.place(8) == (3, 0, [0])  # fits nowhere: the fullest closes
    assert windows.place(10) == (4, 0, [4])


def test_added_tokens_in_texts(spark):
    plain = Tokenizer.from_file(PATH)  # as it comes, without the switch
    texts = ["first part <|endoftext|> second", "<|startoftext|>It's<|endoftext|>", "a<|endoftext|><|endoftext|>'s b", "x<|ENDOFTEXT|>' <|endoftext|", "<|<|endoftext|>|>\nÉté<|startoftext|>é 1"]
    texts += [" ".join(texts) * 300, "<|endoftext|>"]
    assert plain.encode(texts[0], add_special_tokens=False).ids.count(49407) == 1
    documents = dict(enumerate(texts))
    df = spark.createDataFrame(list(documents.items()), "doc_id long, text string")
    check(pack_documents(df, PATH, with_ids=True).collect(), documents, plain, 4096)
