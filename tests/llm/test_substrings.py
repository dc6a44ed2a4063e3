import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sparkprep.llm.batches import SPACE, mix
from sparkprep.llm.substrings import ROUNDS, Symbols, anchors, remove_repeats


def reference(texts, size=35):
    """Words, removed words and kept text of each text, by counting all windows."""
    split = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    found = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        found.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return found


def planted(seed):
    """Texts with shared passages, copies, runs, and periodic stretches of a few words."""
    draw = random.Random(seed)
    word = lambda n: f"w{draw.randrange(n)}"
    passages = [[word(50) for _ in range(draw.randint(30, 90))] for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(draw.randint(0, 6)):
            kind = draw.randrange(5)
            if kind == 0:
                parts += draw.choice(passages)
            elif kind == 1:
                parts += [word(3)] * draw.randint(1, 80)
            elif kind == 2:
                parts += [word(4) for _ in range(draw.randint(1, 3))] * draw.randint(1, 40)
            else:
                parts += [word(4000) for _ in range(draw.randint(1, 60))]
        texts.append(" ".join(parts))
    return texts + texts[:3]


@pytest.mark.parametrize("seed", range(4))
def test_removes_what_counting_all_windows_removes(spark, seed):
    texts = planted(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in remove_repeats(docs).collect()}
    for i, (n, gone, kept) in enumerate(reference(texts)):
        assert (got[i].n_words, got[i].n_removed, got[i].kept_text) == (n, gone, kept), i
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_equal_strings_have_equal_symbols_inside():
    draw = np.random.default_rng(2)
    passage, size = draw.integers(0, 30, 400), 35
    values = np.concatenate([draw.integers(0, 30, 101), passage, draw.integers(0, 30, 77), passage, draw.integers(0, 30, 50)])
    level = Symbols(mix(values.astype(np.uint64)), np.zeros(len(values), int))
    for number in range(ROUNDS):
        level.round(number)
    inside = [{(s - at, n) for s, lo, hi, n in zip(level.start, level.left, level.right, level.name) if lo >= at and hi <= at + 400} for at in (101, 578)]
    assert inside[0] == inside[1] and len(inside[0]) > 100
    found = anchors(mix(values.astype(np.uint64)), np.zeros(len(values), int), size)
    assert (np.diff(found["first"]) > 0).all() and (found["last"] - found["first"] + 1).sum() == len(values) - size + 1


def test_odd_rows(odd_documents, no_documents):
    rows = remove_repeats(odd_documents, keep=["name", "first"]).collect()
    assert len(rows) == 14 and remove_repeats(no_documents).count() == 0
    by = {r.name: r for r in rows}
    source = {r.name: r for r in odd_documents.collect()}
    names = sorted(source)
    for name, (n, gone, kept) in zip(names, reference([source[k].text for k in names])):
        assert (by[name].n_words, by[name].n_removed, by[name].kept_text, by[name].doc_id) == (n, gone, kept, source[name].doc_id)
        assert by[name].first == source[name].first
    assert SPACE.sum() == 6


def test_words_that_modular_sums_confuse_stay_apart(spark):
    one, other = ("".join("ab"[bin(i).count("1") % 2 ^ swap] for i in range(1024)) for swap in (0, 1))
    words = [f"w{i}" for i in range(60)]
    pair = [" ".join(x if i in (5, 30, 55) else w for i, w in enumerate(words)) for x in (one, other)]
    docs = spark.createDataFrame(list(enumerate(pair)), "doc_id long, text string")
    assert [r.n_removed for r in remove_repeats(docs).collect()] == [0, 0]


def test_layout_stays_around_what_is_removed(spark):
    passage = "\n".join(f"p{i} q{i}\t" for i in range(40))
    texts = [f"one\n two  {passage}three\r\n four ", f" five\n\n{passage} \n", "six\n  seven", None, "  ", passage.replace("\n", "  ")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: (r.kept_text, r.n_removed) for r in remove_repeats(docs, layout=True).collect()}
    assert got == {0: ("one\n two  three\r\n four ", 80), 1: (" five\n\n", 80), 2: ("six\n  seven", 0), 3: ("", 0), 4: ("  ", 0), 5: ("", 80)}
