import hashlib
import random
import zlib

import numpy as np
import pytest

from sparkprep.llm.periods import Catchers, periodic_runs, text_runs
from sparkprep.llm.queries import QUERIES


def runs_of(words, exponent=4):
    """``start, end, period`` by testing each period on all words."""
    found = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= exponent * q:
                found.append((start, i + q, q))
            i += i == start
    smallest = lambda s, e, q: not any(words[s : e - p] == words[s + p : e] for p in range(1, q))
    return sorted((x for x in found if smallest(*x)), key=lambda x: (x[0], x[2]))


def sequences(seed, count):
    draw = random.Random(seed)
    for _ in range(count):
        words, size = [], draw.randint(0, 120)
        while len(words) < size:
            words += [
                lambda: [draw.randrange(2) for _ in range(draw.randint(1, 6))] * draw.randint(1, 12),
                lambda: [draw.randrange(3)] * draw.randint(1, 15),
                lambda: ([0] * draw.randint(1, 9) + [1]) * draw.randint(1, 7),
                lambda: [draw.randrange(50) for _ in range(draw.randint(1, 9))],
            ][draw.randrange(4)]()
        yield words


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_runs_do_not_depend_on_how_words_arrive(step):
    for words in sequences(step, 150):
        catchers = Catchers()
        for i in range(0, len(words), step):
            catchers.append(np.array(words[i : i + step], np.int64))
        assert [tuple(r) for r in catchers.runs().tolist()] == runs_of(words)


def test_reports_while_words_arrive():
    catchers = Catchers()
    catchers.append(np.array([9, 1, 2, 1, 2, 1, 2, 1]))
    assert not len(catchers.runs())
    catchers.append(np.array([2]))
    assert catchers.runs().tolist() == [[1, 9, 2]]
    catchers.append(np.array([1, 5]))
    assert catchers.runs().tolist() == [[1, 10, 2]]


def test_texts_of_a_batch_stay_apart():
    texts = [*sequences(3, 80), [], [1] * 5, [1] * 5]
    owner, runs = text_runs(np.array(sum(texts, [])), np.array([*map(len, texts)]))
    assert [(d, *r) for d, r in zip(owner.tolist(), runs.tolist())] == [(d, *r) for d, t in enumerate(texts) for r in runs_of(t)]


def test_long_sequences_in_chunks():
    base = np.random.default_rng(1).integers(0, 300, 50_000)
    assert text_runs(np.tile(base, 5), np.array([250_000]))[1].tolist() == [[0, 250_000, 50_000]]
    assert text_runs(np.zeros(300_000, np.int64), np.array([300_000]))[1].tolist() == [[0, 300_000, 1]]


def expected(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = [(s, e - s, q) for s, e, q in runs_of(words) if e - s >= 6]
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in runs), default=None)
    top = (best[1], -best[0], best[2], -best[0] * 1000 // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def test_query_gives_what_brute_force_gives(spark, odd_documents, tmp_path):
    texts = [" ".join(f"w{x}" for x in words) for words in sequences(8, 300)]
    rows = [*enumerate(texts, 100), *[(i, " \t".join(f"v{k % 31}" for k in range(200)) + "\n") for i in range(500, 540)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_documents.filter("length(text) < 1000 or text is null").select("doc_id", "text"))
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    want = [expected(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(r.n_runs > 1 for r in got) > 20 and sum(r[0] % 10 == 0 for r in rows if r[0]) > 20


def test_odd_rows(odd_documents, no_documents):
    rows = periodic_runs(odd_documents).collect()
    assert len(rows) == 14 and sorted(r.n_words for r in rows) == sorted([0, 0, 0, 1, 1, 1, 1, 0, 60_000, 60_001, 4, 200, 1, 50])
    long = next(r for r in rows if r.doc_id == 9)
    assert [tuple(r) for r in long.runs] == [(0, 200, 1)] and long.collapsed == "x"
    assert periodic_runs(no_documents).count() == 0
