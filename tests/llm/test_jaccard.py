import random
from collections import Counter

import numpy as np

from sparkprep.llm import graph
from sparkprep.llm.jaccard import common, prefix_depth, signatures, similar_documents


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def reference(documents, threshold=0.8, size=5):
    """``doc_id: (links, component)`` by comparing all pairs."""
    sets = {}
    for doc, text in documents.items():
        w = lowered(text).encode().split()
        sets[doc] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    parent, links = {d: d for d in sets}, Counter()

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {d: (links[d], root(d)) for d in ids}


def families(seed):
    """Texts in families of copies and variants of which some lie close to the threshold."""
    draw = random.Random(seed)
    texts = []
    for _ in range(25):
        base = [f"w{draw.randrange(3000)}" for _ in range(draw.randint(1, 150))]
        for _ in range(draw.randint(1, 8)):
            own = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
                own[draw.randrange(len(own))] = draw.choice(["New", "words", "x"])
            texts.append(" ".join(own))
    return texts


def test_links_equal_brute_force(spark):
    for seed in range(2):
        documents = dict(enumerate(families(seed)))
        df = spark.createDataFrame(list(documents.items()), "doc_id long, text string").repartition(4)
        got = {r.doc_id: r for r in similar_documents(df).collect()}
        want = reference(documents)
        assert {d: (r.n_links, r.component_id) for d, r in got.items()} == want
        assert all(r.kept == (d == r.component_id) for d, r in got.items())


def test_data(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r.doc_id: (r.n_links, r.component_id) for r in similar_documents(docs).collect()}
    assert got == reference({r.doc_id: r.text for r in docs.collect()})


def test_a_large_group_is_cut_into_blocks(spark, monkeypatch):
    from sparkprep.llm import jaccard

    monkeypatch.setattr(jaccard, "BLOCK", 50)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join([*base[:60], f"x{i}", *base[60:]]) for i in range(220)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = similar_documents(df).collect()
    assert {(r.n_links, r.component_id) for r in rows} == {(219, 0)} and len(rows) == 220


def test_odd_rows(odd_documents, no_documents):
    rows = similar_documents(odd_documents).collect()
    assert len(rows) == 14 and similar_documents(no_documents).count() == 0
    by = {r.doc_id: (r.class_id, r.n_links, r.component_id, r.kept) for r in rows if r.doc_id is not None}
    assert by[1] == (1, 0, 1, True) and by[2] == (2, 0, 2, True) and by[3] == (3, 0, 3, True)
    assert by[4] == (4, 1, 4, True) and by[5] == (4, 1, 4, False)
    assert by[6] == (6, 1, 6, True) and by[7] == (7, 1, 6, False)
    assert [(r.n_links, r.component_id, r.kept) for r in rows if r.doc_id is None] == [(0, None, True)] * 3


def test_prefixes_are_shortened_to_the_target_recall():
    assert prefix_depth(0.8) == 5 and prefix_depth(0.99) == 8 and prefix_depth(0.05) == 1
    assert 1 - (1 - 0.8**5) ** 24 >= 0.9999 > 1 - (1 - 0.8**6) ** 24


def test_signatures_agree_as_often_as_sets_are_similar():
    draw = np.random.default_rng(4)
    values = draw.integers(0, 2**63, 3000, dtype=np.uint64)
    found = signatures(np.concatenate([values[:2000], values[500:2500]]), np.array([0, 2000, 4000]), 2000)
    assert abs((found[0] == found[1]).mean() - 1500 / 2500) < 0.05


def test_common_counts_by_either_way():
    draw = random.Random(3)
    sets = [np.array(sorted(draw.sample(range(20_000), draw.randint(0, 400))), np.uint64) for _ in range(30)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[:20]] for a in sets]
    assert common(sets, sets[:20]).tolist() == want
    assert common(sets[:2], sets[:3]).tolist() == [row[:3] for row in want[:2]]


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(200, 400)] + [(500, 501), (501, 502), (502, 500), (7, 7)]
    random.Random(1).shuffle(edges)
    found = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100} and {found[i] for i in range(200, 400)} == {1} == {found[1]}
    assert found[502] == 500 and 7 not in found
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_repeated_document_is_one(spark):
    text = [f"w{i}" for i in range(60)]
    near = " ".join([*text, "more"])
    df = spark.createDataFrame([(1, " ".join(text))] * 3 + [(2, near)] * 2, "doc_id long, text string").repartition(3)
    rows = similar_documents(df).collect()
    assert len(rows) == 5 and {(r.doc_id, r.n_links, r.component_id) for r in rows} == {(1, 1, 1), (2, 1, 1)}


def several(texts, threshold=0.8):
    """``doc_id: (links, component)`` of documents with several texts each."""
    flat = {(d, i): t for d, own in texts.items() for i, t in enumerate(own)}
    links, sets = {d: set() for d in texts}, {}
    for k, t in flat.items():
        w = lowered(t).split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    for a in flat:
        for b in flat:
            if a[0] != b[0] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                links[a[0]].add(b[0])
    least, before = {d: d for d in texts}, None
    while before != least:
        before, least = least, {d: min([least[d], *(least[e] for e in links[d])]) for d in texts}
    return {d: (len(links[d]), least[d]) for d in texts}


def test_documents_with_several_texts(spark, monkeypatch):
    from sparkprep.llm import jaccard

    draw, pool = random.Random(9), families(7)
    texts = {d: draw.choices(pool, k=draw.choice([1, 1, 2, 3])) for d in range(90)}
    texts[90] = pool[:40]
    df = spark.createDataFrame([(d, t) for d, own in texts.items() for t in own], "doc_id long, text string").repartition(3)
    want = several(texts)
    for block in (1024, 8):  # with the small one, document 90 and others are spread over blocks
        monkeypatch.setattr(jaccard, "BLOCK", block)
        assert {(r.doc_id, r.n_links, r.component_id) for r in similar_documents(df).collect()} == {(d, *v) for d, v in want.items()}


def test_words_that_modular_sums_confuse_stay_apart(spark):
    one, other = ("".join("ab"[bin(i).count("1") % 2 ^ swap] for i in range(1024)) for swap in (0, 1))
    words = [f"w{i}" for i in range(60)]
    pair = [" ".join(x if i in (5, 30, 55) else w for i, w in enumerate(words)) for x in (one, other)]
    docs = spark.createDataFrame(list(enumerate(pair)), "doc_id long, text string")
    assert {(r.class_id, r.n_links) for r in similar_documents(docs).collect()} == {(0, 0), (1, 0)}
