import math
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from sparkprep.llm import rules
from sparkprep.llm.batches import utf8
from sparkprep.llm.queries import ORACLE, QUERIES


def counts(text):
    """The five base counts of a text, by definition."""
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    lines = [x for x in text.split("\n") if x.encode().split()]
    windows = Counter(zip(words, words[1:], words[2:]))
    again = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again))


def texts(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice(["a", "b", "c", "d,", "日本", "é#", "\x1c", "$", "x" * 60])
    return ["".join(word() + draw.choice([" ", "  ", "\n", "\t", " \n", "\r\n"]) for _ in range(draw.randint(0, 60))) for _ in range(120)]


def test_counts_of_a_batch_are_those_of_each_text():
    batch = [*texts(1), None, "", " \n\n ", "a\na", "\na", "a a a a", "a\n a\na\n\n", "one"]
    found = rules.Texts(*utf8(pa.array(batch)))
    got = zip(found.n_words, found.per_byte(rules.VISIBLE), found.per_byte(rules.SYMBOL), found.repeated_lines(), found.repeated_words())
    assert [tuple(map(int, x)) for x in got] == [counts(t) for t in batch]
    assert found.classes().sum(axis=1).tolist() == [len(t or "") for t in batch]


def test_distance_by_definition():
    draw = np.random.default_rng(2)
    reference = draw.dirichlet(np.ones(6))
    rows = np.array([draw.integers(0, 900, 6), [10**9, 0, 0, 0, 0, 0], np.round(reference * 10**9)])
    for row, d in zip(rows, rules.divergence(rows, reference)):
        p = row / row.sum()
        m = (p + reference) / 2
        js = sum(x * math.log2(x / y) / 2 for q in (p, reference) for x, y in zip(q, m) if x > 0)
        assert d == pytest.approx(math.sqrt(max(0, js - 5 / (8 * math.log(2) * row.sum()))))
    assert rules.divergence(np.array([[0, 10**9]]), np.array([1.0, 0.0]))[0] == pytest.approx(1)


LANGUAGES = {"aa": "the of and to in".split(), "bb": "der die und zu mit".split()}


def corpus(seed, count=120):
    """``lang, text`` of prose-like texts, and texts of marks, of other words and of one language under the name of the other."""
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        lang = draw.choice(sorted(LANGUAGES))
        kind = "prose" if i % 6 else draw.choice(["marks", "names", "other"])
        words = LANGUAGES["bb" if (lang == "aa") == (kind == "other") else "aa"]
        own = [draw.choice(words) if draw.random() < 0.5 and kind != "names" else "".join(draw.choices("abcdefgh", k=5)) for _ in range(draw.randint(60, 150))]
        text = " ".join(w + ("###" if kind == "marks" else "") for w in own)
        rows.append((lang, text.capitalize() + ".", kind))
    return rows


def test_keeps_what_is_like_its_language(spark):
    rows = corpus(4)
    hot = "zz yy xx ww " * 30
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows + [("aa", hot, "copies")] * 100)], "doc_id long, lang string, text string, kind string")
    references = rules.learn_references(docs.repartition(4))
    assert sorted(references) == ["aa", "bb"]
    assert set(references["aa"].words) == set(LANGUAGES["aa"])  # very many copies of a text move nothing
    judged = rules.judge(docs, references).join(docs.select("doc_id", "kind"), "doc_id").collect()
    assert {r.kind: r.kept for r in judged} == {"prose": True, "marks": False, "names": False, "other": False, "copies": False}
    assert all(r.kept == (r.kind == "prose") for r in judged)
    unmarked = rules.judge(docs.filter("kind IN ('prose', 'other')").selectExpr("doc_id", "text", "cast(null as string) AS lang"), references)
    assert all(r.kept for r in unmarked.collect())
    strange = rules.judge(docs.selectExpr("doc_id", "text", "'cc' AS lang"), references).collect()
    assert all(r.kept != r.base_failed and r.word_distance is None for r in strange)


def test_odd_rows(spark, odd_documents, no_documents):
    references = rules.learn_references(odd_documents)
    rows = rules.judge(odd_documents, references).collect()
    assert len(rows) == 14 and all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert {r.doc_id: r.n_repeat_words for r in rows}[9] == 200
    assert rules.learn_references(no_documents) == {} and rules.judge(no_documents, references).count() == 0
    nowhere = rules.judge(odd_documents, {}).collect()
    assert all(r.kept != r.base_failed and r.class_distance is None for r in nowhere)
    long = spark.createDataFrame([(None, None, "a"), (1, "b " * 5000, None)], "doc_id long, text string, lang string")
    assert rules.learn_references(long) == {} and rules.judge(long, {}).count() == 2


def test_query_gives_what_sql_gives(spark, odd_documents, tmp_path):
    rows = [(i, t, lang) for i, (lang, t, _) in enumerate(corpus(9, 200))] + [(500 + i, t, None) for i, t in enumerate(texts(6))]
    rows += [(700 + i, t, None) for i, (_, t, _) in enumerate(corpus(10, 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").unionByName(odd_documents.filter("doc_id != 8 or doc_id is null").selectExpr("doc_id", "text", "'aa' AS lang"))
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_quality_rules"](spark, str(tmp_path))
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = db.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE['op12_quality_rules']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert 50 < sum(x[-1] for x in want) < len(want) - 50
