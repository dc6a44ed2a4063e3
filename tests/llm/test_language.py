import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from sparkprep.llm.batches import utf8
from sparkprep.llm.language import LEAST_COUNT, ORDER, UNDETERMINED, context_symbols, held_out, identify, train


def code_length(text, contexts, kept):
    """Bits of a text by the definition; ``contexts``: context -> Counter of next bytes."""
    data, total = b"\0" * ORDER + text.encode(), 0.0
    marks = [None] * ORDER + list(text.encode())
    for i in range(ORDER, len(data)):
        bits = 0.0
        for k in range(ORDER, -1, -1):
            context = tuple(marks[i - k : i])
            if k and context not in kept:
                continue
            seen = contexts.get(context)
            if not seen:
                continue
            n, q = sum(seen.values()), len(seen)
            if marks[i] in seen:
                bits -= math.log2(seen[marks[i]] / (n + q))
                break
            bits -= math.log2(q / (n + q))
        else:
            bits += 8
        total += bits
    return total


def test_lengths_follow_the_definition(spark):
    rows = [("a", "the cat sat on the mat. " * 20), ("a", "then the rat ran"), ("b", "le chat est sur la table. " * 20), ("b", "été"), (None, "x"), ("a", None)]
    model = train(spark.createDataFrame(rows, "lang string, text string").repartition(3))
    assert model.languages == ["a", "b"]
    counts = {name: defaultdict(Counter) for name in "ab"}
    for name, text in rows:
        if name and text:
            marks = [None] * ORDER + list(text.encode())
            for i in range(ORDER, len(marks)):
                for k in range(ORDER + 1):
                    counts[name][tuple(marks[i - k : i])][marks[i]] += 1
    kept = {c for name in "ab" for c, seen in counts[name].items() if sum(seen.values()) >= LEAST_COUNT}
    import pyarrow as pa

    texts = ["the table", "", "été sur", "z", "the cat ran sur le mat, 12", "the 日本 cat zz the"]
    found = model.lengths(*utf8(pa.array(texts)))
    for row, text in zip(found, texts):
        assert np.allclose(row, [code_length(text, counts[n], kept) for n in "ab"], atol=1e-3), text
    assert (found[1] == 0).all()


def test_contexts_do_not_cross_texts():
    rows = context_symbols(np.arange(1, 8, dtype=np.int32), np.array([0, 2, 2, 7]))
    assert rows.tolist() == [[0, 0, 0, 0, 0, 3, 4], [0, 0, 0, 0, 3, 4, 5], [0, 1, 0, 3, 4, 5, 6], [1, 2, 3, 4, 5, 6, 7]]


def test_held_out_accuracy(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = identify(docs, train(docs.filter(~held_out())), keep=["lang"]).filter(held_out())
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97


def test_odd_rows(spark, data, odd_documents, no_documents):
    model = train(spark.read.parquet(f"{data}/documents.parquet"))
    rows = identify(odd_documents, model, keep=["name"]).collect()
    assert len(rows) == 14 and identify(no_documents, model).count() == 0
    by = {r.name: r for r in rows}
    for name in ("name0", "name1", "name2", "name7"):
        assert (by[name].lang_pred, by[name].score) == (UNDETERMINED, 0.0)
    assert all(0 < r.score <= 1 and r.lang_pred in model.languages for n, r in by.items() if n not in ("name0", "name1", "name2", "name7"))
    for nothing in (train(no_documents), train(odd_documents.selectExpr("text", "cast(null as string) AS lang"))):
        assert nothing.languages == []
        assert {(r.lang_pred, r.score) for r in identify(odd_documents, nothing).collect()} == {(UNDETERMINED, 0.0)}


def test_copies_and_long_documents_leave_enough_to_learn_from(spark):
    page = "zz yy xx ww vv uu " * 500
    rows = [("a", page)] * 300 + [("a", f"the cat sat on the mat {i} times ") for i in range(40)]
    rows += [("b", f"{i} le chat est sur la table " * 400) for i in range(3)]
    model = train(spark.createDataFrame(rows, "lang string, text string").repartition(4), train_bytes=12_000)
    assert model.languages == ["a", "b"]
    found = identify(spark.createDataFrame([(1, "the cat sat on the mat"), (2, "le chat est sur la table")], "doc_id long, text string"), model)
    assert {r.doc_id: r.lang_pred for r in found.collect()} == {1: "a", 2: "b"}
    few = train(spark.createDataFrame(rows, "lang string, text string"), train_bytes=1)
    assert few.languages == ["a", "b"]
