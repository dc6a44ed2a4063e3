import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkprep.functions.overlap import clipped_overlap, cosine, lcs_length, ngrams, tokens
from sparkprep.operators import metrics as M

ROWS = [
    ("Where is it?", "The cat sat on the mat today.", "the cat is on the mat today"),
    ("Who?", "A b c d e f", "a b c d e f"),
    ("What?", "nothing in common", "entirely different words here"),
    ("Why?", "the the the cat", "the the dog"),
    ("Empty?", "something", ""),
]


def rows(spark, values=ROWS):
    return spark.createDataFrame(values, "input string, output string, prediction string")


def token_list(text):
    return [t for t in "".join(c if c.isalnum() else " " for c in text.lower()).split()]


def gram_list(items, n):
    return [" ".join(items[i : i + n]) for i in range(len(items) - n + 1)]


def common(a, b):
    return sum((Counter(a) & Counter(b)).values())


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0] + [
            old + 1 if x == y else max(up, 0)
            for y, old, up in zip(b, row, row[1:])
        ]
        for j in range(1, len(row)):
            row[j] = max(row[j], row[j - 1])
    return row[-1]


def f1(hits, a, b):
    return 2 * hits / (a + b) if hits else 0.0


def test_overlap_and_subsequence_on_random_lists(spark):
    draw = random.Random(1)
    pairs = [tuple([draw.choice("abcdé") for _ in range(draw.randint(0, 30))] for _ in "xy") for _ in range(200)]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    found = df.select(
        clipped_overlap(F.col("a"), F.col("b")),
        clipped_overlap(ngrams(F.col("a"), 3), ngrams(F.col("b"), 3)),
        lcs_length()("a", "b"),
    ).collect()
    for (a, b), (one, three, longest) in zip(pairs, found):
        assert one == common(a, b)
        assert three == common(gram_list(a, 3), gram_list(b, 3))
        assert longest == lcs(a, b)


def test_subsequence_over_blocks(monkeypatch):
    import random

    from sparkprep.functions import overlap

    draw = random.Random(8)
    for block in (1, 3, 7, 64):
        monkeypatch.setattr(overlap, "LCS_BLOCK", block)
        for _ in range(60):
            a, b = ([draw.choice("abcd") for _ in range(draw.randint(0, 30))] for _ in range(2))
            assert overlap.common_subsequence(a, b) == lcs(a, b)


def test_tokens(spark):
    df = spark.range(1).select(tokens(F.lit("Él's 2-fold!  ")), tokens(F.lit("Él's 2-fold!"), unicode=False))
    assert list(df.first()) == [["él", "s", "2", "fold"], ["l", "s", "2", "fold"]]


def test_text_metrics_match_definitions(spark):
    found = {r.metric: r.value for r in M.text_metrics(rows(spark)).collect()}
    pairs = [(token_list(o), token_list(p)) for _, o, p in ROWS]
    for n in (1, 2):
        scores = [f1(common(gram_list(o, n), gram_list(p, n)), len(gram_list(o, n)), len(gram_list(p, n))) for o, p in pairs]
        assert found[f"rouge{n}"] == pytest.approx(sum(scores) / len(scores))
    longest = [f1(lcs(o, p), len(o), len(p)) for o, p in pairs]
    assert found["rougeL"] == pytest.approx(sum(longest) / len(longest))
    logs = []
    for n in range(1, 5):
        hits = sum(common(gram_list(o, n), gram_list(p, n)) for o, p in pairs)
        logs.append(math.log(hits / sum(len(gram_list(p, n)) for _, p in pairs)))
    expected, predicted = (sum(len(x[i]) for x in pairs) for i in (0, 1))
    penalty = 0 if predicted > expected else 1 - expected / predicted
    assert found["bleu"] == pytest.approx(math.exp(sum(logs) / 4 + penalty))


def test_metrics_are_in_range_and_perfect_on_copies(spark):
    assert all(0 <= r.value <= 1 for r in M.text_metrics(rows(spark)).collect())
    copies = rows(spark, ROWS[:4]).withColumn("prediction", F.col("output"))
    assert all(r.value == pytest.approx(1) for r in M.text_metrics(copies).collect())


def test_short_texts_have_no_bleu(spark):
    assert M.bleu(rows(spark, [("q", "a b c", "a b c")])).first().bleu == 0
    assert M.bleu(rows(spark, [("q", "a b c d", None)])).first().bleu == 0
    with pytest.raises(ValueError):
        M.text_metrics(rows(spark), ("other",))


def test_classification(spark):
    counts = {("red", "red"): 4, ("red", "blue"): 1, ("blue", "blue"): 2, ("blue", "green"): 2, ("green", "red"): 1}
    values = [pair for pair, n in counts.items() for _ in range(n)]
    df = spark.createDataFrame([(label, label, p) for label, p in values], "output string, label string, prediction string")
    row = M.classification_metrics(df).first()
    assert row.accuracy == pytest.approx(0.6) == row.recall
    assert row.precision == pytest.approx((5 * 4 / 5 + 4 * 2 / 3 + 0) / 10)
    assert row.f1 == pytest.approx((5 * 0.8 + 4 * 4 / 7 + 0) / 10)
    assert {r["class"]: r.support for r in M.class_scores(M.confusion_matrix(df)).collect()} == {"red": 5, "blue": 4, "green": 1}


def test_qa(spark):
    values = [("q", "the old bridge", "THE OLD BRIDGE\t"), ("q", "in the old town", "old town"), ("q", "seven", "it is seven, not six"), ("q", "north", "south")]
    row = M.qa_metrics(rows(spark, values)).first()
    assert row.exact_match == pytest.approx(1 / 4) and row.contains_answer == pytest.approx(3 / 4)
    blank = M.qa_metrics(rows(spark, [("q", "x", " "), ("q", "x", None)])).first()
    assert list(blank) == [0, 0]


@pytest.mark.parametrize("task,extra", [("general", set()), ("classification", {"accuracy", "precision", "recall", "f1"}), ("qa", {"exact_match", "contains_answer"})])
def test_task_types(spark, task, extra):
    df = rows(spark).withColumn("label", F.col("output")).withColumnsRenamed({"input": "input_text", "output": "output_text"})
    found = {r.metric for r in M.task_metrics(df, task_type=task).collect()}
    assert found == {"rouge1", "rouge2", "rougeL", "bleu"} | extra
    with pytest.raises(ValueError):
        M.task_metrics(df, task_type="other")


def test_cosine(spark):
    row = spark.range(1).select(
        cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))),
        cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))),
    ).first()
    assert row[0] == pytest.approx(math.sqrt(0.5)) and row[1] is None
