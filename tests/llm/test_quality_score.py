import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sparkprep.llm import quality
from sparkprep.llm.batches import utf8
from sparkprep.llm.language import held_out


def test_statistics_of_small_texts():
    x = quality.statistics(*utf8(pa.array(["a a B!\na a b!", "", None, " \n ", "One, two."])))
    named = [dict(zip(quality.FEATURES, row)) for row in x]
    first = named[0]
    assert np.isclose(first["log_words"], np.log(7)) and np.isclose(first["repeats_word_before"], 2 / 6)
    assert np.isclose(first["different_words"], 3 / 6) and np.isclose(first["most_frequent_word"], 4 / 6)
    assert np.isclose(first["upper_letters"], 1 / 6) and np.isclose(first["line_ends"], 2 / 6) and first["different_lines"] == 1
    assert np.isclose(named[4]["sentence_ends"], 1) and (x[1:4] == 0).all()


def test_rising_is_the_least_squares_fit():
    draw = np.random.default_rng(3)
    y, w = draw.normal(size=40) + np.arange(40) / 20, draw.uniform(0.5, 2, 40)
    at, values = quality.rising(np.arange(40.0), y, w)
    assert (np.diff(values) > 0).all() and (np.diff(at) > 0).all()
    best = [max(min(np.average(y[a : b + 1], weights=w[a : b + 1]) for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    assert np.allclose(np.unique(np.round(best, 9)), np.round(values, 9))


def test_fourier_features_approximate_the_kernel():
    model = quality.Model(np.zeros(17), np.ones(17))
    draw = np.random.default_rng(1)
    x = draw.normal(size=(40, 17)) * 0.5
    z = model.fourier(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-distance / (2 * 17))).max() < 0.3


def test_held_out_accuracy(spark, data):
    folder = data.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    measured = quality.measure(docs)
    scored = quality.score(measured, quality.train(measured.filter(~held_out()), labels))
    found = scored.join(labels, "doc_id").filter(held_out())
    right = ((F.col("score") >= 0.7).cast("int") == F.col("quality")).cast("double")
    assert found.agg(F.avg(right)).first()[0] > 0.95


def test_odd_rows(spark, odd_documents, no_documents):
    measured = quality.measure(odd_documents)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (6, 1), (9, 0), (None, 1), (77, 1)], "doc_id long, quality int")
    model = quality.train(measured, labels)
    rows = quality.score(measured, model).collect()
    assert len(rows) == 14 and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(quality.measure(no_documents), model).count() == 0
    for nothing in (quality.train(measured, labels.limit(0)), quality.train(quality.measure(no_documents), labels)):
        assert {r.score for r in quality.score(measured, nothing).collect()} == {0.5}


def test_scores_are_those_of_a_plain_ridge_fit(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    measured = quality.measure(docs).repartition(5)
    model = quality.train(measured, labels)
    rows = measured.join(labels, "doc_id").orderBy("doc_id").collect()
    x, y = np.array([r.x for r in rows]), np.array([r.quality for r in rows], float)
    deviation = x.std(axis=0)
    plain = quality.Model(x.mean(axis=0), np.where(deviation > 1e-9, deviation, 1.0))
    z = plain.fourier(x)
    penalty = np.diag([1e-4 * len(x)] * quality.DIMENSIONS + [0.0]) + 1e-9 * np.eye(quality.DIMENSIONS + 1)
    plain.weights = np.linalg.solve(z.T @ z + penalty, z.T @ y)
    assert np.allclose(model.raw(x), plain.raw(x), atol=1e-6)
    at = np.round((plain.raw(x) + 1) * quality.BINS).astype(int)
    bins = np.unique(at)
    plain.points = quality.rising(bins / quality.BINS - 1, np.array([y[at == b].mean() for b in bins]), np.array([(at == b).sum() for b in bins], float))
    got = {r.doc_id: r.score for r in quality.score(measured, model).collect()}
    assert np.allclose([got[r.doc_id] for r in rows], plain.score(x), atol=1e-3)
