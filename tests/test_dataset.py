from pyspark.sql import functions as F

from sparkprep.operators import dataset as D


def rows(spark, values):
    return spark.createDataFrame(values, "doc_id int, input_text string, output_text string, split string")


def test_duplicates_and_leakage(spark):
    df = rows(spark, [(1, "Ask", "a", "train"), (2, " ask\n", "b", "test"), (3, "x", "c", "val"), (4, "x", "d", "val"), (5, "once", "e", "train"), (6, None, "f", "train")])
    found = {(r["count"], r.train, r.val, r.test, r.leaked) for r in D.duplicate_inputs(df).collect()}
    assert found == {(2, 1, 0, 1, 1), (2, 0, 2, 0, 0)}


def test_coverage_counts_overlaps_once(spark):
    docs = spark.createDataFrame([(1, "ab cd\nef gh"), (2, ""), (3, None), (4, "xyz")], "doc_id int, text string")
    used = rows(spark, [(1, "", "ab c d", "train"), (1, "", "cdef", "val"), (1, "", "missing", "val"), (4, "", " ", "train")])
    found = {r.doc_id: (r.source_characters, r.covered_characters, r.coverage) for r in D.coverage(docs, used).collect()}
    assert found == {1: (8, 6, 0.75), 2: (0, 0, 0.0), 3: (0, 0, 0.0), 4: (3, 0, 0.0)}


def test_diversity(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2"), ("b", "3")], "template string, input_text string")
    row = D.diversity(df).first()
    assert (row.examples, row.kinds, row.entropy, row.evenness, row.distinct_inputs) == (4, 2, 1.0, 1.0, 3)
    one = D.diversity(df.filter("template = 'a'")).first()
    assert (one.kinds, one.entropy, one.evenness) == (1, 0.0, 1.0)
    assert D.diversity(df.limit(0)).first().examples == 0


def test_relevance(spark):
    df = rows(spark, [(1, "what is a river", "A river is water", "train"), (2, "", "", "train"), (3, None, "x", "train")])
    found = {r.doc_id: r.relevance for r in D.relevance(df).collect()}
    assert found[1] == 3 / 5 and found[2] == 0


def test_version_diff(spark):
    old = rows(spark, [(1, "a", "b", ""), (2, "a", "b", ""), (3, "gone", None, "")])
    new = rows(spark, [(9, "a", "b", ""), (8, "new", "x", ""), (7, "gone", "", "")])
    found = sorted((r.change, r.old_count, r.new_count) for r in D.version_diff(old, new).collect())
    assert found == [("added", 0, 1), ("added", 0, 1), ("kept", 2, 1), ("removed", 1, 0)]
    assert D.version_diff(old, old).filter(F.col("change") != "kept").count() == 0
