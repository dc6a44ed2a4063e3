import math

import pytest
from pyspark.sql import functions as F

from sparkprep.functions.chunks import chunk_text
from sparkprep.operators import examples as E
from sparkprep.operators import splitting as S
from sparkprep.operators.chunking import chunk_documents
from sparkprep.plans.prepare import prepare_training_data, training_examples
from sparkprep.plans.staging import table


def hot_chunks(spark, rows=6000):
    """One document has a third of all chunks."""
    doc = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1)
    return spark.range(rows).select(
        doc.alias("doc_id"), F.col("id").alias("chunk_index"), F.concat(F.lit("text "), "id").alias("chunk")
    )


def test_sample_of_a_hot_document(spark):
    chunks = hot_chunks(spark)
    rows = E.sample_chunks(chunks, 10, 0.5).collect()
    sizes = {r.doc_id: r["count"] for r in chunks.groupBy("doc_id").count().collect()}
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(sizes)
    for doc, picked in by_doc.items():
        k = min(10, sizes[doc])
        assert len({r.chunk_index for r in picked}) == len(picked) == k
        assert sum(r.kind == E.QA for r in picked) == int(k * 0.5)
        assert all((r.sample_rank <= int(k * 0.5)) == (r.kind == E.QA) for r in picked)


def test_rank_limit_comes_before_the_shuffle(spark):
    plan = E.sample_chunks(hot_chunks(spark))._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("row_number(), 10, Final"), plan.index("row_number(), 10, Partial")
    assert final < plan.index("Exchange") < partial


def test_row_and_table_forms_agree(spark, data):
    docs = table(spark, data, "documents")
    chunks = chunk_text(F.col("text"), separator="\n")
    columns = ["doc_id", "chunk_index", "chunk", "sample_rank", "kind"]
    inside = E.sample_chunk_lists(docs, chunks, 4, 0.7, seed=3).select(columns)
    outside = E.sample_chunks(chunk_documents(docs, separator="\n"), 4, 0.7, seed=3).select(columns)
    assert inside.exceptAll(outside).count() == outside.exceptAll(inside).count() == 0
    built = E.example_lists(docs, chunks, 4, 0.7, seed=3)
    apart = E.make_examples(E.sample_chunk_lists(docs, chunks, 4, 0.7, seed=3)).select(built.columns)
    assert built.exceptAll(apart).count() == apart.exceptAll(built).count() == 0


def test_validation_bounds(spark):
    rows = [("x" * a, "y" * b) for a, b in [(10, 20), (9, 20), (1024, 2048), (1025, 20), (10, 19), (10, 2049)]]
    df = spark.createDataFrame(rows + [(None, "y" * 30)], "input_text string, output_text string")
    valid = [r[0] for r in df.select(E.is_valid()).collect()]
    assert valid == [True, False, True, False, False, False, False]


@pytest.mark.parametrize("n", [0, 1, 2, 9, 10, 1000, 12345])
def test_split_sizes_are_exact(spark, n):
    split = S.split_exact(spark.range(n), ["id"])
    counts = {r.split: r["count"] for r in S.split_counts(split).collect()}
    train, val = int(n * 0.8), int(n * 0.1)
    assert counts == {"train": train, "val": val, "test": n - train - val}


def test_split_does_not_depend_on_partitions(spark):
    rows = spark.range(3000).withColumn("text", F.lit("t"))
    first = S.split_exact(rows.repartition(1), ["id"], seed=5)
    second = S.split_exact(rows.repartition(13), ["id"], seed=5)
    assert first.exceptAll(second).count() == 0
    assert first.select("id").distinct().count() == 3000
    other = S.split_exact(rows, ["id"], seed=6)
    assert first.exceptAll(other).count() > 0


def test_copies_stay_together(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"))
    split = S.split_exact(rows, ["id"])
    assert split.count() == 3000
    assert split.groupBy("id").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0


def test_split_does_not_sort_the_rows(spark, tmp_path):
    spark.range(1000).select("id", F.lit("text").alias("text")).write.parquet(str(tmp_path / "t"))
    plan = S.split_exact(spark.read.parquet(str(tmp_path / "t")), ["id"])
    top = plan._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in top and "Sort" not in top


def test_hash_split_is_stable(spark):
    small, large = (S.split_hash(spark.range(n), ["id"]) for n in (1000, 5000))
    assert small.exceptAll(large).count() == 0
    shares = {r.split: r["count"] / 5000 for r in large.groupBy("split").count().collect()}
    assert abs(shares["train"] - 0.8) < 0.03 and abs(shares["val"] - 0.1) < 0.03


def test_holdout(spark):
    rows = spark.range(105).withColumn("split", F.when(F.col("id") < 100, "train").otherwise("test"))
    counts = {r.split: r["count"] for r in S.split_counts(S.holdout(rows, ["id"])).collect()}
    assert counts == {"train": 100 - math.ceil(10), "val": 10, "test": 5}
    kept = rows.withColumn("split", F.when(F.col("id") == 0, "val").otherwise(F.col("split")))
    assert S.holdout(kept, ["id"]).exceptAll(kept).count() == 0


def test_empty_splits_count_zero(spark):
    rows = spark.range(4).withColumn("split", F.lit("train"))
    counts = {r.split: r["count"] for r in S.split_counts(rows).collect()}
    assert counts == {"train": 4, "val": 0, "test": 0}


def test_preparation(spark, data):
    docs = table(spark, data, "documents")
    prepared = prepare_training_data(docs, separator="\n")
    examples = training_examples(docs, separator="\n")
    assert prepared.count() == examples.count()
    assert prepared.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 10
    assert prepared.filter(~E.is_valid()).count() == 0
    again = prepare_training_data(docs.repartition(9), separator="\n")
    assert prepared.exceptAll(again).count() == 0


def test_review_sample(spark):
    rows = spark.range(500)
    picked = E.review_sample(rows, ["id"], 50)
    assert picked.count() == 50 and picked.exceptAll(E.review_sample(rows.repartition(5), ["id"], 50)).count() == 0
