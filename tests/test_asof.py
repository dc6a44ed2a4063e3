import random

import pytest
from pyspark.sql import functions as F

from sparkprep.operators import asof, structure
from sparkprep.operators.asof import asof_join

LEFT, RIGHT = "key string, place int, mark int", "key string, since int, no int, name string"


def by_pairs(left, right):
    """The rows of ``left`` with the last fitting row of ``right``, by comparing all pairs."""
    found = []
    for key, place, mark in left:
        fits = [(s, n, t) for k, s, n, t in right if None not in (key, place, k, s) and k == key and s <= place]
        best = max(fits, default=(None, None, None))
        found.append((key, place, mark, *best[1:]))
    return sorted(found, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_last_row_that_is_not_after(spark, seed):
    draw = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    left = [(draw.choice(keys), draw.choice([None, *range(30)]), i) for i in range(400)]
    right = [(draw.choice(keys), draw.choice([None, *range(30)]), i, f"s{i}") for i in range(60)]
    frames = (spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT).repartition(2))
    got = asof_join(*frames, ["key"], "place", "since", ["no", "name"])
    assert got.columns == ["key", "place", "mark", "no", "name"]
    assert sorted(map(tuple, got.collect()), key=repr) == by_pairs(left, right)


def test_empty_sides(spark):
    left, right = spark.createDataFrame([("a", 1, 1)], LEFT), spark.createDataFrame([("a", 1, 1, "x")], RIGHT)
    assert asof_join(left.limit(0), right, ["key"], "place", "since", ["no"]).count() == 0
    assert [r.no for r in asof_join(left, right.limit(0), ["key"], "place", "since", ["no"]).collect()] == [None]


def test_a_hot_document_spans_many_blocks(spark, monkeypatch):
    chunks = spark.range(9_000).select(F.when(F.col("id") < 3_000, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 500)).alias("doc_id"), (F.col("id") % 3_000).alias("chunk_index"), (F.col("id") % 1_000).alias("page_no"))
    sections = chunks.select("doc_id", (F.floor(F.col("page_no") / 90) * 90).alias("start_page")).distinct().withColumn("title", F.concat("doc_id", F.lit("/"), "start_page"))
    sections = sections.withColumn("section_no", (F.col("start_page") / 90 + 1).cast("int"))
    staged = []
    monkeypatch.setattr(asof, "stage", lambda df, label, keep=asof.stage: staged.append(keep(df, label)) or staged[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 24)
    try:
        rows = structure.assign_sections(chunks, sections).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(rows) == 9_000 and all(r.title == f"{r.doc_id}/{r.page_no // 90 * 90}" and r.section_no == r.page_no // 90 + 1 for r in rows)
    blocks = staged[0].groupBy("_block").agg(F.count("*").alias("n"), F.count_if(F.col("_on0") == "hot").alias("hot")).collect()
    assert max(r.n for r in blocks) < 9_000 / 8 and sum(r.hot > 0 for r in blocks) >= 5


def test_chunks_before_the_first_section_have_none(spark):
    chunks = spark.createDataFrame([("d", 1, 1), ("d", 2, 5), ("e", 1, 1), ("d", 3, None)], "doc_id string, chunk_index int, page_no int")
    sections = spark.createDataFrame([("d", 1, "Start", 2), ("d", 2, "More", 5)], "doc_id string, section_no int, title string, start_page int")
    got = {(r.doc_id, r.chunk_index): (r.section_no, r.title) for r in structure.assign_sections(chunks, sections).collect()}
    assert got == {("d", 1): (0, None), ("d", 2): (2, "More"), ("e", 1): (0, None), ("d", 3): (0, None)}
