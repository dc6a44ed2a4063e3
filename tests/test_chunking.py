import random
import time

import pytest
from pyspark.sql import functions as F

from sparkprep.functions.chunks import chunk_text, paragraphs
from sparkprep.operators.chunking import chunk_documents, clean_chunks, render_chunks


A, B, C, D = "a" * 60, "b" * 60, "c" * 60, "d" * 10


@pytest.mark.parametrize(
    "text, size, overlap, least, chunks",
    [
        ("", 100, 10, 1, []),
        ("short", 100, 10, 30, []),  # too small to keep
        ("\n\n \n\n", 100, 10, 1, []),
        (A, 100, 10, 30, [A]),
        (f"{A}\n\n{B}", 100, 10, 30, [A, f"{A[-8:]}\n\n\n\n{B}"]),  # the tail counts the blank line that follows
        (f"{A}\n\n{B}", 200, 10, 30, [f"{A}\n\n{B}"]),
        (f"{A}\n\n{B}", 100, 0, 30, [A, B]),
        (f"{D}\n\n{A}\n\n{B}", 60, 0, 30, [f"{D}\n\n{A}", B]),  # not closed before it is large enough
        (f"{A}\n\n\n\n{D}", 100, 10, 30, [f"{A}\n\n{D}"]),
    ],
)
def test_cases_worked_by_hand(spark, text, size, overlap, least, chunks):
    found = spark.range(1).select(chunk_text(F.lit(text), size, overlap, least)).first()[0]
    assert found == chunks


@pytest.mark.parametrize("size,overlap,least", [(1000, 200, 100), (120, 20, 30), (50, 80, 10), (200, 0, 1)])
def test_nothing_is_lost_and_chunks_overlap(spark, size, overlap, least):
    draw = random.Random(size)
    texts = ["\n\n".join(f"p{i}." + "x" * draw.randint(0, 150) for i in range(draw.randint(1, 60))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for row in df.select("doc_id", chunk_text(F.col("text"), size, overlap, least).alias("c")).collect():
        parts = texts[row.doc_id].split("\n\n")
        together = "\n\n".join(row.c)
        places = [together.find(p.strip()) for p in parts]
        kept = [p for p in places if p >= 0]
        assert kept == sorted(kept) and places[: len(kept)] == kept  # in order, and only the end may be too small
        assert all(len(c) >= least - 2 for c in row.c)
        for a, b in zip(row.c, row.c[1:]):
            assert b.startswith(a[-(overlap - 2) :].strip() if overlap else "p")


def test_long_text_without_paragraphs(spark):
    text = "One sentence is here. Another sentence follows it. " * 20
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    whole = df.select(chunk_text(F.col("text"), 100, 20)).first()[0]
    assert whole == [text.strip()]
    cut = df.select(chunk_text(F.col("text"), 100, 20, split_long=True)).first()[0]
    assert len(cut) > 1 and max(map(len, cut)) <= 100
    assert all(a[-20:] in b for a, b in zip(cut, cut[1:]))
    with pytest.raises(ValueError):
        chunk_text(F.col("text"), 100, 100, split_long=True)


def test_a_book_takes_linear_time(spark):
    line = F.concat(F.repeat(F.lit("some words here. "), 60), F.lit("\n\n"))
    book = spark.range(1).select(F.repeat(line, 20_000).alias("text"))
    start = time.time()
    assert book.select(F.size(chunk_text(F.col("text")))).first()[0] == 20_000
    assert time.time() - start < 60


def test_chunk_table(spark):
    text = "\n\n".join(f"{i} " + "x" * 90 for i in range(40))
    df = spark.createDataFrame([(7, text), (8, "tiny")], "doc_id int, text string")
    rows = chunk_documents(df).orderBy("chunk_index").collect()
    assert [r.chunk_index for r in rows] == list(range(1, len(rows) + 1))
    assert {r.doc_id for r in rows} == {7}
    rendered = df.select("doc_id", render_chunks(chunk_text(F.col("text"))).alias("r")).collect()
    assert rendered[0].r == "".join(f"--- Chunk {r.chunk_index} ---\n{r.chunk}\n\n" for r in rows)
    assert rendered[1].r == ""


def test_blank_paragraphs_and_chunks_go(spark):
    df = spark.createDataFrame([(1, 1, "  a \n"), (1, 2, " \t"), (2, 1, "")], "doc_id int, chunk_index int, chunk string")
    assert [tuple(r) for r in clean_chunks(df).collect()] == [(1, 1, "a")]
    found = spark.range(1).select(paragraphs(F.lit("a\n\n \n\nb\n\n"))).first()[0]
    assert found == ["a", "b"]


def test_no_shuffle(spark):
    plan = chunk_documents(spark.createDataFrame([(1, "x")], "doc_id int, text string"))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
