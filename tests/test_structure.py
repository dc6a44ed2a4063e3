import json

from pyspark.sql import functions as F

from sparkprep.operators import structure as S

LINES = ["intro text.", "Chapter One", "It begins here.", "", "more.", "2. Second part", "it ends."]


def paged(spark, lines=LINES):
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "only prose here.")], "doc_id int, text string")
    return df.withColumn("pages", S.pages_of(F.col("text"))).drop("text")


def test_pages(spark):
    text = paged(spark).orderBy("doc_id").select(S.assemble_pages(F.col("pages"))).first()[0]
    assert text == "\n\n".join(line for line in LINES if line)


def test_sections_and_toc(spark):
    rows = paged(spark).orderBy("doc_id").select(S.toc(F.col("pages")), S.sections(F.col("pages"))).collect()
    assert rows[0][0] == ["Chapter One", "2. Second part"]
    assert [tuple(s) for s in rows[0][1]] == [("Chapter One", 2, 5), ("2. Second part", 6, None)]
    assert rows[1][0] == [] and rows[1][1] == []


def test_section_chunks(spark):
    rows = S.section_chunks(paged(spark)).orderBy("doc_id", "page_no").collect()
    assert [r.section_no for r in rows] == [0, 1, 1, 1, 1, 2, 2, 0]
    assert [r.title for r in rows][:2] == [None, "Chapter One"]
    assert [r.text for r in rows][:7] == LINES


def test_section_chunks_heading_first(spark):
    rows = S.section_chunks(paged(spark, ["Title here", "body."])).filter("doc_id = 1").collect()
    assert [(r.section_no, r.page_no) for r in rows] == [(1, 1), (1, 2)]


def test_metadata(spark):
    df = paged(spark).withColumn("title", F.lit(None).cast("string")).withColumn("creation_date", F.lit("2024-01-01").cast("date"))
    row = S.normalize_metadata(df).orderBy("doc_id").first()
    assert row.title == "" and row.creation_date == "2024-01-01" and row.author == "" and row.pages == 7


def test_document_structure(spark):
    row = S.document_structure(paged(spark)).orderBy("doc_id").select(F.to_json(F.struct("metadata", "toc", "sections"))).first()
    body = json.loads(row[0])
    assert body["metadata"]["pages"] == 7 and len(body["toc"]) == 2 and len(body["sections"]) == 2


def test_entities(spark):
    df = spark.createDataFrame(
        [("Ada met Bob", [("PERSON", 0, 3, 0.9), ("PERSON", 8, 11, 0.5)])],
        "text string, e array<struct<type:string,start_index:int,end_index:int,confidence:double>>",
    )
    found = df.select(S.entity_spans(F.col("text"), F.col("e"))).first()[0]
    assert [tuple(f) for f in found] == [("PERSON", "Ada", 0.9), ("PERSON", "Bob", 0.5)]


def test_chunks_belong_to_the_section_they_begin_in(spark):
    from sparkprep.operators.structure import chunk_sections

    pages = [(1, "before any heading " + "x" * 60), (2, "Title One"), (3, "a" * 80), (4, ""), (5, "b" * 80), (6, "Title Two"), (7, "c" * 80)]
    df = spark.createDataFrame([(9, pages), (8, []), (7, [(1, "d" * 50)])], "doc_id int, pages array<struct<page_no:int,text:string>>")
    rows = chunk_sections(df, "^Title", chunk_size=100, overlap=0, min_length=40).collect()
    found = {(r.doc_id, r.chunk_index): (r.section_no, r.title) for r in rows}
    assert found == {
        (9, 1): (0, None),  # before the first heading, and its heading still fits
        (9, 2): (1, "Title One"),
        (9, 3): (1, "Title One"),
        (9, 4): (2, "Title Two"),
        (7, 1): (0, None),
    }
