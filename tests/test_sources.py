import hashlib
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sparkprep.operators import scoring
from sparkprep.operators.structure import document_structure, pages_of
from sparkprep.sources import files, jsonl, logs, publish, sinks


def test_jsonl_reading(spark, tmp_path):
    lines = [
        '{"input_text": "a", "output_text": "b"}',
        '{"input_text": 5, "output_text": "c"}',
        "{bad",
        '{"input_text": "only"}',
        '[{"input_text": "x", "output_text": "y"}]',
        "",
    ]
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    good, bad = jsonl.read_examples(spark, str(tmp_path))
    assert sorted(tuple(r) for r in good.collect()) == [("5", "c"), ("a", "b")]
    assert bad.count() == 3
    with pytest.raises(AnalysisException):
        jsonl.read_examples(spark, str(tmp_path / "absent"))


def test_splits_round_trip_and_manifest(spark, tmp_path):
    rows = spark.createDataFrame([("é\n1", "o", "train"), ("2", "o", "train"), ("3", "o", "test")], "input_text string, output_text string, split string")
    sinks.write_splits(rows, str(tmp_path / "a"))
    back = jsonl.read_splits(spark, str(tmp_path / "a")).select(rows.columns)
    assert back.exceptAll(rows).count() == rows.exceptAll(back).count() == 0
    listed = {}
    for r in sinks.manifest(spark, str(tmp_path / "a")).collect():
        listed.setdefault(r.split, []).append(r.uri)
    assert set(listed) == {"train", "test"} and all(u.startswith("file:") for us in listed.values() for u in us)
    sinks.write_splits(rows, str(tmp_path / "b"), "unknown")
    assert list((tmp_path / "b").glob("split=train/*.json"))
    sinks.write_splits(rows, str(tmp_path / "c"), "parquet")
    assert spark.read.parquet(str(tmp_path / "c")).count() == 3


def test_evaluation_rows(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"input": "i", "output": "o"}\n{"input_text": "j", "output_text": "p"}\n{"input": "x"}\n')
    rows = jsonl.read_evaluation(spark, str(tmp_path)).select("input", "output").collect()
    assert sorted(map(tuple, rows)) == [("i", "o"), ("j", "p")]


def test_question_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('["one?",\n "two?"]')
    (tmp_path / "b.json").write_text('{"questions": ["three?"]}')
    assert {r.question for r in jsonl.read_questions(spark, str(tmp_path)).collect()} == {"one?", "two?", "three?"}


def test_chunk_files_are_numbered(spark, tmp_path):
    for folder in ("report_chunks", "chunks/other"):
        (tmp_path / folder).mkdir(parents=True)
        for n in (1, 2, 10):
            (tmp_path / folder / f"chunk_{n}.txt").write_text(f" text\n {n}\n")
    (tmp_path / "report_chunks" / "chunk_3.txt").write_text("  \n")
    rows = files.load_chunk_files(spark, str(tmp_path)).orderBy("doc_id", "chunk_index").collect()
    assert [tuple(r) for r in rows][3:] == [("report", n, f"text\n {n}") for n in (1, 2, 10)]


def test_scan_inventory_and_metadata(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.pdf", "b.pdf", "c.txt", "sub/d.pdf"):
        (tmp_path / name).write_bytes(b"%PDF-1.4 x")
    assert files.scan_files(spark, str(tmp_path)).count() == 2
    everything = files.scan_files(spark, str(tmp_path), "*", recursive=True)
    totals = {r.directory.rsplit("/", 1)[1]: (r.files, r.bytes) for r in files.file_inventory(everything).collect()}
    assert totals["sub"] == (1, 10) and (3, 30) in totals.values()
    pages = everything.select("path", F.lit(1).alias("page_count")).filter("path LIKE '%a.pdf'")
    found = {r.FileName: (r.FileSize, r.PageCount) for r in files.file_metadata(everything, pages).collect()}
    assert found["a.pdf"] == (10, 1) and found["b.pdf"] == (10, 0)
    assert files.path_exists(spark, str(tmp_path)) and not files.path_exists(spark, str(tmp_path / "no"))


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"x")
    plan = files.file_inventory(files.scan_files(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("d1", ["one", "two"]), ("d2", ["x"])], "doc_id string, chunks array<string>")
    sinks.write_rendered(docs, str(tmp_path / "r"))
    text = spark.read.parquet(str(tmp_path / "r")).filter("doc_id = 'd1'").first().rendered
    assert text.startswith("--- Chunk 1 ---\none\n\n--- Chunk 2 ---\ntwo")
    chunks = docs.select("doc_id", F.posexplode("chunks").alias("chunk_index", "chunk"))
    sinks.write_chunks(chunks, str(tmp_path / "c"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "c")).orderBy("doc_id", "chunk_index").collect()] == [("d1", 0, "one"), ("d1", 1, "two"), ("d2", 0, "x")]
    paged = docs.select("doc_id", pages_of(F.lit("Title\nbody.")).alias("pages"))
    sinks.write_structure(document_structure(paged), str(tmp_path / "s"))
    body = json.loads(spark.read.parquet(str(tmp_path / "s")).filter("doc_id = 'd1'").first().structure)
    assert set(body) == {"metadata", "toc", "sections"} and body["sections"][0]["end_page"] is None
    metrics = spark.createDataFrame([("bleu", 0.5)], "metric string, value double")
    sinks.write_evaluation(metrics, docs, str(tmp_path / "e"))
    assert spark.read.json(str(tmp_path / "e" / "metrics")).first().value == 0.5


def test_files_keep_names_folders_and_bytes(spark, tmp_path):
    contents = {"a/one.bin": bytes(range(256)), "a/b/two.txt": "é\n".encode(), "three.bin": b"3"}
    rows = spark.createDataFrame([*contents.items(), ("null.bin", None), (None, b"x")], "path string, content binary")
    assert sinks.write_files(rows, f"file:{tmp_path}/in") == 4
    contents["null.bin"] = b""
    assert publish.publish_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), "*.bin", recursive=True) == 3
    assert publish.publish_files(spark, f"file://{tmp_path}/in/a", str(tmp_path / "flat")) == 1
    shown = lambda f: f.is_file() and "/_" not in str(f) and "/." not in str(f)
    read = lambda folder: {str(f.relative_to(tmp_path / folder)): f.read_bytes() for f in (tmp_path / folder).rglob("*") if shown(f)}
    assert read("in") == contents and read("out") == {k: v for k, v in contents.items() if k.endswith("bin")}
    assert read("flat") == {"one.bin": contents["a/one.bin"]}


def test_a_run_is_shown_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    contents = {f"d{i % 3}/{'e/' * (i % 2)}f{i}.txt": b"x" * i for i in range(12)}
    sinks.write_files(spark.createDataFrame([*contents.items()], "path string, content binary"), str(tmp_path / "in"))
    for spoil in (lambda size, md5: (size, "0" * 32), lambda size, md5: (size + 1, md5)):

        def wrong(root, relative, copy=None, right=publish._digest, spoil=spoil):
            found = right(root, relative, copy)
            return spoil(*found) if copy is None and relative.endswith("f7.txt") else found

        with monkeypatch.context() as patch:
            patch.setattr(publish, "_digest", wrong)
            with pytest.raises(publish.PublishError, match="f7.txt"):
                publish.publish_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), recursive=True)
        assert not [f for f in (tmp_path / "out").rglob("*") if f.is_file()]
    assert publish.publish_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), recursive=True) == 12
    rows = publish.published(spark, str(tmp_path / "out")).collect()
    assert {(r.path, r.length, r.md5) for r in rows} == {(p, len(c), hashlib.md5(c).hexdigest()) for p, c in contents.items()}
    assert {f.name for f in (tmp_path / "out").iterdir()} == {"d0", "d1", "d2", "_manifests"}
    found = files.scan_files(spark, str(tmp_path / "out"), "*.txt", recursive=True, empty=True)
    assert {r.path.split("/out/")[1]: bytes(r.content) for r in found.collect()} == contents
    listed = files.list_files(spark, str(tmp_path / "out"), "f1*")
    assert listed.count() == 0 and files.list_files(spark, str(tmp_path / "out" / "d1"), "f1*").count() == 1
    assert files.list_files(spark, f"file://{tmp_path}/out", "f1*", recursive=True).count() == 3


@pytest.mark.parametrize("name", ["published_files", "publish_manifest"])
def test_empty_and_null_documents_are_published(spark, tmp_path, name):
    from check_oracle import compare, connect

    rows = [(1, "", "s"), (2, None, "s"), (3, "text é", None), (4, "x", "t"), (5, "", "t")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(str(tmp_path / "documents"))
    file = next((tmp_path / "documents").glob("part-*"))
    file.rename(tmp_path / "documents.parquet")
    assert compare(spark, connect(str(tmp_path)), str(tmp_path), name) == ""


def test_parser_failures_are_set_aside(spark):
    def load():
        def parse(content):
            return content.decode("ascii").split("\f")

        return parse

    df = spark.createDataFrame([("a", b"p1\fp2"), ("b", b"\xff"), ("c", b"")], "path string, content binary")
    good, bad = scoring.quarantine(scoring.extract_pages(df, load))
    assert {r.path: [p.text for p in r.pages] for r in good.collect()} == {"a": ["p1", "p2"], "c": [""]}
    assert [(r.path, r.error.split(":")[0]) for r in bad.collect()] == [("b", "UnicodeDecodeError")]


def test_model_is_loaded_once_per_task(spark):
    def load():
        calls = []

        def model(prompts, given):
            calls.append(1)
            return [f"{p}|{given['temperature']}|{len(calls)}" for p in prompts]

        return model

    df = spark.range(0, 100, 1, 1).select(F.col("id").cast("string").alias("prompt"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "30")
    try:
        rows = scoring.score_batch(df, load, {"temperature": 0.5}).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert rows[0].prediction == "0|0.5|1" and rows[99].prediction == "99|0.5|4"


def test_tokens_are_cut_and_padded(spark):
    df = spark.createDataFrame([("a bb ccc dddd",), ("x",)], "text string")
    rows = scoring.tokenize(df, lambda: lambda texts: [[len(w) for w in t.split()] for t in texts], 3).collect()
    assert rows[0].input_ids == [1, 2, 3] == rows[0].labels and rows[0].attention_mask == [1, 1, 1]
    assert rows[1].input_ids == [1, 0, 0] and rows[1].attention_mask == [1, 0, 0]
    plain = scoring.token_budget(df, 2).collect()
    assert plain[1].input_ids == ["x", "<pad>"] and plain[0].labels == ["a", "bb"]


def test_log_table_prunes_days(spark, tmp_path):
    log = spark.range(100).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts"),
    )
    path, schema = str(tmp_path / "log"), "event_id bigint, ts timestamp"
    logs.append_log(log.filter("event_id < 50"), path)
    logs.append_log(log.filter("event_id >= 50"), path)
    found = logs.read_log(spark, path, schema, "2024-01-02 01:00:00", "2024-01-03 05:00:00")
    assert sorted(r.event_id for r in found.collect()) == list(range(25, 54))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(ts)" in plan
    arriving = logs.stream_log(spark, path, schema)
    assert arriving.isStreaming and arriving.columns == ["event_id", "ts"]


def test_compaction_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "log"), "event_id bigint, ts timestamp, endpoint_id string"
    log = spark.range(900).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int") * 4)).alias("ts"),
        F.concat(F.lit("e"), F.col("id") % 7).alias("endpoint_id"),
    )
    assert logs.read_log(spark, path, schema).count() == 0 and logs.compact_log(spark, path) == []
    for part in range(3):
        logs.append_log(log.filter(F.col("event_id") % 3 == part).repartition(5), path)
    want = sorted(map(tuple, log.collect()))
    read = lambda: sorted(map(tuple, logs.read_log(spark, path, schema).collect()))
    before = logs.read_log(spark, path, schema)
    with monkeypatch.context() as patch:
        patch.setattr(logs, "_change", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            logs.compact_log(spark, path)
    assert read() == want
    old = logs.compact_log(spark, path)
    assert len(old) == 3 and read() == want and sorted(map(tuple, before.collect())) == want
    logs.append_log(log.limit(1), path)
    logs.drop_folders(spark, path, [*old, *logs._live(spark, path)[1]])
    assert len(read()) == 901
    files_of = [r.path for r in files.list_files(spark, path, "*.parquet", recursive=True).collect() if "/compact-" in r.path]
    live = logs._live(spark, path)[1][0]
    assert 3 <= len([f for f in files_of if live in f]) < 30
    for file in files_of:
        rows = spark.read.parquet(file).select("endpoint_id", "ts").collect()
        assert rows == sorted(rows)
    with pytest.raises(RuntimeError):
        logs._change(spark, path, logs._live(spark, path)[0], [])
    query = logs.stream_log(spark, path, schema).writeStream.format("memory").queryName("appended").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("appended").count() == 1


def test_files_are_read_by_as_many_tasks_whatever_their_number(spark, tmp_path):
    contents = {f"s{i % 3}/f{i}.pdf": b"x" * (i % 5) for i in range(400)} | {f"s0/large{i}.pdf": bytes([i]) * 3_000_000 for i in range(5)}
    sinks.write_files(spark.createDataFrame([*contents.items()], "path string, content binary"), str(tmp_path / "in"))
    found = files.scan_files(spark, str(tmp_path / "in"), "*.pdf", recursive=True, empty=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and found.rdd.getNumPartitions() == 4
    assert {r.path.split("/in/")[1]: (r.length, bytes(r.content)) for r in found.collect()} == {p: (len(c), c) for p, c in contents.items()}
    assert "read(" not in found.select("path", "length")._jdf.queryExecution().executedPlan().toString()
    assert "read(" in plan


def test_scans_with_empty_files_see_what_other_scans_see(spark, tmp_path):
    names = ["a.pdf", "b c%20#.pdf", "_k=v.pdf", "k=1/d.pdf", "_h.pdf", ".h.pdf", "_h/e.pdf", "x.pdf._COPYING_", "n.txt", "é/[f].pdf"]
    sinks.write_files(spark.createDataFrame([(n, n.encode()) for n in names], "path string, content binary"), str(tmp_path / "in"))
    columns = ["path", "modificationTime", "length", "content"]
    for root in (f"{tmp_path}/in", f"file:{tmp_path}/in/", f"file://{tmp_path}/in"):
        for pattern in ("*", "*.pdf", "{a,n}.{pdf,t{x,y}t}", "[^a]*.pdf", "?.pdf"):
            plain, whole = (files.scan_files(spark, root, pattern, recursive=True, empty=empty) for empty in (False, True))
            assert plain.columns == whole.columns == columns and plain.dtypes == whole.dtypes
            assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, whole.collect()))
