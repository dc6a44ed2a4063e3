from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sparkprep.operators.chunking import chunk_documents
from sparkprep.plans.inputs import Inputs
from sparkprep.streaming import chunks as chunk_streams, late, monitor
from test_monitoring import expected_streaks

START = datetime(2024, 1, 1)
LOG = "event_id bigint, ts timestamp, endpoint_id string, latency double, status string"


def write_in_turn(spark, folder, parts):
    """One file per part, so that a stream of one file per batch sees them in order."""
    import os

    for n, rows in enumerate(parts):
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(str(folder))
        for file in folder.glob("part-*.parquet"):
            if not file.name.startswith("part-done"):
                target = folder / f"part-done-{n}.parquet"
                os.rename(file, target)
                os.utime(target, (1_700_000_000 + n, 1_700_000_000 + n))


def stream(spark, folder):
    return (
        spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "part-done*").parquet(str(folder))
    )


def entry(n, minutes, status="success", endpoint="e"):
    return (n, START + timedelta(minutes=minutes), endpoint, float(n), status)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    # Rows are judged by the watermark that the batch before started with.
    parts = [[entry(1, 0), entry(2, 200)], [entry(3, 400)], [entry(4, 1), entry(5, 600)]]
    write_in_turn(spark, tmp_path / "in", parts)
    result = monitor.windowed_metrics(stream(spark, tmp_path / "in"), "1 hour", "10 minutes")
    progress = monitor.run_available(result, str(tmp_path / "out"), str(tmp_path / "c"))
    late = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    assert late > 0
    rows = spark.read.schema(result.schema).parquet(str(tmp_path / "out")).collect()
    assert {(r.window_start, r.prediction_count) for r in rows} >= {(START, 1)}


def test_sliding_alerts(spark, tmp_path):
    parts = [[entry(i, i, "error" if i % 10 == 0 else "success") for i in range(300)]]
    write_in_turn(spark, tmp_path / "in", parts)
    result = monitor.error_rate_alerts(stream(spark, tmp_path / "in"), "1 hour", "30 minutes", "1 minute")
    monitor.run_available(result, str(tmp_path / "out"), str(tmp_path / "c"))
    rows = spark.read.schema(result.schema).parquet(str(tmp_path / "out")).collect()
    assert len(rows) >= 8 and all(r.level == "critical" for r in rows)


def test_feedback_median_is_close(spark, data, tmp_path):
    i = Inputs(spark, data)
    whole = i.feedback().groupBy(F.window("ts", "1 day").start.alias("w")).agg(F.sort_array(F.collect_list("score")).alias("scores"))
    scores = {r.w: r.scores for r in whole.collect()}
    result = monitor.feedback_windows(i.feedback(i.stream("events")))
    found = monitor.run_windows(result, ["window_start", "window_end"], str(tmp_path / "out"), str(tmp_path / "c")).collect()
    assert {r.window_start for r in found} == set(scores)
    for r in found:
        own = scores[r.window_start]
        assert r.approx_median == (own[(len(own) - 1) // 2] if own else None)


def test_open_windows_take_their_last_state(spark, tmp_path):
    write_in_turn(spark, tmp_path / "in", [[entry(1, 0), entry(2, 30)], [entry(3, 40), entry(4, 90)]])
    result = monitor.windowed_metrics(stream(spark, tmp_path / "in"), "1 hour", "2 hours")
    keys = ["window_start", "window_end", "endpoint_id", "status"]
    found = monitor.run_windows(result, keys, str(tmp_path / "out"), str(tmp_path / "c")).collect()
    assert {(r.window_start, r.prediction_count) for r in found} == {(START, 3), (START + timedelta(hours=1), 1)}


def test_tables_may_be_files_or_folders(spark, data, tmp_path):
    from sparkprep.plans.queries import QUERIES

    for name in ("events", "documents"):
        spark.read.parquet(f"{data}/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("stream_metrics", "stream_error_alerts", "stream_feedback", "stream_chunks", "stream_failures"):
        file, folder = QUERIES[name](spark, data), QUERIES[name](spark, str(tmp_path))
        assert sorted(map(repr, file.collect())) == sorted(map(repr, folder.collect())) != [], name


def test_late_entries_join_their_runs(spark, tmp_path):
    """Batches that overlap in time give the runs of the batch operator."""
    rows = [entry(n, n, "error" if n in (2, 3, 4, 5, 30, 31) else "success") for n in range(32)]
    parts = [[rows[k] for k in (0, 2, 4, 6)], [rows[k] for k in (1, 3, 5, 7)], rows[8:]]
    write_in_turn(spark, tmp_path / "in", parts)
    paths = [str(tmp_path / n) for n in ("streaks", "state", "c")]
    monitor.track_failures(stream(spark, tmp_path / "in"), *paths).awaitTermination()
    found = {(r.first_ts, r.failures, r.level, r.open) for r in monitor.all_failures(spark, *paths[:2]).collect()}
    at = lambda n: START + timedelta(minutes=n)
    assert found == {(at(2), 4, "critical", False), (at(30), 2, "warning", True)}
    assert {p.name for p in (tmp_path / "state").glob("batch=*")} == {"batch=1", "batch=2"}


def test_failure_runs_across_batches(spark, tmp_path):
    statuses = "sffsfffffssfsffffffffffsssffffs"
    rows = [
        entry(n, n, "error" if s == "f" else "success", f"e{n % 2}") for n, s in enumerate(statuses * 4)
    ]
    parts = [rows[:20], rows[20:23], rows[23:70], rows[70:]]
    write_in_turn(spark, tmp_path / "in", parts)
    paths = [str(tmp_path / n) for n in ("streaks", "state", "c")]
    monitor.track_failures(stream(spark, tmp_path / "in"), *paths).awaitTermination()
    rows_found = monitor.all_failures(spark, *paths[:2]).collect()
    found = {(r.endpoint_id, r.first_ts, r.last_ts, r.failures, r.level) for r in rows_found}
    assert found == set(expected_streaks(spark.createDataFrame(rows, LOG).collect())) and len(found) == len(rows_found)
    last = {f"e{k}": max((r for r in rows if r[2] == f"e{k}"), key=lambda r: r[1])[4] for k in (0, 1)}
    assert {r.endpoint_id for r in rows_found if r.open} == {e for e, status in last.items() if status == "error"}


def test_arriving_files_are_chunked(spark, tmp_path):
    (tmp_path / "in").mkdir()
    text = "\n\n".join(f"paragraph {i} " + "x" * 80 for i in range(30))
    (tmp_path / "in" / "doc1.txt").write_text(text)
    arriving = chunk_streams.chunk_stream(chunk_streams.text_file_stream(spark, str(tmp_path / "in")))
    out, progress = str(tmp_path / "out"), str(tmp_path / "c")
    monitor.run_available(arriving, out, progress)
    (tmp_path / "in" / "doc2.txt").write_text(text * 2)
    monitor.run_available(arriving, out, progress)
    batch = chunk_documents(spark.createDataFrame([("doc1", text), ("doc2", text * 2)], "doc_id string, text string"))
    found = spark.read.schema(batch.schema).parquet(out)
    assert found.exceptAll(batch).count() == batch.exceptAll(found).count() == 0


def run_late(spark, tmp_path, parts, **options):
    write_in_turn(spark, tmp_path / "in", parts)
    path = str(tmp_path / "windows")
    late.track_windows(stream(spark, tmp_path / "in"), path, str(tmp_path / "c"), **options).awaitTermination()
    return path


def test_kept_and_late_rows_are_all_rows(spark, tmp_path):
    parts = [
        [entry(1, 0), entry(2, 200), (9, None, "e", 1.0, "success")],
        [entry(3, 400), entry(4, 10), entry(5, 195, "error")],
        [entry(6, 1), entry(7, 600), entry(8, 330, "error"), (10, START + timedelta(minutes=610), "e", None, "success")],
    ]
    path = run_late(spark, tmp_path, parts, seconds=3600, delay="10 minutes")
    at = lambda n: START + timedelta(minutes=n)
    found = {r.event_id: r for r in late.late_rows(spark, path).collect()}
    assert set(found) == {4, 6, 8, 9}
    assert (found[4].watermark, found[4].window_end, found[4].behind_seconds, found[4].batch) == (at(190), at(60), 180 * 60, 1)
    assert (found[8].watermark, found[8].behind_seconds, found[9].window_start, found[9].watermark) == (at(390), 3600, None, None)
    counters = sorted(tuple(r) for r in late.progress(spark, path).select("batch", "rows", "on_time", "late", "undated", "watermark", "newest").collect())
    assert counters == [(0, 3, 2, 1, 1, None, at(200)), (1, 3, 2, 1, 0, at(190), at(400)), (2, 4, 2, 2, 0, at(390), at(610))]
    totals = {(r.window_start, r.status): (r.prediction_count, r.mean, r.late) for r in late.window_totals(spark, path).collect()}
    assert totals[at(0), "success"] == (1, 1.0, 2) and totals[at(300), "error"] == (0, None, 1)
    assert totals[at(600), "success"] == (2, 7.0, 0) and totals[at(180), "error"] == (1, 5.0, 0)
    assert sum(n + m for n, _, m in totals.values()) + 1 == sum(map(len, parts))


def test_a_repeated_batch_replaces_its_late_rows(spark, tmp_path):
    parts = [[entry(1, 0), entry(2, 500)], [entry(3, 20), entry(4, 510)]]
    path = run_late(spark, tmp_path, parts, seconds=3600, delay="10 minutes")
    again = late.track_windows(stream(spark, tmp_path / "in"), path, str(tmp_path / "other"), seconds=3600, delay="10 minutes")
    again.awaitTermination()
    assert [r.event_id for r in late.late_rows(spark, path).collect()] == [3]
    assert sum(r.prediction_count for r in late.window_totals(spark, path).collect()) == 3
