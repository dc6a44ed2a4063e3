from sparkprep.plans import staging
from sparkprep.plans.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_staging_uses_the_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda _: str(tmp_path))
    staged = staging.stage(spark.range(5), "numbers")
    assert staged.count() == 5 and list(tmp_path.glob("numbers-*"))
    staging.unstage(staged)
    assert not list(tmp_path.glob("numbers-*"))


def test_filters_and_columns_reach_the_scan(spark, data):
    found = plan(QUERIES["time_range"](spark, data))
    assert "GreaterThanOrEqual(ts" in found and "LessThan" in found
    assert "props" not in found.split("ReadSchema")[1]


def test_chunking_and_examples_do_not_shuffle(spark, data):
    for name in ("chunk_documents", "make_examples", "sections", "section_chunks", "render_chunks"):
        assert "Exchange" not in plan(QUERIES[name](spark, data)), name
