import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).parent)]

import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402
from check_oracle import connect, normal  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage, then after each."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = [(900_001, None, None, "s", 0), (900_002, "12 34 !!", "en", "s", 8), (None, "The cat and the hat that then ran there.", "en", "s", 40)]
    found = [docs.unionByName(spark.createDataFrame(extra, docs.schema))]
    for name, step in corpus_pipeline.STAGES:
        result = step(spark, found[-1], "/root/testdata/sf0.001")
        found.append(spark.createDataFrame(result.collect(), result.schema))
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_language_id_rejects_only_texts_without_a_language(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert set(before) - set(after) == {900_001, 900_002} and all(before[d] == t for d, t in after.items())


def test_of_equal_texts_the_largest_id_stays(stages):
    keep = {}
    for d, t in texts(stages[1]).items():
        key = t.encode().lower()
        keep[key] = max(keep.get(key, -1), -1 if d is None else d)
    assert {-1 if d is None else d for d in texts(stages[2])} == set(keep.values())


def test_one_of_each_group_of_near_copies_stays(stages):
    from test_jaccard import reference

    before = {d: t for d, t in texts(stages[2]).items() if d is not None}
    want = {d for d, (_, component) in reference(before).items() if d == component} | {None}
    assert set(texts(stages[3])) == want


def test_repeats_go(stages):
    from test_substrings import reference

    before, after = texts(stages[3]), {r.doc_id: r for r in stages[4].collect()}
    for d, (_, _, kept) in zip(before, reference(before.values())):
        assert after[d].text.encode().split() == kept.encode().split() and after[d].n_chars == len(after[d].text)
        if len(kept.encode().split()) == len(before[d].encode().split()):
            assert after[d].text == before[d]


def test_packing_holds_every_id(stages):
    import public_tokenizers
    from test_packing import check
    from tokenizers import Tokenizer

    check(stages[5].collect(), texts(stages[4]), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 4096)


def small(spark, rows):
    """Documents with extra columns of names that the stages or operators use themselves."""
    extra = ["score", "lang_pred", "known_id", "text_sha256", "kept_id", "n_words", "n_removed", "kept_sha256", "kept_text", "id", "keep0", "ranges", "digest"]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra)
    return spark.createDataFrame([(*r, *[f"{c} of {r[0]}" for c in extra]) for r in rows], kinds), extra


@pytest.mark.parametrize("marked", [True, False])
def test_odd_documents_pass_all_stages(spark, marked):
    prose = " ".join(f"the cat{i} sat" for i in range(60))
    rows = [(1, prose, "en"), (2, prose + " more", "en"), (3, "Hello", None), (4, None, "en"), (5, "", None), (6, "12", "en"), (None, "hello", "en"), (7, "x" * 90_000, None), (3, "Hello", None)]
    docs, extra = small(spark, [(d, t, lang if marked else None, "s", len(t or "")) for d, t, lang in rows])
    docs = docs.repartition(2)
    for name, step in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        result = step(spark, docs, "")
        docs = spark.createDataFrame(result.collect(), result.schema)
        assert docs.columns == columns
        assert all(r[c] == f"{c} of {r.doc_id}" for r in docs.collect() for c in extra)
    assert {r.doc_id for r in docs.collect()} == {1, 3, 7}
    assert {r.doc_id for r in corpus_pipeline.pack(spark, docs, "").collect()} == {1, 3, 7}


def test_empty_documents_pass_all_stages(spark):
    docs, _ = small(spark, [])
    for name, step in corpus_pipeline.STAGES:
        result = step(spark, docs, "")
        assert result.count() == 0 and (name == "packing" or result.columns == docs.columns)


def test_run_returns_the_last_stage(spark, data, stages):
    rows = corpus_pipeline.run(spark, data)
    assert rows.columns == stages[5].columns and rows.count() > 0


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op10_url_filters", "op12_quality_rules", "op13_conversation_repair"])
def test_query_equals_sql(spark, data, name):
    df = __spark_entry__.queries()[name](spark, data)
    result = connect(data).execute(__spark_entry__.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(result.fetchall(), columns)


def test_all_operators_are_registered():
    found = {n.split("_")[0] for n in __spark_entry__.queries() if n.startswith("op")}
    assert found == {f"op{i}" for i in range(1, 14)} and "pipeline" in __spark_entry__.queries()
