import numpy as np
from pyspark.sql import functions as F

from sparkprep.llm import fingerprints
from sparkprep.llm.fingerprints import CHUNK, _differing, chunk_fingerprint, combine, exact_groups, fingerprint, fingerprint_chunks


def test_chunks_combine_to_the_whole():
    data = np.random.default_rng(1).integers(0, 256, 3 * CHUNK + 17).astype(np.uint8)
    direct = [len(data)] + [0, 0]
    for k, base in enumerate(fingerprints.BASES):
        value = 0
        for byte in data[:5000].tolist():
            value = (value * base + byte) % fingerprints.PRIME
        direct[k + 1] = value
    assert chunk_fingerprint(data[:5000]) == (5000, *direct[1:])
    parts = [fingerprint(data[a:b]) for a, b in ((0, 10), (10, 10), (10, 2 * CHUNK + 1), (2 * CHUNK + 1, len(data)))]
    left = combine(combine(parts[0], parts[1]), combine(parts[2], parts[3]))
    assert left == combine(parts[0], combine(parts[1], combine(parts[2], parts[3]))) == fingerprint(data)


def test_documents_in_rows_of_chunks(spark):
    data = bytes(range(256)) * 700
    rows = [(d, i, data[a:b]) for d in (1, 2) for i, (a, b) in enumerate(((0, 100), (100, 90_000), (90_000, len(data))))] + [(3, 0, None)]
    chunks = spark.createDataFrame(rows, "doc int, part int, bytes binary").repartition(4)
    found = {r.doc: (r.n_bytes, r.f1, r.f2) for r in fingerprint_chunks(chunks, id="doc", index="part", data="bytes").collect()}
    assert found[1] == found[2] == fingerprint(np.frombuffer(data, np.uint8)) and found[3] == (0, 0, 0)


def test_texts_that_differ_despite_equal_fingerprints(spark):
    rows = [(9, 3, 5, 0, b"abc", False), (8, 3, 5, 0, b"abc", True), (7, 3, 5, 0, b"abd", True), (6, 4, 5, 0, b"abdd", False)]
    schema = "doc_id long, n_bytes long, print long, shard int, text binary, follows boolean"
    df = spark.createDataFrame(rows, schema).coalesce(1).sortWithinPartitions("n_bytes", "print", "shard", "follows")
    assert [r.doc_id for r in _differing(df, "long").collect()] == [7]


def test_odd_rows(odd_documents, no_documents):
    rows = exact_groups(odd_documents).collect()
    assert len(rows) == 14 and exact_groups(no_documents).count() == 0
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by[1].keep_id, by[1].group_size, by[1].kept) == (2, 3, False) and by[2].kept
    assert (by[4].keep_id, by[4].group_size, by[4].kept) == (5, 4, False) and by[5].kept
    assert by[6].kept and by[7].kept and by[3].group_size == 1
    alone = [r for r in rows if r.doc_id is None]
    assert sorted(r.kept for r in alone) == [False, False, True]


def test_a_hot_group_is_spread(spark):
    ids = spark.range(3000).withColumn("text", F.when(F.col("id") % 3 == 0, "SAME text").otherwise(F.concat(F.lit("t"), F.col("id"))))
    rows = exact_groups(ids.withColumnRenamed("id", "doc_id"))
    assert rows.filter("group_size = 1000").agg(F.min("keep_id"), F.count("*"), F.count_if("kept")).first() == (2997, 1000, 1)
    assert rows.filter("group_size = 1 AND kept").count() == 2000


def test_data_has_copies(spark, data):
    rows = exact_groups(spark.read.parquet(f"{data}/documents.parquet"))
    assert rows.filter("NOT kept").count() > 0
