"""Exact deduplication by polynomial fingerprints that combine over chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sparkprep.llm.batches import LOWER, slices, utf8
from sparkprep.llm.session import bound_batches
from sparkprep.llm.spread import attach, hot_classes
from sparkprep.plans.staging import stage

# Two polynomials modulo 2^31 - 1; a sum of 2^22 products of a byte and a residue fits 64 bits.
PRIME = 2**31 - 1
BASES = (1_318_699_031, 794_113_517)
CHUNK = 1 << 16
Fingerprint = tuple[int, int, int]


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    powers = np.ones((2, CHUNK), np.uint64)
    for i in range(1, CHUNK):
        powers[:, i] = [int(powers[k, i - 1]) * BASES[k] % PRIME for k in range(2)]
    return powers[:, ::-1].copy()


def chunk_fingerprint(chunk: np.ndarray) -> Fingerprint:
    """Length and two residues of at most ``CHUNK`` bytes."""
    n = len(chunk)
    values, powers = chunk.astype(np.uint64), _powers()
    return n, *(int(values @ powers[k, CHUNK - n :]) % PRIME for k in range(2))


def combine(left: Fingerprint, right: Fingerprint) -> Fingerprint:
    """The fingerprint of two texts one after the other: the left one shifted by the right one's length."""
    n = right[0]
    return left[0] + n, *((left[k + 1] * pow(BASES[k], n, PRIME) + right[k + 1]) % PRIME for k in range(2))


def fingerprint(data: np.ndarray) -> Fingerprint:
    total: Fingerprint = (0, 0, 0)
    for i in range(0, len(data), CHUNK):
        total = combine(total, chunk_fingerprint(data[i : i + CHUNK]))
    return total


def fingerprint_chunks(chunks: DataFrame, *, id: str, index: str, data: str) -> DataFrame:
    """``<id>, n_bytes, f1, f2`` of documents that come as rows of bytes, for texts too large for a row.

    The chunks of a document may lie in any partitions: each is hashed where it is, a window
    over lengths tells how far to shift it, and the shifted residues are added up. A null
    chunk is empty. The result equals ``fingerprint`` of the whole document.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, data):
            raw, at = utf8(batch.column(2))
            rows = np.array([fingerprint(raw[a:b]) for a, b in zip(at, at[1:])], np.int64).reshape(-1, 3)
            arrays = [batch.column(0), batch.column(1), *map(pa.array, rows.T)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "index", "n", "f1", "f2"])

    columns = chunks.select(F.col(id).alias("id"), F.col(index).alias("index"), F.col(data).alias("data"))
    kinds = [columns.schema[c].dataType.simpleString() for c in ("id", "index")]
    rows = columns.mapInArrow(hashed, f"id {kinds[0]}, index {kinds[1]}, n long, f1 long, f2 long")

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, after, *f = (batch.column(c).to_numpy() for c in ("n", "after", "f1", "f2"))
            f = [[int(v) * pow(b, int(s), PRIME) % PRIME for v, s in zip(x, after)] for x, b in zip(f, BASES)]
            arrays = [batch.column("id"), pa.array(n), *(pa.array(x, pa.int64()) for x in f)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n", "f1", "f2"])

    later = Window.partitionBy("id").orderBy(F.desc("index")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("after", F.coalesce(F.sum("n").over(later), F.lit(0)))
    sums = rows.mapInArrow(shifted, f"id {kinds[0]}, n long, f1 long, f2 long").groupBy("id")
    return sums.agg(F.sum("n").alias("n_bytes"), *((F.sum(c) % PRIME).alias(c) for c in ("f1", "f2"))).withColumnRenamed("id", id)


KEYS = ["n_bytes", "print"]


def _fingerprints(documents: DataFrame, with_text: bool) -> DataFrame:
    """``doc_id, n_bytes, print`` and the digest, or the normalised text, of each row of ``doc_id, text``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, at = utf8(batch.column(1))
            raw = LOWER[raw]
            texts = [raw[a:b] for a, b in zip(at, at[1:])]
            prints = [fingerprint(x) for x in texts]
            last = [x.tobytes() for x in texts] if with_text else [hashlib.sha256(x).hexdigest() for x in texts]
            arrays = [
                batch.column(0),
                pa.array(np.diff(at)),
                pa.array([(f1 << 31) | f2 for _, f1, f2 in prints], pa.int64()),
                pa.array(last, pa.binary() if with_text else pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *KEYS, "last"])

    last = ("text", "binary") if with_text else ("text_sha256", "string")
    rows = documents.mapInArrow(hashed, f"doc_id {_id_type(documents)}, n_bytes long, print long, last {last[1]}")
    return rows.withColumnRenamed("last", last[0])


def _id_type(documents: DataFrame) -> str:
    return documents.schema["doc_id"].dataType.simpleString()


def _same(a: memoryview, b: memoryview) -> bool:
    return len(a) == len(b) and all(a[i : i + CHUNK] == b[i : i + CHUNK] for i in range(0, len(a), CHUNK))


def _differing(rows: DataFrame, kind: str) -> DataFrame:
    """Of rows sorted by class with its representative first, those whose text is not the representative's."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leader = None, b""
        for batch in batches:
            found_ids, found = [], []
            keys = zip(*(batch.column(c).to_pylist() for c in (*KEYS, "shard")))
            for i, own in enumerate(keys):
                text = memoryview(batch.column("text")[i].as_buffer()).cast("B")
                if own != key:
                    key, leader = own, memoryview(bytes(text))
                elif not _same(leader, text):
                    found_ids.append(batch.column("doc_id")[i].as_py())
                    found.append(hashlib.sha256(text).hexdigest())
            ids = pa.array(found_ids, batch.schema.field("doc_id").type)
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.string())], ["doc_id", "variant"])

    return rows.mapInArrow(compared, f"doc_id {kind}, variant string")


def exact_groups(documents: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of equal texts: ``doc_id, keep_id, group_size, kept, text_sha256``, a row for each document.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty, so
    null and empty texts form one group. The largest id of a group stays. A null id is smaller
    than any other. Rows that repeat an id and its text are the same document delivered again:
    they count in ``group_size`` and get the same verdict. An empty table gives an empty
    result. Other columns are ignored.

    A first pass computes length and fingerprint per document, chunk by chunk, and finds the
    classes. A second one brings documents of classes with several members next to a copy of
    the class's representative, and compares them in a stream, chunk by chunk, so a task holds
    one representative at a time. Texts that differ despite equal fingerprints become classes
    of their own. Classes with more than a thousandth of all rows are spread over many tasks.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    documents = documents.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    prints = stage(_fingerprints(documents, False), "fingerprints")
    total = prints.count()
    own = [F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")]
    several = stage(prints.groupBy(*KEYS).agg(*own).filter("group_size > 1"), "print-classes")
    hot = F.broadcast(hot_classes(several, total).select(*KEYS, "shards"))

    # The representative goes to every part of its class, any other member to one. The hint
    # keeps the join the same at every size: the classes grow with the documents.
    parts = F.coalesce("shards", F.lit(1))
    every = F.sequence(F.lit(0), parts - 1)
    targets = several.join(hot, KEYS, "left").withColumn("shard", F.explode(every)).select(*KEYS, "shard", "keep_id")
    leads = several.select(*KEYS, F.col("keep_id").alias("lead_id")).join(hot.select(*KEYS), KEYS, "left_semi")
    texts = _fingerprints(documents, True).join(hot, KEYS, "left").join(F.broadcast(leads), KEYS, "left")
    one = F.array(F.pmod(F.xxhash64("doc_id"), parts).cast("int"))
    leading = F.col("doc_id").eqNullSafe(F.col("lead_id"))
    members = texts.withColumn("shard", F.explode(F.when(leading, every).otherwise(one))).select("doc_id", *KEYS, "shard", "text")
    members = members.join(targets.hint("merge"), [*KEYS, "shard"])
    members = members.withColumn("follows", ~F.col("doc_id").eqNullSafe(F.col("keep_id"))).drop("keep_id")
    near = members.repartition(*KEYS, "shard").sortWithinPartitions(*KEYS, "shard", "follows")
    variants = stage(_differing(near, _id_type(documents)).distinct(), "print-collisions")

    keys = [*KEYS, "variant"]
    variants = variants.select("doc_id", F.col("variant").alias("text_sha256"), "variant")
    prints = prints.join(variants, ["doc_id", "text_sha256"], "left").fillna({"variant": ""})
    classes = prints.groupBy(*keys).agg(*own)
    rows = attach(prints, classes, keys, hot_classes(classes, total))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return rows.select(F.col("doc_id").alias(id), "keep_id", "group_size", kept.alias("kept"), "text_sha256")
