"""Groups of linked items: sorted streams of blocks, links within a block, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkprep.plans.staging import stage, unstage


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows that are sorted by ``keys``, one at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
            if held:
                change[0] |= held[-1].column(key)[-1].as_py() != batch.column(key)[0].as_py()
        begins = np.flatnonzero(change).tolist()
        for begin, end in zip([0, *begins], [*begins, batch.num_rows]):
            if held and change[begin]:
                yield pa.Table.from_batches(held)
                held = []
            if end > begin:
                held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def forest(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Few edges that connect what the links of a block connect: each id with the least it reaches.

    ``linked[i, j]`` says whether ``rows[i]`` and ``columns[j]`` are linked. As many edges come
    out as the block has ids, however many links there are.
    """
    none = np.iinfo(np.int64).max
    by_row, by_column = rows.copy(), columns.copy()
    while True:
        new_row = np.minimum(by_row, np.where(linked, by_column[None, :], none).min(axis=1, initial=none))
        new_column = np.minimum(by_column, np.where(linked, new_row[:, None], none).min(axis=0, initial=none))
        if (new_row == by_row).all() and (new_column == by_column).all():
            break
        by_row, by_column = new_row, new_column
    ids, least = np.concatenate([rows, columns]), np.concatenate([by_row, by_column])
    return ids[ids != least], least[ids != least]


def thinned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer edges that connect what these edges connect: each id with the least it reaches."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a) :]
    least = np.arange(len(ids))
    while (least[u] != least[v]).any():
        low = np.minimum(least[u], least[v])
        np.minimum.at(least, np.concatenate([least[u], least[v]]), np.concatenate([low, low]))
        while (least[least] != least).any():
            least = least[least]
    more = least != np.arange(len(ids))
    return ids[more], ids[least[more]]


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for each id in ``edges`` (columns ``a, b``): the least id that links reach.

    Alternates two steps until nothing changes: each id connects its larger neighbours to the
    least id around it, then its smaller ones. Both keep connections, and the number of rounds
    grows with the logarithm of a component's size. Rounds are written to the shared folder.
    Minima add up in the tasks before they shuffle, and are written before they are joined
    back: so Spark can split the rows of an id with very many neighbours.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    pairs = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = stage(pairs, "links")
    before = mark(pairs)
    while before[0]:
        around = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = around.join(least.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "links")
        unstage(least)
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least.hint("merge"), "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        small = stage(small.select("e.*").filter("u != v").distinct(), "links")
        for used in (least, large, pairs):
            unstage(used)
        pairs, after = small, mark(small)
        if after == before:
            break
        before = after
    members = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
