"""Packing tokenized documents into training sequences of fixed length, online and in bounded space."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sparkprep.llm.batches import slices
from sparkprep.llm.session import bound_batches
from sparkprep.llm.wordtokens import shared_tokens
from sparkprep.plans.staging import stage

OPEN_WINDOWS = 64
MERGED_TASKS = 32


class Windows:
    """At most ``limit`` open windows of ``size`` tokens; an item goes where it leaves least room.

    If it fits nowhere, a new window opens, and the fullest is closed when there are too many.
    """

    def __init__(self, size: int, limit: int = OPEN_WINDOWS, first: int = 0):
        self.size, self.limit, self.next = size, limit, first
        self.open: list[tuple[int, int]] = []  # room left and number, by room

    def place(self, length: int) -> tuple[int, int, list[int]]:
        """Window and offset of the item, and the windows closed by that."""
        closed, at = [], bisect_left(self.open, (length, -1))
        if at < len(self.open):
            room, number = self.open.pop(at)
        else:
            if len(self.open) >= self.limit and length < self.size:
                closed.append(self.open.pop(0)[1])
            room, number = self.size, self.next
            self.next += 1
        if room == length:
            closed.append(number)
        else:
            insort(self.open, (room - length, number))
        return number, self.size - room, closed


PIECE = ["start", "length", "ids_crc32", "doc_tokens", "window", "offset"]


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    *,
    id: str = "doc_id",
    text: str = "text",
    size: int = 4096,
    end_id: int = 2,
    open_windows: int = OPEN_WINDOWS,
    with_ids: bool = False,
) -> DataFrame:
    """A row for each piece of a document in a sequence of at most ``size`` tokens.

    Columns: ``<id>, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, with
    ``with_ids``, ``ids`` (the piece's token ids). A document's ids are those of its whole text
    and ``end_id``; a null or empty text has ``end_id`` alone. A document longer than ``size``
    fills sequences of its own first; only its rest shares one. Pieces lie in a sequence
    without gaps. Repeated rows are packed as often as they come; an empty table gives an
    empty result; other columns are ignored.

    Each task keeps ``open_windows`` windows and places each rest best-fit. What is still open
    at the end, a bounded number of windows for each task, is merged over rounds: a task of
    the next round takes the pieces in the windows of ``MERGED_TASKS`` tasks, places them anew
    and leaves as few windows open. Only pieces of leftover windows move.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    tokens = shared_tokens(documents, tokenizer_path)
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens().encode
        windows = Windows(size, open_windows, TaskContext.get().partitionId() << 32)
        waiting: dict[int, list[tuple]] = {}

        def rows(numbers: list[int], still_open: bool) -> pa.RecordBatch:
            found = [row for number in numbers for row in waiting.pop(number)]
            ids, *columns, pieces = list(zip(*found)) if found else [[]] * 8
            arrays = [pa.array(ids, kind), *(pa.array(c, pa.int64()) for c in columns)]
            arrays.append(pa.array([still_open] * len(found), pa.bool_()))
            if with_ids:
                flat = np.frombuffer(b"".join(pieces), "<u4").view(np.int32)
                bounds = np.cumsum([0, *map(len, pieces)]) // 4
                arrays.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat)))
            names = ["id", *PIECE, "open", *["ids"] * with_ids]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in slices(batches):
            kind, done = batch.schema.field("id").type, []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(value or "") + end
                total = len(ids) // 4
                for start in range(0, total, size):
                    piece = ids[4 * start : 4 * (start + size)]
                    length = len(piece) // 4
                    number, offset, closed = windows.place(length)
                    row = (key, start, length, zlib.crc32(piece), total, number, offset, piece if with_ids else None)
                    waiting.setdefault(number, []).append(row)
                    done += closed
            if done:
                yield rows(done, False)
        if waiting:
            yield rows(list(waiting), True)

    columns = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind_name = columns.schema["id"].dataType.simpleString()
    schema = f"id {kind_name}, {', '.join(f'`{c}` long' for c in PIECE)}, open boolean" + ", ids array<int>" * with_ids
    packed = stage(columns.mapInArrow(pack, schema), "pieces")
    done, left = [packed.filter("NOT open")], packed.filter("open")
    tasks = ((left.agg(F.max("window")).first()[0] or 0) >> 32) + 1
    while True:
        tasks = -(-tasks // MERGED_TASKS)
        left = stage(_merged(left, tasks, size, open_windows), "merged-pieces")
        if tasks == 1:
            break
        done.append(left.filter("NOT open"))
        left = left.filter("open")
    result = done[0]
    for i, rows in enumerate([*done[1:], left], 1):  # above the task's bits, the round's
        result = result.unionByName(rows.withColumn("window", F.col("window").bitwiseOR(F.lit(i << 58))))
    return result.drop("open").withColumnsRenamed({"window": "sequence_id", "id": id})


def _merged(pieces: DataFrame, tasks: int, size: int, open_windows: int) -> DataFrame:
    """The pieces of open windows, placed anew in ``tasks`` tasks, the longest first."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(size, open_windows, TaskContext.get().partitionId() << 32)
        held = [batch for batch in batches if batch.num_rows]
        places = [[windows.place(n)[:2] for n in batch.column("length").to_pylist()] for batch in held]
        still = {number for _, number in windows.open} if tasks > 1 else set()
        for batch, found in zip(held, places):
            new = {
                "window": pa.array([number for number, _ in found], pa.int64()),
                "offset": pa.array([offset for _, offset in found], pa.int64()),
                "open": pa.array([number in still for number, _ in found], pa.bool_()),
            }
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in batch.schema.names], batch.schema.names)

    moved = pieces.repartition(tasks, "window").sortWithinPartitions(F.desc("length"), "window", "offset")
    return moved.mapInArrow(merge, pieces.schema)
