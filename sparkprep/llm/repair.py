"""Repair of the structure of conversations: the cheapest edits, found by minima over big integers.

A path of edits is one integer: its high digits are the cost, its low digits the letters of the edits, each
in the place of its position, with zeros after the last. So the least integer is the cheapest
path, and of equally cheap ones that with the least letters, and a plain shortest-path search over
rows and roles finds it.

After a row, no path's letters begin another's, because all have as many letters other than ``I`` and
end with one. So long conversations are cut into blocks of rows: paths through a block are compared by
themselves, and a path's rank among the four of a block's end stands for all its letters so far.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.llm.session import bound_batches
from sparkprep.plans.staging import stage

BLOCK = 512
HELD_BYTES = 8 << 20
DIGIT = 3
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
# What was written so far: nothing, a system turn alone, a user turn last, an assistant turn last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
# A row's mark says the kind of its role (system, user, assistant, other) and its fault: none, truncated, or to be deleted.
SOUND, CUT, GONE = "suax", "SUAX", "1234"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
BLANKS = " \t\n\x0b\x0c\r"


def mark(role: str, text: str, seen: bool = False) -> str:
    """The mark of a row; ``seen`` says that an earlier row has its role and text."""
    kind = "sua".find(role[:1]) if role else -1
    visible = text.rstrip(BLANKS)
    if not visible or seen:
        return GONE[kind]
    return SOUND[kind] if visible[-1] in ".!?" else CUT[kind]


def kind_of(sign: str) -> str:
    return sign if sign in SOUND else SOUND[(CUT if sign in CUT else GONE).index(sign)]


class Paths:
    """The least paths through rows with the given marks, from one state to each other.

    ``value[state]`` is the integer of the least path that ends there after the last row's edit, None if
    there is none. A row's insertions come before its edit.
    """

    def __init__(self, marks: str, start: int):
        self.width = 3 * len(marks) + 2  # two insertions and an edit a row, and two insertions at the end
        self.high = DIGIT * self.width
        self.value: list[int | None] = [None] * 4
        self.used = [0] * 4
        self.value[start] = 0
        for sign in marks:
            self._insert()
            self._row(sign)

    def _step(self, value: list, used: list, source: int, target: int, cost: int, letter: str) -> None:
        """An arc of the search; its weight depends on how many letters came before."""
        if self.value[source] is None:
            return
        place = self.high - DIGIT * (self.used[source] + 1)
        found = self.value[source] + (cost << self.high) + (LETTERS[letter] << place)
        if value[target] is None or found < value[target]:
            value[target], used[target] = found, self.used[source] + 1

    def _insert(self) -> None:
        for _ in range(2):  # a third insertion only leads back
            value, used = self.value[:], self.used[:]
            for state in range(4):
                self._step(value, used, state, NEXT[state], INSERT, "I")
            self.value, self.used = value, used

    def _row(self, sign: str) -> None:
        value, used = [None] * 4, [0] * 4
        for state in range(4):
            self._step(value, used, state, state, DELETE, "D")
            if sign in GONE:
                continue
            extra, kind = TRUNCATED * (sign in CUT), kind_of(sign)
            if kind == "s" and state == EMPTY:
                self._step(value, used, state, SYSTEM, extra, "K")
            target = NEXT[state]
            keeps = kind == ROLES[target][0]
            self._step(value, used, state, target, extra + (0 if keeps else REROLE), "K" if keeps else "R")
        self.value, self.used = value, used

    def finish(self) -> tuple[int, str]:
        """Cost and letters of the least path that ends a conversation."""
        ends = [self.value[EMPTY], self.value[ASSISTANT]]
        self._insert()
        ends.append(self.value[ASSISTANT])
        best = min(v for v in ends if v is not None)
        return best >> self.high, self.letters(best)

    def letters(self, value: int) -> str:
        low = value & ((1 << self.high) - 1)
        digits = (low >> (self.high - DIGIT * (i + 1)) & 7 for i in range(self.width))
        return "".join(" DIKR"[d] for d in digits if d)


@lru_cache(maxsize=100_000)
def solve(marks: str) -> tuple[int, str]:
    """Cost and letters of the cheapest repair of a whole conversation."""
    return Paths(marks, EMPTY).finish()


def written(marks: str, letters: str, state: int = EMPTY) -> Iterator[tuple[str, str | None]]:
    """For each row ``letters, roles``: what is done at the row and the roles written there, ``=`` for its own.

    Letters after the last row's edit come as one more item.
    """
    done, roles, row = "", [], 0
    for letter in letters:
        done += letter
        if letter == "K" and state == EMPTY and kind_of(marks[row]) == "s":
            state = SYSTEM
            roles.append("=")
        elif letter != "D":
            state = NEXT[state]
            roles.append("=" if letter == "K" else ROLES[state])
        if letter != "I":
            yield done, " ".join(roles)
            done, roles, row = "", [], row + 1
    if done:
        yield done, " ".join(roles)


def lines(done: str, roles: str, role: str, text: str) -> list[str]:
    """The repaired lines that a row with its letters gives."""
    names = roles.split(" ") if roles else []
    last = None if done[-1] in "DI" else len(names) - 1
    return [f"{role if name == '=' else name}:{text if i == last else ''}" for i, name in enumerate(names)]


def illegal(marks: str) -> int:
    kinds = [kind_of(sign) for sign in marks]
    return sum(pair not in LEGAL for pair in zip(kinds, kinds[1:]))


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
FOUND = ["conv", *COUNTS, "audit", "repaired", "part", "place", "turn", "role", "text", "sign", "present"]


def _whole(conv, rows: list[tuple]) -> tuple:
    """The result of a conversation of which all rows are at hand."""
    seen, marks, blank, copies = set(), [], 0, 0
    rows = [r for r in rows if r[3]]
    for _, role, text, _ in rows:
        empty, known = not text.strip(BLANKS), (role, text) in seen
        seen.add((role, text))
        blank += empty
        copies += known and not empty
        marks.append(mark(role, text, known))
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    marks = "".join(marks)
    cost, audit = solve(marks)
    out = []
    for i, (done, roles) in enumerate(written(marks, audit)):
        out += lines(done, roles, *(rows[i][1:3] if i < len(rows) else ("", "")))
    cut = sum(sign in CUT for sign in marks)
    return (conv, gaps, blank, copies, cut, illegal(marks), cost, audit, "\n".join(out), *[None] * 7)


def _solve_short(rows: DataFrame, schema: str) -> DataFrame:
    """Results of the conversations that lie within one sorted part; rows of all others with their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in FOUND]
        types: list[pa.DataType] = []
        size = place = 0

        def put(row: tuple) -> None:
            nonlocal size
            for column, value in zip(columns, row):
                column.append(value)
            size += len(row[8] or row[13] or "")

        def flush() -> pa.RecordBatch:
            nonlocal columns, size
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], FOUND)
            columns, size = [[] for _ in FOUND], 0
            return batch

        def spread(part: int) -> None:
            nonlocal place
            for turn, role, text, present in held:
                sign = mark(role, text) if present else None
                put((current, *[None] * 8, part, place, turn, role, text, sign, present))
                place += 1
            held.clear()

        held: list[tuple] = []
        current, begun, borders, part, weight = None, False, True, 0, 0
        for batch in batches:
            if not types:
                long, string = pa.int64(), pa.string()
                types = [batch.schema.field(0).type, *[long] * 6, string, string, long, long, long, string, string, string, pa.bool_()]
            for conv, turn, role, text, present, part in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or conv != current:
                    if begun and borders:
                        spread(part)
                    elif begun:
                        put(_whole(current, held))
                        held.clear()
                    current, borders, weight, begun = conv, not begun, 0, True  # the first may have begun in the part before
                held.append((turn, role, text, present))
                weight += len(text)
                full = len(held) > BLOCK or weight > HELD_BYTES
                borders = borders or full
                if full:
                    spread(part)
                    weight = 0
                if len(columns[0]) >= 4096 or size > HELD_BYTES:
                    yield flush()
        spread(part)  # the last may go on in the part after
        if columns[0]:
            yield flush()

    return rows.mapInArrow(run, schema)


def _blocks(signed: DataFrame) -> DataFrame:
    """Marks of the rows of each block, costs of its least paths, and the ranks of their letters by start."""
    entry = F.sort_array(F.collect_list(F.struct("place", "sign")))
    blocks = signed.groupBy("conv", "part", F.floor(F.col("place") / BLOCK).alias("block")).agg(entry.alias("rows"))
    blocks = blocks.select("conv", "part", "block", F.array_join(F.col("rows.sign"), "").alias("marks"), F.col("rows.place").alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_summary(m) for m in batch.column("marks").to_pylist()]
            wrong = [illegal(m) for m in batch.column("marks").to_pylist()]
            arrays = [*batch.columns, pa.array(found, pa.list_(pa.int64())), pa.array(wrong, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "summary", "illegal"])

    kinds = ", ".join(f"{n} {t}" for n, t in blocks.dtypes)
    return blocks.mapInArrow(run, f"{kinds}, summary array<bigint>, illegal bigint")


@lru_cache(maxsize=10_000)
def _summary(marks: str) -> list[int]:
    """For each start and end the cost of the least path times 4 plus its letters' rank among those of the start; -1 without a path."""
    found = []
    for start in range(4):
        paths = Paths(marks, start)
        low = (1 << paths.high) - 1
        order = sorted(v & low for v in paths.value if v is not None)
        found += [-1 if v is None else (v >> paths.high) * 4 + order.index(v & low) for v in paths.value]
    return found


def _choose(summaries: list[list[int]]) -> tuple[int, list[tuple[int, int]]]:
    """The cost of the least path through all blocks, and each block's start and end.

    The integer of a path is its cost, its rank before the block and its rank in the block.
    """
    value: list[int | None] = [0, None, None, None]  # cost times 4 plus rank
    back = []
    for summary in summaries:
        new: list[tuple[int, int] | None] = [None] * 4
        for end in range(4):
            ways = [
                (((value[s] >> 2) + (summary[4 * s + end] >> 2) << 4) + ((value[s] & 3) << 2) + (summary[4 * s + end] & 3), s)
                for s in range(4)
                if value[s] is not None and summary[4 * s + end] >= 0
            ]
            new[end] = min(ways, default=None)
        order = sorted(w[0] & 15 for w in new if w)
        value = [None if w is None else (w[0] >> 4) * 4 + order.index(w[0] & 15) for w in new]
        back.append([None if w is None else w[1] for w in new])
    extra = {EMPTY: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}
    best, state = min((v + 4 * extra[s], s) for s, v in enumerate(value) if v is not None)
    path = []
    for starts in reversed(back):
        path.append((starts[state], state))
        state = starts[state]
    return best >> 2, path[::-1]


def _find_paths(blocks: DataFrame, kind: str) -> DataFrame:
    """Start, end and marks' faults of each block on its conversation's least path; one number a block is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type = None
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            cost, path = _choose([r[4] for r in held])
            rows = []
            for i, (r, (start, end)) in enumerate(zip(held, path)):
                border = i > 0 and (held[i - 1][6], r[5]) not in LEGAL
                rows.append((r[0], r[1], r[2], start, end, i == len(held) - 1, r[3] + border, cost if i == 0 else 0))
            names = ["conv", "part", "block", "start", "end", "last", "illegal", "cost"]
            types = [conv_type, pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for conv, part, block, wrong, summary, head, tail in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != conv:
                    yield close()
                    held.clear()
                held.append((conv, part, block, wrong, summary, kind_of(head), kind_of(tail)))
        if held:
            yield close()

    ends = [F.substring("marks", 1, 1).alias("head"), F.substring("marks", -1, 1).alias("tail")]
    columns = blocks.select("conv", "part", "block", "illegal", "summary", *ends)
    ordered = columns.repartition("conv").sortWithinPartitions("conv", "part", "block")
    return ordered.mapInArrow(run, f"conv {kind}, part long, block long, start int, end int, last boolean, illegal long, cost long")


def _edits(blocks: DataFrame, kind: str) -> DataFrame:
    """``conv, part, place, done, roles`` of each row; what follows the last row is at the place after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, part, places, marks, start, end, last in zip(*(c.to_pylist() for c in batch.columns)):
                paths = Paths(marks, start)
                letters = paths.letters(paths.value[end])
                if last:
                    letters += "I" * {SYSTEM: 2, USER: 1}.get(end, 0)
                rows += [(conv, part, place, *x) for place, x in zip([*places, places[-1] + 1], written(marks, letters, start))]
            types = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv", "part", "place", "done", "roles"])

    columns = blocks.select("conv", "part", "places", "marks", "start", "end", "last")
    return columns.mapInArrow(run, f"conv {kind}, part long, place long, done string, roles string")


def _stream(rows: DataFrame, kind: str) -> DataFrame:
    """``conv, audit, repaired_sha256`` from rows in order; texts pass through and are not held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type, current = None, None
        digest, letters, some = None, [], False

        def close() -> pa.RecordBatch:
            columns = [pa.array([current], conv_type), pa.array(["".join(letters)]), pa.array([digest.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, ["conv", "audit", "repaired_sha256"])

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for conv, done, roles, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if digest is None or conv != current:
                    if digest is not None:
                        yield close()
                    current, digest, letters, some = conv, hashlib.sha256(), [], False
                letters.append(done)
                for line in lines(done, roles, role or "", text or ""):
                    digest.update((b"\n" if some else b"") + line.encode())
                    some = True
        if digest is not None:
            yield close()

    ordered = rows.repartition("conv").sortWithinPartitions("conv", "part", "place").select("conv", "done", "roles", "role", "text")
    return ordered.mapInArrow(run, f"conv {kind}, audit string, repaired_sha256 string")


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which ``conv`` may be null. The hint keeps the plan the same at every size."""
    right = right.withColumnsRenamed({k: f"other_{k}" for k in keys}).hint("merge")
    equal = [left[k].eqNullSafe(F.col(f"other_{k}")) for k in keys]
    condition = equal[0]
    for c in equal[1:]:
        condition &= c
    return left.join(right, condition, how).drop(*(f"other_{k}" for k in keys))


def repair(
    rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None
) -> DataFrame:
    """``<conv>, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired, repaired_sha256`` for each conversation.

    A conversation's rows are taken by turn, nulls first, and those of one turn by role and a hash of the
    text. A null conversation is one of its own; a null role or text reads as one space. Rows for which
    ``present`` is false stand for their conversation only. The first of these faults of a row counts:
    ``blank`` without a character other than white space, ``duplicate`` with the role and text of an earlier
    row, ``truncated`` if the last such character is none of ``.!?``. ``gaps`` counts the missing turn
    numbers between the first and the last, ``illegal`` the neighbours whose roles' initials are not su, ua or au.

    The repair brings the initials into the form ``(s?(ua)+)?``: keep a row for nothing, give it the role user
    or assistant for 2, delete it for 3, as blank rows and duplicates must be, or insert an empty user or
    assistant turn for 2; a truncated row that stays costs 1. ``cost`` is the least sum and ``audit`` the
    initials of its edits in order, the least of equals. ``repaired`` has the lines ``role:text``. A conversation
    without rows has zeros and an empty audit. An empty table gives an empty result; other columns are ignored.

    Rows are range-partitioned by conversation and turn. Conversations within a part of at most
    ``BLOCK`` rows are repaired there. The others are cut into blocks of ``BLOCK`` rows: paths through
    blocks are found in parallel, joined by their costs and ranks, and a row learns its edit
    from its block. For these ``repaired`` is null, as it could be of any size; the digest, which has to pass over the lines
    in order, streams them through one task, and so the letters of ``audit``.
    """
    spark = rows.sparkSession
    bound_batches(spark)
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    source = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        here.alias("present"),
    )
    kind = source.schema["conv"].dataType.simpleString()
    order = ["conv", "turn", "role", "digest", "salt"]
    source = source.withColumn("digest", F.md5("text")).withColumn("salt", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = source.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    cut = cut.select("conv", "turn", "role", "text", "present", F.spark_partition_id().cast("long").alias("part"))
    schema = f"conv {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
    schema += ", audit string, repaired string, part long, place long, turn long, role string, text string, sign string, present boolean"
    found = stage(_solve_short(cut, schema), "conversations")
    short = found.filter("part IS NULL").select("conv", *COUNTS, "audit", "repaired", F.sha2("repaired", 256).alias("repaired_sha256"))

    long = found.filter("part IS NOT NULL").select("conv", "part", "place", "turn", "role", "text", "sign", "present")
    there = long.filter("present").withColumn("digest", F.sha2("text", 256))
    empty = F.col("sign").isin(*GONE)
    keys = ["conv", "role", "digest"]
    firsts = stage(there.filter(~empty).groupBy(*keys).agg(F.min(F.struct("part", "place")).alias("first")), "first-rows")
    signed = _same(there.select("conv", "part", "place", "turn", "role", "digest", "sign"), firsts, keys, "left")
    again = ~empty & (F.col("first") != F.struct("part", "place"))
    gone = F.expr(f"substring('{GONE}', locate(lower(sign), '{SOUND}'), 1)")
    signed = stage(
        signed.select("conv", "part", "place", "turn", again.alias("again"), empty.alias("empty"), F.when(again, gone).otherwise(F.col("sign")).alias("sign")),
        "marked-rows",
    )
    blocks = stage(_blocks(signed), "blocks")
    paths = stage(_find_paths(blocks, kind), "paths")
    keys = ["conv", "part", "block"]
    edits = stage(_edits(_same(blocks.drop("illegal"), paths, keys), kind), "edits")
    edited = _same(edits, there.select("conv", "part", "place", "role", "text"), ["conv", "part", "place"], "left")
    streamed = _stream(edited, kind)

    counts = signed.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        F.count_if("empty").alias("blank"),
        F.count_if("again").alias("duplicate"),
        F.count_if(F.col("sign").isin(*CUT)).alias("truncated"),
    )
    sums = paths.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    whole = long.select("conv").distinct()
    for table in (counts, sums, streamed):
        whole = _same(whole, table, ["conv"], "left")
    whole = whole.select(
        "conv",
        *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.lit(None).cast("string").alias("repaired"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
    return short.unionByName(whole).withColumnRenamed("conv", conv)
