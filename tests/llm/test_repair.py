import hashlib
import heapq
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from sparkprep.llm import repair as module
from sparkprep.llm.queries import ORACLE, QUERIES
from sparkprep.llm.repair import BLOCK, CUT, GONE, SOUND, _choose, _summary, kind_of, lines, mark, repair, solve, written

ALL = SOUND + CUT + GONE


def cheapest(marks):
    """Cost, letters and roles of the cheapest repair, by a search over (cost, letters) with whole strings."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, row, state, roles = heapq.heappop(heap)
        if (row, state) in done:
            continue
        done.add((row, state))
        if row == len(marks) and state in ("", "a"):
            return cost, letters, list(roles)
        after = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        heapq.heappush(heap, (cost + 2, letters + "I", row, after, (*roles, after)))
        if row < len(marks):
            sign, kind = marks[row], kind_of(marks[row])
            heapq.heappush(heap, (cost + 3, letters + "D", row + 1, state, roles))
            if sign not in GONE:
                extra = int(sign in CUT)
                if kind == after or kind == "s" and state == "":
                    heapq.heappush(heap, (cost + extra, letters + "K", row + 1, kind, (*roles, kind)))
                if kind != after:
                    heapq.heappush(heap, (cost + 2 + extra, letters + "R", row + 1, after, (*roles, after)))


def draws(seed, count, size):
    draw = random.Random(seed)
    return ["".join(draw.choices(ALL, weights=[2, 6, 6, 1, 1, 2, 2, 1, 1, 2, 2, 1], k=draw.randint(0, size))) for _ in range(count)]


def test_least_integer_is_the_cheapest_repair():
    for marks in [*draws(1, 400, 9), *ALL, "s", "sa", "ss", "xxx", *draws(2, 10, 60)]:
        cost, letters, roles = cheapest(marks)
        assert solve(marks) == (cost, letters), marks
        given = [r for done, names in written(marks, letters) for r in names.split()]
        assert [r[0] for r in given if r != "="] == [r for r, g in zip(roles, given) if g != "="]


@pytest.mark.parametrize("size", [1, 2, 5])
def test_blocks_give_what_the_whole_gives(size):
    for marks in filter(None, draws(size, 300, 24)):
        blocks = [marks[i : i + size] for i in range(0, len(marks), size)]
        cost, path = _choose([_summary(b) for b in blocks])
        letters = ""
        for block, (start, end) in zip(blocks, path):
            paths = module.Paths(block, start)
            letters += paths.letters(paths.value[end])
        letters += "I" * {module.SYSTEM: 2, module.USER: 1}.get(path[-1][1], 0)
        assert (cost, letters) == solve(marks), marks


def test_marks_and_lines():
    assert [mark("user", t) for t in ("a.", "a. \n", "a", "", " \t", "\x1c")] == ["u", "u", "U", "2", "2", "U"]
    assert [mark(r, "a.") for r in ("system", "assistant", "tool", " ", "", "User")] == list("saxxxx") and mark("assistant", "a", True) == "3"
    assert lines("IK", "user =", "assistant", "b") == ["user:", "assistant:b"] and lines("ID", "user", "x", "y") == ["user:"]
    assert lines("R", "user", "x", "y") == ["user:y"] and lines("D", "", "x", "y") == [] and lines("II", "user assistant", "", "") == ["user:", "assistant:"]


def damaged(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else text.translate({ord(c): None for c in ".!?"}) if fault == 2 else text
        found[conv] += [(turn, "user" if fault == 4 else role, text)] * [1, 0, 2][(fault == 0) + 2 * (fault == 3)]
    return found


def expected(rows):
    results = []
    for conv, own in damaged(rows).items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        marks, seen, counts = "", set(), [0, 0, 0]
        for _, role, text in own:
            marks += mark(role, text, (role, text) in seen)
            blank = not text.encode().split()
            counts[0] += blank
            counts[1] += not blank and (role, text) in seen
            counts[2] += marks[-1] in CUT
            seen.add((role, text))
        kinds = [kind_of(m) for m in marks]
        wrong = sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, letters, roles = cheapest(marks)
        out, row, written_roles = [], 0, iter(roles)
        for letter in letters:
            if letter != "D":
                role = {"s": "system", "u": "user", "a": "assistant"}[next(written_roles)]
                out.append((own[row][1] if letter == "K" else role) + ":" + ("" if letter == "I" else own[row][2]))
            row += letter != "I"
        digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
        results.append((conv, gaps, *counts, wrong, cost, letters, digest))
    return sorted(results, key=repr)


def talks(seed, count, long):
    draw = random.Random(seed)
    rows = []
    for conv in range(count):
        size = long if conv == 3 else draw.randint(1, 9)
        for turn in range(size):
            role = draw.choice(["user", "assistant"]) if draw.random() < 0.2 else ["user", "assistant"][turn % 2]
            role = "system" if turn == 0 and draw.random() < 0.3 else draw.choice([role] * 20 + ["tool", "", None])
            text = draw.choice(["Yes.", "No", "Well!", None, "", " \n", f"Number {turn}.", f"It is {turn}", f"Is it {turn}? \t", "line\nline."])
            rows.append((conv, draw.choice([turn * 2] * 8 + [turn, None]) if conv % 5 == 0 else turn, role, text))
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hello."), (None, None, None, None), (10**6, None, "user", "x"), (10**6 + 1, 7, "assistant", "b.")]
    return rows


@pytest.mark.parametrize("partitions", [2, 13])
def test_query_gives_what_brute_force_and_sql_give(spark, tmp_path, partitions):
    rows = talks(partitions, 400, 1300)
    table = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, place int")
    table.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = QUERIES["op13_conversation_repair"](spark, str(tmp_path))
        found = sorted(map(tuple, got.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = expected(rows)
    assert found == want and len(found) == 403
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet' WHERE conv_id IS DISTINCT FROM 3")
        sql = db.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE['op13_conversation_repair']})").fetchall()
    assert sorted(sql, key=repr) == [r for r in want if r[0] != 3]


def test_odd_tables(spark):
    kinds = "conv_id long, turn int, role string, text string"
    assert repair(spark.createDataFrame([], kinds)).count() == 0
    same = spark.createDataFrame([(1, 0, "user", "Again.")] * (3 * BLOCK) + [(2, 0, "tool", "a" * 100_000)], kinds).repartition(4)
    found = {r.conv_id: r for r in repair(same).collect()}
    assert (found[1].duplicate, found[1].cost, found[1].audit) == (3 * BLOCK - 1, 3 * (3 * BLOCK - 1) + 2, "K" + "D" * (3 * BLOCK - 1) + "I")
    assert found[1].repaired_sha256 == hashlib.sha256(b"user:Again.\nassistant:").hexdigest()
    assert (found[2].cost, found[2].audit, found[2].truncated) == (3, "D", 1)
    nothing = repair(same, present=F.lit(False)).collect()
    assert sorted((r.conv_id, r.cost, r.audit, r.repaired_sha256) for r in nothing) == [(i, 0, "", hashlib.sha256(b"").hexdigest()) for i in (1, 2)]
