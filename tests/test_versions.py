import random
from collections import Counter

import pytest

from sparkprep.operators import versions

KIND = "input_text string, output_text string"


def rows(counts):
    return [(f"in{c}" if c else None, f"out{c}") for c, n in counts.items() for _ in range(n)]


def keyed(spark, counts):
    """Content key -> rows of a version, counted anew."""
    from pyspark.sql import functions as F

    from sparkprep.operators.dataset import content_key

    df = spark.createDataFrame(rows(counts), KIND)
    return {r.k: r.n for r in df.groupBy(content_key(*versions.CONTENT).alias("k")).agg(F.count("*").alias("n")).collect()}


def test_history_holds_every_version(spark, tmp_path):
    draw, history = random.Random(5), str(tmp_path / "h")
    numbers = [1, 2, 5, 6, 9]  # versions need not be consecutive
    states = [Counter({c: draw.choice([0, 0, 1, 1, 2]) for c in range(25)}) for _ in numbers]
    states[3] = Counter()
    for n, (number, counts) in enumerate(zip(numbers, states)):
        versions.extend(history, spark.createDataFrame(rows(counts), KIND).repartition(2), number, numbers[n - 1] if n else None)
    found = versions.runs(spark, history).collect()
    for n, (number, counts) in enumerate(zip(numbers, states)):
        want = keyed(spark, counts)
        assert {r.content_key: r["count"] for r in versions.state_at(spark, history, number).collect()} == want
        covering = [r for r in found if r.from_version <= number and (r.to_version is None or r.to_version >= number)]
        assert {r.content_key: r["count"] for r in covering} == want and len(covering) == len(want)
    per_version = {r.version: (r.added, r.removed, r.changed) for r in versions.changes(spark, history).collect()}
    before: Counter = Counter()
    for number, counts in zip(numbers, states):
        own = {c for c, k in counts.items() if k}
        old = {c for c, k in before.items() if k}
        want = (len(own - old), len(old - own), sum(counts[c] != before[c] for c in own & old))
        assert per_version.get(number, (0, 0, 0)) == want
        before = counts
    assert {p.name for p in (tmp_path / "h" / "open").glob("version=*")} == {"version=6", "version=9"}


def test_an_extension_can_be_repeated_and_reads_no_older_version(spark, tmp_path):
    history = str(tmp_path / "h")
    for number, counts in ((1, {0: 1, 1: 1}), (2, {1: 1, 2: 3}), (3, {1: 2}), (3, {1: 2})):
        versions.extend(history, spark.createDataFrame(rows(counts), KIND), number, number - 1 or None)
    assert sorted((r["count"], r.from_version, r.to_version) for r in versions.runs(spark, history).collect() if r.to_version) == [(1, 1, 1), (1, 1, 2), (3, 2, 2)]
    plan = versions.state_at(spark, history, 2)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(version" in plan and "> 2)" in plan
    with pytest.raises(ValueError):
        versions.extend(history, spark.createDataFrame([], KIND), 3, 3)
