import numpy as np

from sparkprep.llm import vectors
from sparkprep.llm.graph import thinned
from sparkprep.llm.vectors import near_duplicates, spherical_kmeans


def reference(ids, labels, points, threshold=0.93):
    x = points / np.linalg.norm(points, axis=1, keepdims=True)
    linked = (x @ x.T >= threshold) & (labels[:, None] == labels[None, :]) & ~np.eye(len(x), dtype=bool)
    component = ids.copy()
    for _ in range(len(ids)):
        least = np.minimum(component, np.where(linked, component[None, :], 1 << 60).min(axis=1))
        if (least == component).all():
            break
        component = least
    return {i: (int(n), int(c)) for i, n, c in zip(ids.tolist(), linked.sum(axis=1), component)}


def test_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 40)
    draw = np.random.default_rng(6)
    centers = draw.normal(size=(25, 12))
    points = np.concatenate([centers[draw.integers(0, 25, 300)] + draw.normal(size=(300, 12)) * 0.3, np.repeat(centers[:2], 30, axis=0)])
    labels, ids = draw.integers(0, 3, len(points)), draw.permutation(len(points)) + 1
    rows = [(int(i), [float(v) for v in p], int(l)) for i, p, l in zip(ids, points, labels)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    for cell_size in (20, 10_000):
        got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df, cell_size=cell_size).collect()}
        assert got == reference(ids, labels, points)


def test_data(spark, data):
    df = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = df.collect()
    want = reference(np.array([r.vec_id for r in rows]), np.array([r.label for r in rows]), np.array([r.embedding for r in rows], float))
    assert {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df, cell_size=50).collect()} == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0, 0.0], [nan, 1.0], [1.0, None], [inf, 1.0], [1.0], [1.0, 2.0, 3.0]]  # the last two alone with their length
    rows = [(i, v, 1, "x", 5) for i, v in enumerate(odd)]
    rows += [(20, [1.0, 0.0], 1, "x", 5), (21, [1e300, 1e298], 1, "x", 5), (22, [1.0, 0.0], None, "x", 5), (None, [1.0, 0.0], 1, "x", 5), (20, [1.0, 0.0], 1, "x", 5), (23, [1e-300, 0.0], 2, "x", 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string, size int")
    got = near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert all((r.n_links, r.component_id, r.kept) == (0, r.vec_id, True) for r in got if r.vec_id not in (20, 21))
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id in (20, 21)) == [(20, 1, 20, True)] * 2 + [(21, 1, 20, False)]
    assert near_duplicates(df.limit(0)).count() == 0


def test_centroids_are_unit_vectors_of_their_cells():
    draw = np.random.default_rng(1)
    points = draw.normal(size=(500, 8))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centers = spherical_kmeans(points, 10)
    assert np.allclose(np.linalg.norm(centers, axis=1), 1)
    assert (points @ centers.T).max(axis=1).mean() > 0.5


def test_vectors_of_each_width_are_compared(spark):
    draw = np.random.default_rng(3)
    rows, want = [], {}
    for width, count, first in ((2, 5, 0), (3, 120, 100), (8, 300, 1000)):
        ids, labels = np.arange(first, first + count), draw.integers(0, 2, count)
        points = draw.normal(size=(20, width))[draw.integers(0, 20, count)] + draw.normal(size=(count, width)) * 0.2
        want |= reference(ids, labels, points)
        rows += [(int(i), p.tolist(), int(l)) for i, p, l in zip(ids, points, labels)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    assert {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df, cell_size=40).collect()} == want


def test_a_width_that_was_not_drawn_is_one_cell(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SAMPLE", 1e-9)
    df = spark.createDataFrame([(i, [1.0, i / 10], 1) for i in range(30)], "vec_id long, embedding array<double>, label int")
    points = np.array([[1.0, i / 10] for i in range(30)])
    want = reference(np.arange(30), np.ones(30), points)
    assert {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df).collect()} == want


def test_vectors_near_to_all_cells_are_not_copied_for_each(spark, monkeypatch):
    staged, write = {}, vectors.stage
    monkeypatch.setattr(vectors, "stage", lambda df, label: staged.setdefault(label, write(df, label)))
    draw = np.random.default_rng(8)
    points = draw.normal(size=(1_500, 32)).astype(np.float32).astype(float)
    points[:300] = points[300:600] * 2
    ids, labels = draw.permutation(1_500), draw.integers(0, 2, 1_500)
    rows = [(int(i), p.tolist(), int(l)) for i, p, l in zip(ids, points, labels)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    monkeypatch.setattr(vectors, "unstage", lambda df: None, raising=False)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df, cell_size=5).collect()}
    assert got == reference(ids, labels, points)
    assert max(df.count() for df in staged.values()) <= len(rows)  # not a row for each of 300 cells


def test_blocks_meet_in_small_batches_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 37)
    monkeypatch.setattr(vectors, "BLOCK_VALUES", 37 * 8)
    monkeypatch.setattr(vectors, "TILE", 8)
    monkeypatch.setattr(vectors, "BATCH_BYTES", 500)
    draw = np.random.default_rng(12)
    rows, want = [], {}
    for width, count, first in ((4, 300, 0), (16, 200, 1000)):
        points = draw.normal(size=(30, width))[draw.integers(0, 30, count)] + draw.normal(size=(count, width)) * 0.15
        ids, labels = first + draw.permutation(count), draw.choice(["a", "b", ""], count, p=[0.8, 0.19, 0.01])
        want |= reference(ids, labels, points)
        rows += [(int(i), p.tolist(), str(l)) for i, p, l in zip(ids, points, labels)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(3)
    assert {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df, cell_size=20).collect()} == want


def test_thinned_edges_connect_the_same():
    draw = np.random.default_rng(2)
    for count in (0, 1, 30, 90, 400):
        a, b = draw.integers(0, 100, (2, count)) * 7
        least = {i: i for i in {*a.tolist(), *b.tolist()}}
        for _ in least:
            for x, y in zip(a.tolist(), b.tolist()):
                least[x] = least[y] = min(least[x], least[y])
        x, y = thinned(a, b)
        assert dict(zip(x.tolist(), y.tolist())) == {i: m for i, m in least.items() if i != m}
        assert len(x) == len(set(x.tolist()))
