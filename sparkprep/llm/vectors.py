"""Near-duplicate vectors: cells by spherical k-means, blocked cosine products between near cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sparkprep.llm.graph import components, forest, grouped, thinned
from sparkprep.llm.session import BATCH_BYTES, bound_batches
from sparkprep.llm.spread import attach, hot_classes
from sparkprep.plans.staging import stage, unstage

SAMPLE = 20_000
SAMPLE_VALUES = 4_000_000
CELL = 4_000
MAX_CELLS = 2_048
BLOCK = 32_768
BLOCK_VALUES = 1 << 22
TILE = 1_024
PRODUCTS = 1 << 20


def _parts(rows: np.ndarray, columns: int) -> Iterator[np.ndarray]:
    """Cut rows so that a part's products with so many columns are about ``PRODUCTS`` values."""
    step = max(1, PRODUCTS // columns)
    return (rows[at : at + step] for at in range(0, len(rows), step))


def spherical_kmeans(vectors: np.ndarray, k: int, rounds: int = 10, seed: int = 9) -> np.ndarray:
    """Unit centroids of unit vectors: each is the direction of the sum of the vectors nearest to it."""
    random = np.random.default_rng(seed)
    centroids = vectors[random.choice(len(vectors), min(k, len(vectors)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(part @ centroids.T).argmax(axis=1) for part in _parts(vectors, len(centroids))])
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, vectors)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centroids)
    return centroids


def _values(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The components of lists, as they are stored, a row for each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _packed(values: np.ndarray) -> pa.Array:
    """Each row's bytes: they pass between tasks as they are, while lists are rebuilt value by value."""
    values = np.ascontiguousarray(values)
    bounds = np.arange(len(values) + 1, dtype=np.int32) * values[:1].nbytes
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(bounds), pa.py_buffer(values)])


def _unpacked(column: pa.Array | pa.ChunkedArray, width: int, dtype: str) -> np.ndarray:
    """The rows that :func:`_packed` made."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    begin = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], dtype, len(column) * width, begin).reshape(-1, width)


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of unit length in double precision."""
    rows = rows.astype(np.float64)
    rows = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True, initial=0), 1e-300)  # squares stay finite
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _chain(between: np.ndarray) -> np.ndarray:
    """An order in which each point is followed by the nearest that is left, so that near ones get near numbers."""
    order, left = [0], np.arange(len(between)) > 0
    while left.any():
        order.append(int(np.where(left, between[order[-1]], np.inf).argmin()))
        left[order[-1]] = False
    return np.array(order)


Grids = dict[int, tuple[np.ndarray, np.ndarray, int]]


def _grids(drawn: pa.Table, cells_a_row: float) -> Grids:
    """For each width among the drawn vectors its centroids, their distances, and the number of its first cell."""
    column = drawn.column("v").combine_chunks()
    widths = pc.list_value_length(column).to_numpy()
    grids, cells = {}, 0
    for width in np.unique(widths).tolist():
        points = _unit(_values(column.filter(pa.array(widths == width)), width))
        count = max(1, min(MAX_CELLS, int(len(points) * cells_a_row)))
        centroids = spherical_kmeans(points, count)
        between = np.stack([np.linalg.norm(centroids - c, axis=1) for c in centroids])
        order = _chain(between)
        grids[width] = centroids[order], between[order][:, order], cells
        cells += len(centroids)
    return grids


def _homes(classes: DataFrame, grids: Grids, dtype: str) -> DataFrame:
    """Each class with its width and the cell of its nearest centroid. A width of which none was drawn is one cell."""
    source = classes.sparkSession.sparkContext.broadcast(grids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = pc.list_value_length(batch.column("v")).to_numpy()
            for width in np.unique(widths).tolist():
                own = batch.filter(pa.array(widths == width))
                values, cell = _values(own.column("v"), width).astype(dtype), np.full(own.num_rows, -width)
                if width in source.value:
                    centers, _, first = source.value[width]
                    cell = first + np.concatenate([(_unit(part) @ centers.T).argmax(axis=1) for part in _parts(values, len(centers))])
                arrays = [own.column(c) for c in kept] + [_packed(values), pa.array(np.full(len(cell), width, np.int32)), pa.array(cell.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, "v", "width", "cell"])

    kept = [c for c in classes.columns if c not in ("v", "width")]
    kinds = ", ".join(f"`{n}` {t}" for n, t in classes.select(kept).dtypes)
    return classes.mapInArrow(place, f"{kinds}, v binary, width int, cell int")


def _near_cells(grid: tuple[np.ndarray, np.ndarray, int], rows: np.ndarray, cell: np.ndarray, reach: float) -> np.ndarray:
    """For each row and cell, whether the cell is the row's own or may hold a partner."""
    centers, between, first = grid
    near = _unit(rows) @ centers.T
    own = cell - first
    return near[np.arange(len(rows)), own][:, None] - near <= reach * between[own] + 1e-12


UNIT = ["label", "width", "i", "j"]


def _lines(homes: DataFrame) -> tuple[DataFrame, dict[int, tuple[np.ndarray, np.ndarray, int]]]:
    """``label, width, line`` of the vectors of one label and width that fill more than a block; of each line its cells, their counts, and the rows of a block.

    There are fewer of them than the table has blocks.
    """
    cells = stage(homes.groupBy("label", "width", "cell").agg(F.count("*").alias("n")), "cell-counts")
    total, most = F.col("total"), F.least(F.lit(BLOCK), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_VALUES) / F.col("width"))))
    large = cells.groupBy("label", "width").agg(F.sum("n").alias("total")).filter(total > most)
    large = large.select("label", "width", F.ceil(total / F.ceil(total / most)).alias("block"), F.monotonically_increasing_id().alias("line"))
    large = stage(large, "large-labels")
    rows = cells.join(F.broadcast(large), ["label", "width"]).select("line", "cell", "n", "block").toArrow().sort_by([("line", "ascending"), ("cell", "ascending")])
    line, cell, n, block = (rows.column(c).to_numpy() for c in ("line", "cell", "n", "block"))
    begins = np.flatnonzero(np.diff(line, prepend=-1)).tolist()
    return large.select("label", "width", "line"), {int(line[a]): (cell[a:b], n[a:b], int(block[a])) for a, b in zip(begins, [*begins[1:], len(line)])}


def _units(homes: DataFrame, grids: Grids, reach: float, dtype: str) -> DataFrame:
    """A row per vector and pair of blocks ``i <= j``: one is its own, in the other it may have a partner.

    The vectors of a label and width, in the order of their cells, are cut into blocks.
    """
    lines, counts = _lines(homes)
    source = homes.sparkSession.sparkContext.broadcast((grids, counts))

    def blocks(line: int, width: int, values: np.ndarray, cell: np.ndarray, draw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, their own blocks and the blocks where they may have a partner."""
        grids, counts = source.value
        cells, n, block = counts[line]
        ends = np.cumsum(n)
        starts = np.arange(0, ends[-1], block)
        low, high = np.searchsorted(ends, starts, "right"), np.searchsorted(ends - n, starts + block)  # the cells of each block
        at = np.searchsorted(cells, cell)
        own = ((ends - n)[at] + draw % n[at]) // block
        begin = 0
        for part in _parts(values, (len(grids[width][0]) if width in grids else 1) + len(starts)):
            here = slice(begin, begin + len(part))
            begin += len(part)
            near = np.ones((len(part), len(cells)), bool)
            if width in grids:
                near = _near_cells(grids[width], part, cell[here], reach)[:, cells - grids[width][2]]
            sums = np.zeros((len(part), len(cells) + 1), np.int32)
            near.cumsum(axis=1, out=sums[:, 1:])
            row, other = np.nonzero(sums[:, high] > sums[:, low])
            yield row + here.start, own[here][row], other

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            line, width = pc.fill_null(batch.column("line"), -1).to_numpy(), batch.column("width").to_numpy()
            for number in np.unique(line).tolist():
                chosen = np.flatnonzero(line == number)
                zero = np.zeros(len(chosen), np.int64)
                found: Iterator = iter([(np.arange(len(chosen)), zero, zero)])
                if number >= 0:
                    one = batch.take(pa.array(chosen))
                    wide = int(width[chosen[0]])
                    values = _unpacked(one.column("v"), wide, dtype)
                    found = blocks(number, wide, values, one.column("cell").to_numpy(), one.column("draw").to_numpy())
                step = max(1, BATCH_BYTES // (64 + int(width[chosen].max()) * np.dtype(dtype).itemsize))
                for row, own, other in found:
                    for begin in range(0, len(row), step):  # a row may go to many blocks
                        end = begin + step
                        arrays = batch.select(kept).take(pa.array(chosen[row[begin:end]])).columns
                        i, j = np.minimum(own, other)[begin:end], np.maximum(own, other)[begin:end]
                        places = [pa.array(x) for x in (i.astype(np.int32), j.astype(np.int32), (own[begin:end] > i))]
                        yield pa.RecordBatch.from_arrays([*arrays, *places], [*kept, "i", "j", "second"])

    kept = ["label", "width", "cell", "node", "size", "v"]
    kinds = ", ".join(f"`{n}` {t}" for n, t in homes.select(kept).dtypes)
    columns = homes.join(F.broadcast(lines), ["label", "width"], "left").select(*kept, F.col("k1").alias("draw"), "line")
    return columns.mapInArrow(spread, f"{kinds}, i int, j int, second boolean")


def _compare(units: DataFrame, grids: Grids, reach: float, threshold: float, dtype: str) -> DataFrame:
    """Of each pair of blocks, every pair of vectors once: ``node, links`` and edges ``node, other``.

    Blocks are cut into tiles along their cells, and tiles without near cells are passed by. Single precision
    finds the pairs that rounding may bring to the threshold, double precision decides.
    """
    source, size = units.sparkSession.sparkContext.broadcast(grids), TILE

    def tiles(begin: int, end: int) -> list[slice]:
        return [slice(a, min(a + size, end)) for a in range(begin, end, size)]

    def meeting(width: int, values: np.ndarray, cell: np.ndarray, cut: list[slice]) -> Callable[[slice, slice], bool]:
        """Whether vectors of two tiles may be linked."""
        if width not in source.value:
            return lambda a, b: True
        grid = source.value[width]
        seen = {}
        for at in cut:
            parts = _parts(np.arange(at.start, at.stop), len(grid[0]))
            seen[at.start] = np.any([_near_cells(grid, values[part], cell[part], reach).any(axis=0) for part in parts], axis=0)
        own = {at.start: np.unique(cell[at]) - grid[2] for at in cut}
        return lambda a, b: seen[a.start][own[b.start]].any() and seen[b.start][own[a.start]].any()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, UNIT):
            width, alone = group["width"][0].as_py(), group["i"][0] == group["j"][0]
            ids, sizes, cell = (group[c].to_numpy() for c in ("node", "size", "cell"))
            middle = len(ids) - pc.sum(group["second"]).as_py()
            left, right = tiles(0, middle), tiles(middle, len(ids))
            if not alone and not (left and right):
                continue
            values = _unpacked(group["v"], width, dtype)
            near = meeting(width, values, cell, [*left, *right])
            single = np.concatenate([_unit(part).astype(np.float32) for part in _parts(values, width)])
            least = threshold - (width + 8) * 2.0**-23
            links, edges = np.zeros(len(ids), np.int64), [np.zeros((2, 0), np.int64)]
            for a, b in ((a, b) for a in left for b in (right if not alone else left) if (not alone or a.start <= b.start) and near(a, b)):
                close = single[a] @ single[b].T >= least
                if a == b:
                    close = np.triu(close, 1)
                if not close.any():
                    continue
                x, y = np.flatnonzero(close.any(axis=1)), np.flatnonzero(close.any(axis=0))
                linked = close[np.ix_(x, y)]
                x, y = x + a.start, y + b.start
                linked &= _unit(values[x]) @ _unit(values[y]).T >= threshold
                linked &= ids[x][:, None] != ids[y][None, :]
                links[x] += linked @ sizes[y]
                links[y] += sizes[x] @ linked
                edges.append(np.stack(forest(linked, ids[x], ids[y])))
                if sum(e.shape[1] for e in edges) > 4 * len(ids):
                    edges = [np.stack(thinned(*np.concatenate(edges, axis=1)))]
            a, b = thinned(*np.concatenate(edges, axis=1))
            some = links > 0
            nodes = np.concatenate([ids[some], a])
            other = pa.array(np.concatenate([np.zeros(some.sum(), np.int64), b]), mask=np.arange(len(nodes)) < some.sum())
            count = pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64)]))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), other, count], ["node", "other", "links"])

    return units.mapInArrow(compare, "node long, other long, links long")


def near_duplicates(
    embeddings: DataFrame,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = 0.93,
    cell_size: int = CELL,
) -> DataFrame:
    """``<id>, n_links, component_id, kept`` for each row: pairs of equal label with a cosine of ``threshold`` or more are linked.

    ``component_id`` is the least id that links reach, ``kept`` says that it is the row's own.
    Vectors of different lengths do not link. A vector that is null, zero or that holds a null or
    non-finite component links with nothing, and so does one with a null label or id; its
    component is itself. Rows with one id are one vector; they do not count as links of each
    other. An empty table gives an empty result; other columns are ignored.

    Equal vectors of a label form classes, so copies are compared once. A sample of about
    ``SAMPLE`` classes, or ``SAMPLE_VALUES`` components, gives the centroids of each length. Each vector is at home in its
    nearest centroid's cell, and near to the cells whose border is no farther than two linked vectors can be apart.
    So each of a linked pair is near to the other's cell. The vectors of a label lie in the order of their cells,
    in blocks of ``BLOCK`` vectors or ``BLOCK_VALUES`` components; a vector goes to its block's meetings with the blocks of its
    near cells. A meeting is compared by matrix products of ``TILE`` vectors, each pair of vectors once in all.
    """
    spark = embeddings.sparkSession
    bound_batches(spark)
    single = embeddings.select(F.col(vector)).dtypes[0][1] == "array<float>"  # as they are, at half the bytes
    kind, dtype = ("float", "float32") if single else ("double", "float64")
    source = embeddings.select(F.col(id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast(f"array<{kind}>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False))
    hashes = [F.xxhash64("label", "v"), F.xxhash64(F.lit(17), "v", "label")]
    source = source.select("id", "label", "v", usable.alias("usable"), *(F.when(usable, h).alias(k) for h, k in zip(hashes, ("k1", "k2"))))
    keys = ["k1", "k2"]
    found = [F.min("id").alias("node"), F.count_distinct("id").alias("size"), F.count("*").alias("group_size"), F.first("label").alias("label"), F.first("v").alias("v")]
    classes = stage(source.filter("usable").groupBy(*keys).agg(*found), "vector-classes")
    total, rows, values = classes.agg(F.count("*"), F.coalesce(F.sum("group_size"), F.lit(0)), F.coalesce(F.sum(F.size("v")), F.lit(0))).first()

    share = min(1.0, SAMPLE / max(total, 1), SAMPLE_VALUES / max(values, 1))
    drawn = classes.filter(F.pmod("k2", F.lit(1 << 20)) < share * (1 << 20)).select("v").toArrow()
    grids, reach = _grids(drawn, 1 / share / cell_size), float(np.sqrt(2 - 2 * threshold)) + 1e-9
    homes = stage(_homes(classes, grids, dtype), "vector-homes")
    unstage(classes)

    units = _units(homes, grids, reach, dtype).repartition(*UNIT).sortWithinPartitions(*UNIT, "second", "cell")
    compared = stage(_compare(units, grids, reach, threshold, dtype), "compared-vectors")
    counts = compared.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(compared.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    summary = (
        homes.join(counts.hint("merge"), "node", "left")
        .join(reached.withColumnRenamed("id", "node").hint("merge"), "node", "left")
        .select(*keys, "group_size", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    )
    summary = stage(summary, "vector-links")
    unstage(homes)
    unstage(compared)
    linked = attach(source.filter("usable").select("id", *keys), summary, keys, hot_classes(summary, rows)).select("id", "n_links", "component_id")
    alone = source.filter("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    result = linked.unionByName(alone)
    return result.select(F.col("id").alias(id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
