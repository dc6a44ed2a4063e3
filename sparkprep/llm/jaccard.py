"""Near-duplicate texts: an n-gram Jaccard join by a MinHash LSH forest with exact verification.

Each tree of the forest sorts the documents by a signature of its own. Documents meet where
they share a prefix of it. Prefixes are shortened from the full depth until a pair at the
threshold meets in some tree with the target probability; what meets only further down in
the trie meets there as well. Sketches of all hash values then drop pairs that are certain to
be far below the threshold, and what is left is compared exactly, set against set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.llm.batches import LOWER, mix, signed, slices, utf8, window_hashes, word_hashes, words
from sparkprep.llm.graph import components, forest, grouped
from sparkprep.llm.session import bound_batches, release_shuffles
from sparkprep.llm.spread import attach, hot_classes
from sparkprep.plans.staging import stage, unstage

TREES = 24
DEPTH = 8
RECALL = 0.9999
BLOCK = 1_024
BLOCK_SHINGLES = 400_000
COLUMNS = 8_192


def prefix_depth(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix with which a pair at the threshold meets in some tree with probability ``recall``."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text as sorted hashes, and the bounds of each text's.

    Words are lower-cased in A-Z. A text of fewer than ``size`` words, but one at least, has one
    shingle: all its words.
    """
    raw = LOWER[raw]
    starts, ends, doc = words(raw, offsets)
    hashes = word_hashes(raw, starts, ends)
    count = np.bincount(doc, minlength=len(offsets) - 1)
    base = np.concatenate([[0], np.cumsum(count)])
    found = window_hashes(hashes, size)
    whole = np.flatnonzero(doc[: len(found)] == doc[size - 1 :]) if len(found) else np.zeros(0, int)
    values, owner = [found[whole]], [doc[whole]]
    for n in range(1, size):  # short texts
        of = np.flatnonzero(count == n)
        if len(of):
            values.append(window_hashes(hashes, n)[base[of]] + np.uint64(n))
            owner.append(of)
    values, owner = np.concatenate(values), np.concatenate(owner)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.searchsorted(owner[new], np.arange(len(offsets)))


def signatures(values: np.ndarray, bounds: np.ndarray, width: int, seed: int = 3) -> np.ndarray:
    """``width`` MinHash values of 32 bits for each text that has shingles; the bounds must be rising."""
    random = np.random.default_rng(seed)
    factors, shifts = random.integers(0, 2**64, (2, width), dtype=np.uint64)
    found = np.empty((width, len(bounds) - 1), np.uint32)
    for begin in range(0, len(bounds) - 1, 64):  # few enough to stay in the processor's cache
        end = min(begin + 64, len(bounds) - 1)
        own = values[bounds[begin] : bounds[end]]
        for k in range(width):
            hashed = ((own * (factors[k] | np.uint64(1)) + shifts[k]) >> np.uint64(32)).astype(np.uint32)
            found[k, begin:end] = np.minimum.reduceat(hashed, bounds[begin:end] - bounds[begin])
    return found.T


SET = ["n", "s1", "s2"]
PROFILE = ["k", "p1", "p2"]


def _sign(documents: DataFrame, size: int, depth: int) -> DataFrame:
    """``id`` and ``digest``, the size and fingerprint of the shingle set, a key per tree and a sketch, for texts with words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, bounds = shingles(*utf8(batch.column("text")), size)
            some = np.flatnonzero(np.diff(bounds))
            bounds = np.append(bounds[:-1][some], len(values))
            n = np.diff(bounds)
            sums = [np.add.reduceat(mix(values + np.uint64(c)), bounds[:-1]) if len(some) else np.zeros(0, np.uint64) for c in (11, 77)]
            minima = signatures(values, bounds, TREES * depth)
            trees = minima.reshape(len(some), TREES, depth).astype(np.uint64)
            keys = np.tile(np.arange(1, TREES + 1, dtype=np.uint64), (len(some), 1))
            for k in range(depth):
                keys = mix(keys + trees[:, :, k])
            sketch = pa.array([row.tobytes() for row in minima.astype(np.uint8)], pa.binary())
            lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, TREES, dtype=np.int32), pa.array(signed(keys.ravel())))
            arrays = [*(batch.column(c).take(pa.array(some)) for c in ("id", "digest")), pa.array(n), *(pa.array(signed(s)) for s in sums), lists, sketch]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "digest", *SET, "keys", "sketch"])

    return documents.mapInArrow(sign, "id long, digest string, n long, s1 long, s2 long, keys array<long>, sketch binary")


def _units(rows: DataFrame, parts: Column, by: list) -> DataFrame:
    """Rows of groups cut into ``parts`` blocks by a hash of ``by``, once for each pair of blocks ``i <= j`` that has to be compared."""
    own = F.pmod(F.xxhash64(*by), parts).cast("int")
    cut = rows.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return cut.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


def _candidates(rows: DataFrame, threshold: float, width: int) -> DataFrame:
    """Edges ``a, b`` that connect the documents of each bucket whose sketches do not rule out the threshold."""
    least = width * threshold - 6 * np.sqrt(width * threshold * (1 - threshold))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["bucket", "i", "j"]):
            ids = group["node"].to_numpy()
            sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(len(ids), width)
            left, right = group["block"].to_numpy() == group["i"][0].as_py(), group["block"].to_numpy() == group["j"][0].as_py()
            equal = np.zeros((left.sum(), right.sum()), np.int16)
            for k in range(width):
                equal += sketch[left, k][:, None] == sketch[right, k][None, :]
            a, b = forest(equal >= least, ids[left], ids[right])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return rows.mapInArrow(compare, "a long, b long")


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each of the sorted sets ``left`` shares with each of ``right``."""
    if len(left) * len(right) <= 64:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left], np.int64).reshape(len(left), len(right))
    total = np.zeros((len(left), len(right)), np.float32)
    values, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [*map(len, left), *map(len, right)])
    shared = np.bincount(place, minlength=len(values)) > 1
    place, owner = (np.cumsum(shared) - 1)[place][shared[place]], owner[shared[place]]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    for begin in range(0, int(shared.sum()), COLUMNS):  # an element is a column of a 0/1 matrix
        a, b = np.searchsorted(place, [begin, begin + COLUMNS])
        matrix = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        matrix[owner[a:b], place[a:b] - begin] = 1
        total += matrix[: len(left)] @ matrix[len(left) :].T
    return np.rint(total).astype(np.int64)


def _either(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Links of sets as links of their documents, whose first sets are at ``rows`` and ``columns``."""
    for axis, starts in enumerate((rows, columns)):
        if len(starts) < linked.shape[axis]:
            linked = np.logical_or.reduceat(linked, starts, axis=axis)
    return linked


def _verified(rows: DataFrame, size: int, threshold: float) -> DataFrame:
    """Exact links in each unit: ``node, links`` (in documents) and edges ``node, other`` that connect them.

    A row is one set of a document. All sets of a document lie in one block, but those of a
    ``wide`` one, for which more than one unit may find a link: it comes as ``node, other, links``
    (the documents that ``other`` stands for) with the mark ``pair``, and is in no count.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["bucket", "i", "j"]):
            ids, sizes, wide = (group[c].to_numpy() for c in ("node", "size", "wide"))
            sets: list[np.ndarray] = []
            for part in slices(iter(group.select(["text"]).to_batches())):
                values, bounds = shingles(*utf8(part.column(0)), size)
                sets += [values[a:b] for a, b in zip(bounds, bounds[1:])]
            i, j = group["i"][0].as_py(), group["j"][0].as_py()
            block = group["block"].to_numpy()
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            both = common([sets[k] for k in left], [sets[k] for k in right])
            n = np.array([*map(len, sets)])
            union = n[left][:, None] + n[right][None, :] - both
            first = [np.unique(ids[side], return_index=True)[1] for side in (left, right)]
            linked = _either(both >= threshold * union, *first)
            left, right = left[first[0]], right[first[1]]
            linked &= ids[left][:, None] != ids[right][None, :]
            apart = linked & (wide[left][:, None] | wide[right][None, :])
            counted = linked & ~apart
            links = np.zeros(len(ids), np.int64)
            links[left] += counted @ sizes[right]
            if i != j:
                links[right] += counted.T @ sizes[left]
            a, b = forest(linked, ids[left], ids[right])
            some = links > 0
            u, v = np.nonzero(apart)
            u, v = np.concatenate([left[u], right[v]]), np.concatenate([right[v], left[u]])
            nodes = np.concatenate([ids[some], a, ids[u]])
            at = np.arange(len(nodes))
            other = pa.array(np.concatenate([np.zeros(some.sum(), np.int64), b, ids[v]]), mask=at < some.sum())
            count = pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64), sizes[v]]))
            pair = pa.array(at >= some.sum() + len(a))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), other, count, pair], ["node", "other", "links", "pair"])

    return rows.mapInArrow(compare, "node long, other long, links long, pair boolean")


def similar_documents(documents: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8) -> DataFrame:
    """``<id>, class_id, n_links, component_id, kept`` for each row.

    Documents are linked when the Jaccard similarity of their sets of shingles, ``size``
    consecutive words of the whole text with A-Z lower-cased, is ``threshold`` or more.
    ``class_id`` is the least id with the same set, ``n_links`` the number of other documents
    linked directly, ``component_id`` the least id that links reach, and ``kept`` says that it is
    the row's own. A text of fewer words than ``size`` has all its words as its one shingle; a
    null, empty or blank text has none and links with nothing, and so does a row with a null
    id. Rows with one id are one document, however often they come: with different texts, it has
    a set for each, is linked where one of them is similar enough, and all its rows have the same
    ``n_links`` and ``component_id``. An empty table gives an empty result; other columns are ignored.

    Documents with the same set, or the same sets, form a class of which one member goes on, with
    one text for each set. Buckets with the same members are compared once. Large buckets and groups are cut into blocks, whose pairs
    are compared by tasks of their own; within a task comparisons are matrix operations, and
    only counts and as many edges as there are documents come out.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    depth = prefix_depth(threshold)
    source = documents.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    known = source.filter("id IS NOT NULL").withColumn("digest", F.md5("text"))
    signed_rows = stage(_sign(known, size, depth), "signatures")
    own = stage(signed_rows.groupBy("id", *SET).agg(F.count("*").alias("group_size")), "own-sets")
    profile = [F.count("*").alias("k"), *(F.bit_xor(F.xxhash64(F.lit(i), *SET)).alias(f"p{i}") for i in (1, 2))]
    docs = stage(own.groupBy("id").agg(*profile, F.sum("n").alias("n"), F.sum("group_size").alias("group_size")), "documents")
    classes = docs.groupBy(*PROFILE).agg(F.min("id").alias("node"), F.max("n").alias("n"), F.count("*").alias("size"))
    classes = stage(classes, "set-classes")
    rows, ids = signed_rows.count(), docs.count()

    first = signed_rows.dropDuplicates(["id", *SET])
    leads = stage(first.join(classes.select(F.col("node").alias("id")).hint("merge"), "id").withColumnRenamed("id", "node"), "leads")
    member = ["node", *SET]
    keyed = leads.select(*member, F.explode("keys").alias("bucket"))
    buckets = keyed.groupBy("bucket").agg(F.count("*").alias("m"), F.sum(F.xxhash64(*member).cast("decimal(38,0)")).alias("h"), F.min("node").alias("lead"))
    buckets = buckets.filter("m > 1").groupBy("m", "h", "lead").agg(F.min("bucket").alias("bucket"))
    buckets = stage(buckets, "buckets")
    met = keyed.join(buckets.select("bucket", "m").hint("merge"), "bucket")
    met = met.join(leads.select(*member, "sketch").hint("merge"), member)
    units = _units(met, F.ceil(F.col("m") / BLOCK).cast("int"), member)
    keys = ["bucket", "i", "j"]
    edges = stage(_candidates(units.repartition(*keys).sortWithinPartitions(*keys), threshold, TREES * depth).distinct(), "candidates")
    release_shuffles(spark)

    groups = components(edges).select(F.col("id").alias("node"), F.col("component").alias("bucket"))
    members = stage(groups.join(classes.select("node", "k", "n", "size").hint("merge"), "node"), "candidate-groups")
    parts = F.greatest(F.ceil(F.sum("k") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    cuts = stage(members.groupBy("bucket").agg(parts.alias("parts")), "candidate-parts")
    wide = F.greatest(F.ceil(F.col("k") / BLOCK), F.when(F.col("k") > 1, F.ceil(F.col("n") / BLOCK_SHINGLES)).otherwise(1))
    members = members.join(cuts.hint("merge"), "bucket").withColumn("shares", wide.cast("int")).drop("k", "n")
    members = leads.select("node", "digest").join(members.hint("merge"), "node")
    texts = known.withColumnRenamed("id", "node").dropDuplicates(["node", "digest"]).join(members.hint("merge"), ["node", "digest"])
    texts = texts.withColumn("share", F.pmod(F.xxhash64("digest"), F.col("shares"))).withColumn("wide", F.col("shares") > 1).drop("digest", "shares")
    units = _units(texts, F.col("parts"), ["node", "share"]).repartition(*keys).sortWithinPartitions(*keys, "node")
    verified = stage(_verified(units, size, threshold), "verified")
    release_shuffles(spark)

    pairs = verified.filter("pair").select("node", "other", "links").distinct()
    counts = verified.filter("NOT pair").select("node", "links").unionByName(pairs.select("node", "links")).groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(verified.filter("other IS NOT NULL AND NOT pair").select(F.col("node").alias("a"), F.col("other").alias("b")))
    summary = (
        classes.join(counts.hint("merge"), "node", "left")
        .join(reached.withColumnRenamed("id", "node").hint("merge"), "node", "left")
        .select(*PROFILE, "size", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    )
    summary = stage(summary, "document-links")
    found = attach(docs.select("id", *PROFILE, "group_size"), summary, PROFILE, hot_classes(summary, ids, "size"))
    found = stage(found.select("id", "group_size", "n_links", "component_id"), "links-of-documents")
    sets = stage(own.groupBy(*SET).agg(F.min("id").alias("class_id"), F.sum("group_size").alias("group_size")), "sets")
    classed = stage(attach(signed_rows.select("id", *SET), sets, SET, hot_classes(sets, rows)).select("id", "class_id"), "classes-of-rows")
    columns = ["id", "class_id", "n_links", "component_id"]
    linked = attach(classed, found, ["id"], hot_classes(found, rows)).select(columns)
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]") | F.col("id").isNull()
    alone = source.filter(blank).select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    result = linked.unionByName(alone)
    return result.select(F.col("id").alias(id), *columns[1:], F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
