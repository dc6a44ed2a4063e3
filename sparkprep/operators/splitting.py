"""Train/validation/test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkprep.functions.hashing import fraction, row_key

SPLITS = ("train", "val", "test")
_KEY, _PREFIX_DIGITS = "_split_key", 4


def split_key(*identity: Column | str, seed: int = 0) -> Column:
    return row_key(*identity, F.lit("split"), seed=seed)


def cutoff_keys(keys: DataFrame, targets: list[tuple[str, Column]]) -> DataFrame:
    """The key at each target rank, as one row with one string column per target.

    ``keys`` has one column of uniform hex keys. Each target is a name and a rank
    computed from the row count ``total``. An empty string stands for rank 0.

    Finding a few order statistics needs no sort: keys are counted by their first
    digits (65,536 counters at most, summed before the shuffle), which tells the one
    group that holds a target rank. Only that group, 1/65,536 of the keys, is ranked.
    """
    prefixed = keys.select(
        F.col(_KEY), F.substring(_KEY, 1, _PREFIX_DIGITS).alias("prefix")
    )
    counts = prefixed.groupBy("prefix").agg(F.count(F.lit(1)).alias("rows"))
    running = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("prefix").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    groups = counts.withColumn("upto", F.sum("rows").over(running)).withColumn(
        "total", F.sum("rows").over(everything)
    )
    wanted = F.explode(
        F.array(*(F.struct(F.lit(n).alias("name"), r.alias("rank")) for n, r in targets))
    )
    edges = (
        groups.select("prefix", "rows", "upto", wanted.alias("target"))
        .select(
            "prefix",
            F.col("target.name").alias("name"),
            (F.col("target.rank") - (F.col("upto") - F.col("rows"))).alias("rank"),
            "rows",
        )
        .filter(F.col("rank").between(1, F.col("rows")))
        .drop("rows")
    )
    # At most one edge per target, so the broadcast is a handful of rows at any scale.
    near = prefixed.join(F.broadcast(edges), "prefix").groupBy("name", "rank", _KEY).count()
    in_order = Window.partitionBy("name").orderBy(_KEY).rowsBetween(Window.unboundedPreceding, 0)
    reached = near.withColumn("upto", F.sum("count").over(in_order)).filter(
        F.col("upto") >= F.col("rank")
    )
    return reached.agg(
        *(
            F.coalesce(F.min(F.when(F.col("name") == n, F.col(_KEY))), F.lit("")).alias(n)
            for n, _ in targets
        )
    )


def split_exact(
    examples: DataFrame,
    identity: list[str],
    train_ratio: float = 0.8,
    val_ratio: float = 0.1,
    seed: int = 0,
) -> DataFrame:
    """Add ``split``: exactly ``floor(n*train)`` and ``floor(n*val)`` rows, the rest test.

    ``identity`` names the columns that identify a row; rows that share them stay in the
    same split. The sizes are exact only if no two rows share an identity: this is a
    precondition. Rows are never moved: two keys are found first and then every row is
    compared with them. The input is read three times, so pass a stored table
    (:func:`sparkprep.plans.staging.stage`) if computing it is costly.
    """
    total = F.col("total").cast("double")
    train = F.floor(total * train_ratio)
    targets = [("train", train), ("val", train + F.floor(total * val_ratio))]
    keyed = examples.withColumn(_KEY, split_key(*identity, seed=seed))
    cut = cutoff_keys(keyed.select(_KEY), targets).select(F.struct("train", "val")).scalar()
    return (
        keyed.withColumn("_cut", cut)
        .withColumn(
            "split",
            F.when(F.col(_KEY) <= F.col("_cut.train"), "train")
            .when(F.col(_KEY) <= F.col("_cut.val"), "val")
            .otherwise("test"),
        )
        .drop(_KEY, "_cut")
    )


def split_hash(
    examples: DataFrame,
    identity: list[str],
    train_ratio: float = 0.8,
    val_ratio: float = 0.1,
    seed: int = 0,
) -> DataFrame:
    """Add ``split`` from the key alone: sizes are approximate, one pass, no counting.

    A row keeps its split when other rows come and go.
    """
    at = fraction(split_key(*identity, seed=seed))
    return examples.withColumn(
        "split",
        F.when(at < train_ratio, "train").when(at < train_ratio + val_ratio, "val").otherwise("test"),
    )


def holdout(
    examples: DataFrame, identity: list[str], ratio: float = 0.1, seed: int = 0
) -> DataFrame:
    """Move ``ceil(n*ratio)`` training rows to ``val`` if there is no ``val`` row."""
    val_rows = examples.filter(F.col("split") == "val").limit(1).agg(F.count(F.lit(1)))
    keyed = examples.withColumn(_KEY, split_key(*identity, F.lit("holdout"), seed=seed))
    total = F.col("total").cast("double")
    kept = total.cast("bigint") - F.ceil(total * ratio)
    cut = cutoff_keys(
        keyed.filter(F.col("split") == "train").select(_KEY), [("train", kept)]
    ).scalar()
    moved = (F.col("split") == "train") & (F.col(_KEY) > cut) & (val_rows.scalar() == 0)
    return keyed.withColumn("split", F.when(moved, "val").otherwise(F.col("split"))).drop(_KEY)


def split_counts(examples: DataFrame) -> DataFrame:
    """``split, count`` for all three splits, 0 where a split has no rows."""
    per_split = examples.agg(
        *(F.count(F.when(F.col("split") == s, 1)).alias(s) for s in SPLITS)
    )
    return per_split.select(
        F.inline(
            F.array(*(F.struct(F.lit(s).alias("split"), F.col(s).alias("count")) for s in SPLITS))
        )
    )
