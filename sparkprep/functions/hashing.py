"""Reproducible randomness: every draw is a function of a row's identity and a seed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def row_key(*identity: Column | str, seed: int | str = 0) -> Column:
    """A uniform 128-bit key (32 hex digits) for a row.

    It depends on nothing but the identity and the seed, so retries, other partition
    counts and other cluster sizes give the same draws.
    """
    return F.md5(F.concat_ws("#", *identity, F.lit(str(seed))))


def pick(key: Column, choices: int) -> Column:
    """An int in ``[0, choices)`` from the last digits of ``key``.

    Ordering by a key uses its first digits, so picks and order are independent.
    """
    return (F.conv(F.substring(key, 25, 8), 16, 10).cast("bigint") % choices).cast("int")


def fraction(key: Column) -> Column:
    """A double in ``[0, 1)`` from the first 8 digits of ``key``."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / float(16**8)
