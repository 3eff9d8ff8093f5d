"""Repeatable random picks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shuffle_order(key: str, seed: int) -> Column:
    """A fixed pseudo-random order of rows."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))


def sample_top(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows picked at random; the same pick for the same seed."""
    return df.orderBy(shuffle_order(key, seed), key).limit(n)


def sample_branches(
    df: DataFrame, branches: Sequence[tuple[Column, int]], key: str, n: int, seed: int = 42
) -> DataFrame:
    """A pick per branch, united without repeats, then a pick of ``n`` from those."""
    picks = [sample_top(df.where(condition), key, size, seed) for condition, size in branches]
    united = reduce(lambda a, b: a.unionByName(b), picks).distinct()
    return sample_top(united, key, n, seed)
