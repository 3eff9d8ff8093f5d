"""One row per key: the newest by a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``newest_first``.

    Spark keeps one row per key in every map task before the exchange, so a key
    that holds a large share of all rows sends one row per task, not the group.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def latest_by_aggregate(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The same rows as :func:`latest_per_key` (all orders descending) as an aggregate.

    The partial step leaves one row per key and map task before the exchange too.
    """
    payload = [c for c in df.columns if c not in keys]
    newest = F.max_by(
        F.struct(*payload),
        F.struct(*[F.col(c) for c in order_by]),
    )
    picked = df.groupBy(*keys).agg(newest.alias("_newest"))
    return picked.select(*keys, "_newest.*").select(*df.columns)
