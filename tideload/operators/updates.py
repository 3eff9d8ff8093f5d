"""UPDATE statements as rewrites: each returns the whole table with changed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideload.operators.joins import lookup_join


def update_from(
    target: DataFrame, source: DataFrame, keys: Sequence[str], assign: Mapping[str, str]
) -> DataFrame:
    """Set ``target`` columns from the matching ``source`` row (``assign``: target -> source column).

    ``source`` is unique on ``keys``. A matched NULL overwrites; an unmatched row keeps its values.
    """
    values = source.select(*keys, F.struct(*[F.col(s).alias(t) for t, s in assign.items()]).alias("_new"))
    joined = lookup_join(target, values, keys, "left")
    matched = F.col("_new").isNotNull()
    return joined.select(
        *[
            F.when(matched, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in assign else F.col(c)
            for c in target.columns
        ]
    )


def update_where_in(
    target: DataFrame, hits: DataFrame, keys: Sequence[str], assign: Mapping[str, Column]
) -> DataFrame:
    """Set columns of the rows whose key occurs in ``hits``; repeats in ``hits`` do no harm."""
    marks = hits.select(*keys).distinct().withColumn("_hit", F.lit(True))
    joined = lookup_join(target, marks, keys, "left")
    return update_when(joined, F.col("_hit").isNotNull(), assign).drop("_hit")


def update_when(target: DataFrame, condition: Column, assign: Mapping[str, Column]) -> DataFrame:
    """Set columns where ``condition`` holds."""
    return target.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in assign.items()})
