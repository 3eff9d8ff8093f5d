"""Lookups that hold up when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideload.operators.merge import same_key
from tideload.session import broadcast_limit, plan_bytes, splits_skewed_joins

HOT_SHARE = 0.001


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate is within the session's broadcast limit."""
    return plan_bytes(df) <= broadcast_limit(df)


def hot_keys(fact: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys holding more than ``share`` of all rows: at most ``1 / share`` of them."""
    counts = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    return counts.where(F.col("_rows") > total * share).select(*keys)


def lookup_join(fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``fact`` to a table that is unique on ``keys`` (``inner`` or ``left``).

    Catalyst broadcasts a table whose size estimate is within the session's limit.
    Beyond it the session splits hot partitions at run time; where that is switched
    off, the hot keys are split off here.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if splits_skewed_joins(fact.sparkSession) or fits_broadcast(dim):
        return fact.join(dim, list(keys), how)
    return split_hot_join(fact, dim, keys, how)


def split_hot_join(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner", share: float = HOT_SHARE
) -> DataFrame:
    """The join of :func:`lookup_join` with hot keys kept out of the exchange.

    Rows of ordinary keys meet the table by exchange. Rows of hot keys meet their few
    table rows by broadcast: there are at most ``1 / share`` hot keys, so the
    broadcasts are small whatever the data.
    """
    keys = list(keys)
    hot = F.broadcast(hot_keys(fact, keys, share))
    on_hot = same_key("l", "r", keys)
    hot_rows = fact.alias("l").join(hot.alias("r"), on_hot, "left_semi")
    cold_rows = fact.alias("l").join(hot.alias("r"), on_hot, "left_anti")
    hot_dim = dim.alias("l").join(hot.alias("r"), on_hot, "left_semi")
    by_broadcast = hot_rows.join(F.broadcast(hot_dim), keys, how)
    by_exchange = cold_rows.join(dim, keys, how)
    return by_exchange.unionByName(by_broadcast)


def fanout_join(
    fact: DataFrame, many: DataFrame, keys: Sequence[str], how: str = "inner", pieces: int = 16
) -> DataFrame:
    """Join to a table that may hold a key more than once (``inner`` or ``left``).

    The session splits hot partitions at run time. Where that is switched off, the fact rows
    of hot keys are dealt to ``pieces`` parts by a hash of the row, and the rows of ``many``
    with such a key go to every part; nothing but the keys themselves, at most
    ``1 / HOT_SHARE`` of them, is broadcast.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    keys = list(keys)
    if splits_skewed_joins(fact.sparkSession) or fits_broadcast(many):
        return fact.join(many, keys, how)
    hot = hot_keys(fact, keys).withColumn("_hot", F.lit(True))
    part = F.pmod(F.xxhash64(*fact.columns), F.lit(pieces)).cast("int")
    dealt = _marked(fact, hot, keys).withColumn("_part", F.when(F.col("_hot"), part).otherwise(0)).drop("_hot")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(F.lit(0)))
    copied = _marked(many, hot, keys).withColumn("_part", F.explode(every)).drop("_hot")
    return dealt.join(copied, [*keys, "_part"], how).drop("_part")


def _marked(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with ``_hot`` on the rows of hot keys."""
    return df.join(F.broadcast(hot), list(keys), "left").select(*df.columns, "_hot")


def attach_one_row(df: DataFrame, one_row: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Put the values of a one-row table on every row (``new name -> its column``).

    Read as a scalar subquery: more than one row is an error, none gives no rows.
    """
    values = one_row.select(F.struct(*[F.col(src).alias(new) for new, src in columns.items()])).scalar()
    return (
        df.withColumn("_row", values)
        .where(F.col("_row").isNotNull())
        .select(*df.columns, *[F.col(f"_row.{new}").alias(new) for new in columns])
    )


def choose_key(*cases: tuple[Column, Column]) -> Column:
    """One join key out of several guarded ones.

    ``(k = a AND p) OR (k = b AND NOT p)`` has no equi-join; ``k = CASE …`` has one.
    """
    head, *rest = cases
    key = F.when(head[0], head[1])
    for guard, value in rest:
        key = key.when(guard, value)
    return key


def expand_up_to(df: DataFrame, steps: DataFrame, number: str, last: DataFrame) -> DataFrame:
    """Repeat every row once per step whose number is at most the one in ``last``.

    The inequality is settled on the steps alone: the list of the numbers that exist, as long
    as the rows each record becomes, is put on every row and met by an equi-join, without a
    nested loop.
    """
    reached = steps.where(F.col(number) <= last.scalar())
    numbers = reached.agg(F.array_sort(F.collect_set(number))).scalar()
    numbered = df.withColumn(number, F.explode(numbers))
    return numbered.join(steps, number)


def without_match(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with no partner in ``other``.

    Repeated keys of ``other`` are dropped before its exchange, so a hot one costs nothing.
    """
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def with_match(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with a partner in ``other``, each once."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_semi")


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """``key NOT IN (SELECT other_key …)`` with SQL's NULL rules.

    A NULL on the other side empties the result, and a NULL key is only kept when the
    other side is empty. Both facts are scalars, so the rest is an ordinary anti join
    on equal keys, which does not depend on the other side fitting a broadcast.
    """
    facts = other.agg(
        F.count(F.lit(1)).alias("_rows"), F.count(F.col(other_key)).alias("_values")
    ).select(F.struct("_rows", "_values")).scalar()
    rows, values = facts.getField("_rows"), facts.getField("_values")
    decided = (rows == 0) | ((rows == values) & F.col(key).isNotNull())
    known = other.where(F.col(other_key).isNotNull()).select(F.col(other_key).alias("_known")).distinct()
    return df.where(decided).join(known, F.col(key) == F.col("_known"), "left_anti")
