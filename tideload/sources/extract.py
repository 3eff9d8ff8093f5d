"""Extracts from source databases and the landing of their rows as files."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Reader = Callable[[str], DataFrame]


def jdbc_reader(
    spark: SparkSession,
    options: Mapping[str, str],
    bounds: Mapping[str, Mapping] | None = None,
    small: Collection[str] = (),
    predicates: Mapping[str, Sequence[str]] | None = None,
) -> Reader:
    """A table reader over JDBC. All connection settings come from the caller.

    ``bounds`` gives per table the ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` for a parallel read, ``predicates`` the conditions of :func:`balanced_predicates`, one
    a task. A table with neither would be read by one task and is refused, unless the caller names it in ``small``.
    """

    def read(table: str) -> DataFrame:
        split = (bounds or {}).get(table, {})
        if predicates and table in predicates:
            others = {k: v for k, v in options.items() if k != "url"}
            return spark.read.jdbc(options["url"], table, predicates=list(predicates[table]), properties=others)
        if not split and table not in small:
            raise ValueError(f"{table} has no bounds: one task would read all of it; name it as small if it is")
        return spark.read.format("jdbc").options(**options, **split, dbtable=table).load()

    return read


def parquet_reader(spark: SparkSession, folder: str) -> Reader:
    """A table reader over ``<folder>/<table>.parquet``."""
    return lambda table: spark.read.parquet(f"{folder}/{table}.parquet")


def extract_full(reader: Reader, table: str) -> DataFrame:
    """The whole table."""
    return reader(table)


def _literal(value) -> str:
    """A key value in SQL that Spark and the source's database both read."""
    if isinstance(value, bool) or value is None:
        raise TypeError("keys are numbers, dates, times or text")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    return "'" + str(value).replace("'", "''") + "'"


def balanced_predicates(
    sample: DataFrame, key: str, parts: int, spread: str | None = None, sample_rows: int = 200_000
) -> list[str]:
    """Conditions on ``key`` that deal a table to about ``parts`` reads of equal depth, none beyond its share.

    The bounds are quantiles of a histogram of the keys of ``sample``, a sample of the source's rows, of
    which at most ``sample_rows`` are counted. A key with more than its share of rows has a read of
    its own, or several if ``spread`` is given: an expression of the source that deals its rows, a non-negative
    whole number such as a second key or a hash. Rows with a NULL key have a read of their own. Every
    row meets one condition, whether the sample has seen its key or not.
    """
    taken = sample.where(F.col(key).isNotNull()).select(key)
    total = taken.count()
    if total > sample_rows:
        taken = taken.sample(sample_rows / total, seed=1)
    # At most about sample_rows rows.
    histogram = [(r[0], r["n"]) for r in taken.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(key).collect()]
    share = max(1.0, sum(n for _, n in histogram) / max(parts, 1))
    predicates, low, held = [f"{key} IS NULL"], "", 0

    def upto(high: str) -> None:
        """The range from the last bound to this one; unseen keys may lie in it even if no seen one does."""
        predicates.append(" AND ".join(side for side in (low, high) if side) or f"{key} IS NOT NULL")

    for value, n in histogram:
        text = _literal(value)
        if n > share:
            upto(f"{key} < {text}")
            pieces = -(-n // int(share)) if spread else 1
            predicates += [f"{key} = {text}" + (f" AND ({spread}) % {pieces} = {i}" if spread else "") for i in range(pieces)]
            low, held = f"{key} > {text}", 0
        elif held and held + n > share:
            upto(f"{key} < {text}")
            low, held = f"{key} >= {text}", n
        else:
            held += n
    upto("")
    return predicates


def read_split(df: DataFrame, predicates: Sequence[str], number: str | None = None) -> DataFrame:
    """The rows of ``df`` read condition by condition, as a source's reader with predicates does; ``number`` names the read."""
    parts = [df.where(p) for p in predicates]
    if number:
        parts = [part.withColumn(number, F.lit(i)) for i, part in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def watermark_of(control: DataFrame, table: str) -> Column:
    """The last run time of ``table`` as a scalar subquery; more than one row is an error."""
    return control.where(F.col("table_name") == table).select("run_time").scalar()


def read_watermark(control: DataFrame, table: str):
    """The last run time of ``table`` as a value, None if there is none yet."""
    rows = control.where(F.col("table_name") == table).select("run_time").limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"more than one watermark for {table}")
    return rows[0].run_time if rows else None


def extract_since(df: DataFrame, ts: str, control: DataFrame, table: str, pushed: bool = True) -> DataFrame:
    """Rows changed strictly after the table's watermark; none if there is no watermark.

    ``pushed`` reads the one control value first, so that the bound is a literal which
    reaches the Parquet or JDBC scan. Otherwise it stays a scalar subquery.
    """
    if not pushed:
        return df.where(F.col(ts) > watermark_of(control, table))
    bound = read_watermark(control, table)
    if bound is None:
        return df.where(F.lit(False))
    return df.where(F.col(ts) > F.lit(bound).cast("timestamp_ntz"))


def land(df: DataFrame, folder: str, mode: str = "append", fmt: str = "parquet") -> str:
    """Write an extract to its landing folder: ``overwrite`` for a full load, ``append`` for changes.

    Spark gives every file a unique name, so repeated extracts do not collide.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    df.write.mode(mode).format(fmt).save(folder)
    return folder
