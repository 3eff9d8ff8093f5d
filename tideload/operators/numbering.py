"""Dense numbers over a total order without pulling the table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideload.session import staged

# monotonically_increasing_id keeps the partition in the bits above this one.
_ROW_BITS = 33


def dense_number(
    df: DataFrame, order_by: Sequence[str], name: str = "number", start: Column | int = 1
) -> DataFrame:
    """Add ``start``, ``start + 1``, … in the order of ``order_by``, which must identify a row.

    Rows are range-partitioned and sorted, and each gets its position within its
    partition; then the partition sizes (one row each) are summed up into offsets.
    The placed rows are written once, because range bounds are sampled and a
    recomputation could place rows differently from the sizes already counted.
    """
    placed = (
        df.repartitionByRange(*[F.col(c).asc() for c in order_by])
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = staged(placed, "numbered")
    part = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    first = start if isinstance(start, Column) else F.lit(start)
    position = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.withColumn("_part", part)
        # One row per partition of the staged data.
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (first + F.col("_offset") + position).cast("bigint").alias(name))
    )


def with_surrogate(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Add a generated key: dense, from 1."""
    return dense_number(df, order_by, name, 1).select(name, *df.columns)


def with_load_time(df: DataFrame, as_of: Column | None = None, zone: str = "UTC", name: str = "lastmodifieddate") -> DataFrame:
    """Add the load time as wall-clock time of ``zone``; the current instant by default."""
    if as_of is None:
        as_of = F.convert_timezone(None, F.lit(zone), F.current_timestamp().cast("timestamp_ntz"))
    else:
        as_of = F.convert_timezone(F.lit("UTC"), F.lit(zone), as_of)
    return df.withColumn(name, as_of)
