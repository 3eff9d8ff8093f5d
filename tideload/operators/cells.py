"""Keyed rows as cells of a wide-column store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideload.functions.casting import write_as_text
from tideload.functions.text import row_key

FAMILY = "CF1"
MUTATION_FIELDS = "rowkey string, family string, deleted boolean, cells array<struct<qualifier: string, value: string>>"


def to_cells(df: DataFrame, keys: Sequence[str], family: str = FAMILY) -> DataFrame:
    """``(rowkey, family, qualifier, value)``: one text cell per non-key column, in one pass.

    A NULL gives an empty cell, so that writing it over an older value clears that value.
    """
    cell = F.explode(_cells([f for f in df.schema.fields if f.name not in keys]))
    return df.select(row_key(keys).alias("rowkey"), F.lit(family).alias("family"), cell.alias("_cell")).select(
        "rowkey", "family", "_cell.qualifier", "_cell.value"
    )


def _cells(fields: Sequence[T.StructField]) -> Column:
    """An array of the fields as cells."""
    return F.array(
        *[
            F.struct(
                F.lit(f.name).alias("qualifier"),
                F.coalesce(write_as_text(F.col(f.name), f.dataType), F.lit("")).alias("value"),
            )
            for f in fields
        ]
    )


def to_mutations(df: DataFrame, keys: Sequence[str], deleted: Column | None = None, family: str = FAMILY) -> DataFrame:
    """``(rowkey, family, deleted, cells)``: one mutation per row, which puts all its cells or deletes the key.

    ``df`` holds a key once: reduce changes by ``compact_changes`` first. Rows whose key has a NULL part have no row key.
    """
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    cells = _cells([f for f in df.schema.fields if f.name not in keys])
    return df.select(
        row_key(keys).alias("rowkey"),
        F.lit(family).alias("family"),
        gone.alias("deleted"),
        F.when(~gone, cells).otherwise(F.array().cast("array<struct<qualifier:string,value:string>>")).alias("cells"),
    )


def encode_cells(cells: DataFrame) -> DataFrame:
    """Cells as UTF-8 bytes, the form a wide-column store takes."""
    return cells.select(*[F.encode(c, "UTF-8").alias(c) for c in cells.columns])


def from_cells(cells: DataFrame, qualifiers: Sequence[str]) -> DataFrame:
    """Cells turned back into one row of text columns per row key."""
    picks = [F.max(F.when(F.col("qualifier") == q, F.col("value"))).alias(q) for q in qualifiers]
    return cells.groupBy("rowkey").agg(*picks)
