"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideload.session import prepare

# Prefix of the operators' inner columns, so that they meet no column of the caller.
OWN = "__llm_"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark from whatever store ``folder`` names."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def filled(column: Column) -> Column:
    """Text with null as empty text."""
    return F.coalesce(column.cast("string"), F.lit(""))


def quoted(name: str) -> Column:
    """The column of this very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_results(df: DataFrame, **columns: Column) -> DataFrame:
    """Add result columns; a column of the caller with the same name is replaced."""
    return df.withColumns(columns)
