"""Constant rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def inline_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few constant rows as literals of the plan, so that Catalyst knows how small they are."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, row, strict=True)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
