"""Row-count audit and load watermarks as append-only tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideload.operators.latest import latest_per_key

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("tablename", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("run_time", T.TimestampNTZType()),
    ]
)


def count_rows(tables: Mapping[str, DataFrame], as_of: Column | None = None) -> DataFrame:
    """One ``(tablename, count, run_time)`` row per table."""
    now = as_of if as_of is not None else F.current_timestamp().cast("timestamp_ntz")
    counts = [
        df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("tablename"), "count", now.alias("run_time"))
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def record_counts(counts: DataFrame, path: str) -> None:
    """Append counts to the audit; the newest row of a table is the valid one."""
    counts.select(*AUDIT_SCHEMA.names).write.mode("append").parquet(path)


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest count per table."""
    audit = spark.read.schema(AUDIT_SCHEMA).parquet(path)
    newest = latest_per_key(audit, ["tablename"], [F.col("run_time").desc(), F.col("count").desc()])
    return newest.select("tablename", "count")


def count_mismatches(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Tables whose two counts differ, or that only one side knows."""
    both = expected.select("tablename", F.col("count").alias("expected")).join(
        actual.select("tablename", F.col("count").alias("actual")), "tablename", "full"
    )
    return both.where(~F.col("expected").eqNullSafe(F.col("actual")))


def init_watermark(control: DataFrame, table: str, run_time: Column) -> DataFrame:
    """The control table with a first watermark for ``table``."""
    row = control.sparkSession.range(1).select(
        F.lit(table).alias("table_name"), run_time.cast("timestamp_ntz").alias("run_time")
    )
    return control.where(F.col("table_name") != table).unionByName(row)


def advance_watermark(control: DataFrame, extract: DataFrame, ts: str, table: str) -> DataFrame:
    """The control table with the newest ``ts`` of the extract; an empty extract moves nothing.

    A table the control does not know yet gets its row. Give the landed rows, not the query
    that read them: rows that reach the source in between would be passed over for ever.
    """
    newest = extract.agg(F.max(F.col(ts)).alias("newest")).scalar().cast("timestamp_ntz")
    moved = F.when(F.col("table_name") == table, F.greatest(F.col("run_time"), newest))
    known = control.withColumn("run_time", F.coalesce(moved, F.col("run_time")))
    rows_known = control.where(F.col("table_name") == table).agg(F.count(F.lit(1))).scalar()
    first = control.sparkSession.range(1).select(F.lit(table).alias("table_name"), newest.alias("run_time"))
    new = first.where((rows_known == 0) & F.col("run_time").isNotNull())
    return known.unionByName(new, allowMissingColumns=True)


def key_check(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows and distinct keys per table: equal numbers mean the declared key holds.

    Rows are first reduced to one per key, so a frequent key costs no single task.
    """
    parts = []
    for name, (df, keys) in tables.items():
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
                F.count(F.lit(1)).alias("distinct_keys"),
            ).select(F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "rows", "distinct_keys")
        )
    return reduce(lambda a, b: a.unionByName(b), parts)
