"""Delimited text snapshots and change files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideload.functions.casting import read_text_as, write_as_text
from tideload.operators.merge import OPERATION, TIMESTAMP
from tideload.sources.metadata import TableMeta

# A change row starts with seven header columns; the fifth is the
# operation and the seventh the time. The others are opaque, but the sixth may carry
# a change sequence.
SEQUENCE = "h5"
BAD_ROW = "_bad_row"
CHANGE_HEADER = ("h0", "h1", "h2", "h3", OPERATION, SEQUENCE, TIMESTAMP)


def change_text_struct(meta: TableMeta) -> T.StructType:
    """All columns of a change file as text."""
    head = [T.StructField(name, T.StringType()) for name in CHANGE_HEADER]
    return T.StructType(head + meta.text_struct().fields)


def change_struct(meta: TableMeta) -> T.StructType:
    """All columns of a change file, typed."""
    head = [
        T.StructField(name, T.TimestampNTZType() if name == TIMESTAMP else T.StringType()) for name in CHANGE_HEADER
    ]
    return T.StructType(head + meta.struct().fields)


def type_columns(text: DataFrame, struct: T.StructType) -> DataFrame:
    """Text columns read as the types of ``struct``."""
    return text.select(*[read_text_as(F.col(f.name), f.dataType).alias(f.name) for f in struct.fields])


def malformed(struct: T.StructType) -> Column:
    """Whether some field has text that its type cannot hold."""
    bad = [
        F.col(f.name).isNotNull() & read_text_as(F.col(f.name), f.dataType).isNull()
        for f in struct.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    return reduce(lambda a, b: a | b, bad, F.lit(False))


def reject_reason(struct: T.StructType, required: Sequence[str] = ()) -> Column:
    """Why a text row can't be used; NULL if it can.

    The row has too few or too many fields, a field its type can't hold, or no value in a
    required column.
    """
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required], F.lit(False))
    return (
        F.when(F.col(BAD_ROW).isNotNull(), "number of fields")
        .when(malformed(struct), "malformed field")
        .when(missing, "missing value")
    )


def split_rejects(text: DataFrame, struct: T.StructType, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Typed good rows, and the other rows as text with their ``reason``.

    The text of a row with a wrong number of fields is in ``_bad_row``.
    """
    reason = reject_reason(struct, required)
    return type_columns(text.where(reason.isNull()), struct), text.withColumn("reason", reason).where("reason IS NOT NULL")


def change_required(meta: TableMeta) -> list[str]:
    """Columns a change can't be applied without."""
    return [OPERATION, TIMESTAMP, *meta.keys]


def with_bad_row(struct: T.StructType) -> T.StructType:
    return T.StructType([*struct.fields, T.StructField(BAD_ROW, T.StringType())])


def escape_breaks(text: Column) -> Column:
    """Backslashes and line breaks written as ``\\\\``, ``\\n`` and ``\\r``, so that a row stays one line."""
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape_breaks(text: Column) -> Column:
    """The text that :func:`escape_breaks` was given."""
    def part(x: Column) -> Column:
        return F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    whole = F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")
    return F.when(F.contains(text, F.lit("\\")), whole).otherwise(text)


def _csv_options(sep: str, multiline: bool) -> dict:
    # Empty text stays empty and only an unquoted \N is NULL, so both survive a round trip.
    return {
        "sep": sep,
        "header": False,
        "quote": '"',
        "escape": '"',
        "nullValue": "\\N",
        "emptyValue": "",
        "multiLine": multiline,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }


def read_text_snapshot(
    spark: SparkSession, path: str | Sequence[str], struct: T.StructType, sep: str = ",", multiline: bool = False, escaped: bool = True
) -> DataFrame:
    """A headerless positional file as text columns; ``_bad_row`` has rows with a wrong number of fields.

    ``multiline`` accepts quoted line breaks but keeps Spark from splitting a file, so large
    snapshots with line breaks should come as many files, or escaped. ``escaped``: the file was
    written by :func:`write_snapshot`; switch it off for files whose backslashes mean themselves.
    """
    # Spark counts a row's fields only while it parses all of them.
    options = {**_csv_options(sep, multiline), "columnPruning": False, "columnNameOfCorruptRecord": BAD_ROW}
    text = spark.read.schema(with_bad_row(struct)).options(**options).csv(path if isinstance(path, str) else list(path))
    return unescape_rows(text, struct) if escaped else text


def unescape_rows(text: DataFrame, struct: T.StructType) -> DataFrame:
    """Text columns with their line breaks back."""
    return text.withColumns({f.name: unescape_breaks(F.col(f.name)) for f in struct.fields})


def read_snapshot_checked(
    spark: SparkSession, path: str, meta: TableMeta, sep: str = ",", multiline: bool = False, escaped: bool = True
) -> tuple[DataFrame, DataFrame]:
    """A typed snapshot without its bad rows, and those rows as text with a ``reason``."""
    text = read_text_snapshot(spark, path, meta.text_struct(), sep, multiline, escaped)
    return split_rejects(text, meta.struct())


def read_snapshot(
    spark: SparkSession, path: str, meta: TableMeta, sep: str = ",", multiline: bool = False, escaped: bool = True
) -> DataFrame:
    """The good rows of a table snapshot, typed by its metadata."""
    return read_snapshot_checked(spark, path, meta, sep, multiline, escaped)[0]


def read_changes_checked(
    spark: SparkSession, path: str | Sequence[str], meta: TableMeta, sep: str = ",", multiline: bool = False, escaped: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The typed changes of a change table that can be applied, and its other rows as text with a ``reason``.

    A row has seven header columns, then the table's columns; one without operation, time or
    a part of its key is rejected too.
    """
    text = read_text_snapshot(spark, path, change_text_struct(meta), sep, multiline, escaped)
    return split_rejects(text, change_struct(meta), change_required(meta))


def read_changes(
    spark: SparkSession, path: str, meta: TableMeta, sep: str = ",", multiline: bool = False, escaped: bool = True
) -> DataFrame:
    """The changes of a change table that can be applied."""
    return read_changes_checked(spark, path, meta, sep, multiline, escaped)[0]


def as_text(df: DataFrame) -> DataFrame:
    """Every column in its text form."""
    return df.select(*[write_as_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def write_snapshot(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite", escaped: bool = True) -> None:
    """Write headerless delimited text that :func:`read_snapshot` reads back, one line a row."""
    options = {k: v for k, v in _csv_options(sep, False).items() if k != "multiLine"}
    options["emptyValue"] = '""'
    text = as_text(df)
    if escaped:
        text = text.select(*[escape_breaks(F.col(c)).alias(c) for c in text.columns])
    text.write.mode(mode).options(**options).csv(path)


def change_rows(
    df: DataFrame, columns: Sequence[str], op: Column, ts: Column, sequence: Column | None = None
) -> DataFrame:
    """Table rows dressed as change rows: header columns, then the table's columns.

    ``sequence`` fills the sixth header column; opaque columns hold their own name.
    """
    values = {OPERATION: op, TIMESTAMP: ts}
    if sequence is not None:
        values[SEQUENCE] = sequence
    header = [values.get(name, F.lit(name)).alias(name) for name in CHANGE_HEADER]
    return df.select(*header, *columns)
