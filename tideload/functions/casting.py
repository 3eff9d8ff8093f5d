"""Source column types and the reading of text fields as those types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_DECIMAL = T.DecimalType(18, 6)

# Database type names and the Spark types that hold their range.
SPARK_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "serial": T.IntegerType(),
    "smallint": T.ShortType(),
    "tinyint": T.ShortType(),
    "bit": T.BooleanType(),
    "boolean": T.BooleanType(),
    "numeric": DEFAULT_DECIMAL,
    "decimal": DEFAULT_DECIMAL,
    "float": T.DoubleType(),
    "real": T.FloatType(),
    "double precision": T.DoubleType(),
    "char": T.StringType(),
    "nchar": T.StringType(),
    "varchar": T.StringType(),
    "nvarchar": T.StringType(),
    "character": T.StringType(),
    "character varying": T.StringType(),
    "text": T.StringType(),
    "sysname": T.StringType(),
    "time": T.StringType(),
    "datetime": T.TimestampNTZType(),
    "timestamp without time zone": T.TimestampNTZType(),
    "date": T.DateType(),
    "varbinary": T.BinaryType(),
}


def spark_type(source_type: str, override: T.DataType | None = None) -> T.DataType:
    """The Spark type for a database type name."""
    if override is not None:
        return override
    try:
        return SPARK_TYPES[source_type.strip().lower()]
    except KeyError:
        raise ValueError(f"no Spark type known for source type {source_type!r}") from None


def source_type(data_type: T.DataType) -> str:
    """A database type name that :func:`spark_type` maps back to ``data_type``."""
    names = {
        T.LongType: "bigint",
        T.IntegerType: "int",
        T.ShortType: "smallint",
        T.BooleanType: "bit",
        T.DecimalType: "decimal",
        T.DoubleType: "float",
        T.FloatType: "real",
        T.StringType: "varchar",
        T.TimestampNTZType: "datetime",
        T.TimestampType: "datetime",
        T.DateType: "date",
        T.BinaryType: "varbinary",
    }
    return names[type(data_type)]


def read_text_as(text: Column, data_type: T.DataType) -> Column:
    """Read a text field as ``data_type``; malformed text gives NULL.

    Bits come as ``0``/``1`` and binaries as base64.
    """
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.BooleanType):
        return F.coalesce(text.try_cast("int").cast("boolean"), text.try_cast("boolean"))
    if isinstance(data_type, T.BinaryType):
        return F.try_to_binary(text, F.lit("base64"))
    return text.try_cast(data_type)


def write_as_text(value: Column, data_type: T.DataType) -> Column:
    """The text form that :func:`read_text_as` reads back."""
    if isinstance(data_type, T.BooleanType):
        return value.cast("int").cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.base64(value)
    return value.cast("string")
