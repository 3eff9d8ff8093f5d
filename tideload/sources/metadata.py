"""Table metadata: field name, database type, key flag, one small file per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideload.functions.casting import source_type, spark_type
from tideload.operators.joins import lookup_join

# Header line of a metadata file.
HEADER = ("FieldName", "DataType", "IsPrimary")

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("is_primary", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Field:
    name: str
    data_type: str
    is_primary: bool


@dataclass(frozen=True)
class TableMeta:
    """Fields of one table in file order."""

    table: str
    fields: tuple[Field, ...]
    overrides: Mapping[str, T.DataType] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def keys(self) -> list[str]:
        return [f.name for f in self.fields if f.is_primary]

    @property
    def others(self) -> list[str]:
        return [f.name for f in self.fields if not f.is_primary]

    def struct(self) -> T.StructType:
        """The typed schema; metadata has no decimal scale, so callers may override a field."""
        return T.StructType(
            [T.StructField(f.name, spark_type(f.data_type, self.overrides.get(f.name))) for f in self.fields]
        )

    def text_struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """All metadata files below ``path`` as ``(table_name, ordinal, field_name, data_type, is_primary)``.

    The table is the file name without its ending, or the ``table_name=`` folder. A file
    is read whole so that line order gives the ordinal; the header line is optional.
    """
    files = spark.read.text(path, wholetext=True)
    if "table_name" in files.columns:
        name = F.col("table_name").cast("string")
    else:
        name = F.regexp_extract("_metadata.file_name", r"^(.*?)(?:\.[^.]*)?$", 1)
    files = files.select(name.alias("table_name"), "value")
    lines = files.select("table_name", F.posexplode(F.split("value", r"\r?\n")).alias("_pos", "_line"))
    parts = F.split("_line", ",")
    rows = lines.where(F.trim("_line") != "").select(
        "table_name",
        "_pos",
        F.trim(parts[0]).alias("field_name"),
        F.trim(parts[1]).alias("data_type"),
        F.trim(parts[2]).alias("_primary"),
    )
    body = rows.where(F.lower("field_name") != HEADER[0].lower())
    first = body.groupBy("table_name").agg(F.min("_pos").alias("_first"))
    return body.join(first, "table_name").select(
        "table_name",
        (F.col("_pos") - F.col("_first")).cast("int").alias("ordinal"),
        "field_name",
        "data_type",
        (F.col("_primary") == "1").alias("is_primary"),
    )


def table_metas(metadata: DataFrame) -> dict[str, TableMeta]:
    """Metadata rows as one object per table. Metadata is bounded by the number of source columns."""
    found: dict[str, list] = {}
    for row in metadata.orderBy("table_name", "ordinal").collect():
        found.setdefault(row.table_name, []).append(Field(row.field_name, row.data_type, row.is_primary))
    return {name: TableMeta(name, tuple(fields)) for name, fields in found.items()}


def meta_of(table: str, schema: T.StructType, keys: Sequence[str]) -> TableMeta:
    """Metadata of an existing DataFrame schema."""
    fields = [Field(f.name, source_type(f.dataType), f.name in keys) for f in schema.fields]
    decimals = {f.name: f.dataType for f in schema.fields if isinstance(f.dataType, T.DecimalType)}
    return TableMeta(table, tuple(fields), decimals)


def metadata_frame(spark: SparkSession, metas: Sequence[TableMeta]) -> DataFrame:
    """Table metadata as rows."""
    rows = [(m.table, i, f.name, f.data_type, f.is_primary) for m in metas for i, f in enumerate(m.fields)]
    return spark.createDataFrame(rows, METADATA_SCHEMA)


def write_metadata(metadata: DataFrame, path: str) -> None:
    """One CSV folder per table, fields in ordinal order, with the header line.

    A table's fields are a handful of rows, so each table is one small file.
    """
    (
        metadata.repartition("table_name")
        .sortWithinPartitions("table_name", "ordinal")
        .select(
            "table_name",
            F.col("field_name").alias(HEADER[0]),
            F.col("data_type").alias(HEADER[1]),
            F.col("is_primary").cast("int").alias(HEADER[2]),
        )
        .write.partitionBy("table_name")
        .option("header", True)
        .csv(path)
    )


def discover_metadata(
    columns: DataFrame, types: DataFrame, index_columns: DataFrame, indexes: DataFrame
) -> DataFrame:
    """Column metadata from a catalog that lists columns, types, index columns and indexes.

    Only the first (clustered) index of a table can give the key. Tables without a key
    are left out. Rows come sorted by table, key columns first, then by name.
    """
    first_index = index_columns.where(F.col("index_id") == 1)
    typed = lookup_join(columns, types, ["user_type_id"])
    keyed = typed.join(first_index, ["object_id", "column_id"], "left")
    flagged = keyed.join(indexes.where(F.col("index_id") == 1), ["object_id", "index_id"], "left").select(
        "object_id",
        F.col("column_name").alias("field_name"),
        F.col("type_name").alias("data_type"),
        F.coalesce(F.col("is_primary_key").cast("int"), F.lit(0)).alias("is_primary"),
    )
    with_key = flagged.where("is_primary = 1").select("object_id")
    return flagged.join(with_key, "object_id", "left_semi").orderBy(
        "object_id", F.col("is_primary").desc(), "field_name"
    )


def discover_tables(
    tables: DataFrame, columns: DataFrame, types: DataFrame, index_columns: DataFrame, indexes: DataFrame
) -> DataFrame:
    """Metadata rows of all tables that have a key, ready for :func:`write_metadata` and :func:`table_metas`.

    ``tables`` names the objects (``object_id, table_name``). Key columns come first, then the
    others by name. A window holds the columns of one table.
    """
    found = discover_metadata(columns, types, index_columns, indexes)
    place = Window.partitionBy("object_id").orderBy(F.col("is_primary").desc(), "field_name")
    numbered = found.withColumn("ordinal", F.row_number().over(place) - 1)
    return lookup_join(numbered, tables.select("object_id", "table_name"), ["object_id"]).select(
        "table_name", "ordinal", "field_name", "data_type", (F.col("is_primary") == 1).alias("is_primary")
    )


def discover_metadata_by_constraint(
    table_constraints: DataFrame, constraint_columns: DataFrame, columns: DataFrame
) -> DataFrame:
    """Column metadata from constraint views: key columns with 1, all other columns with 0.

    Columns of tables without any constraint do not appear.
    """
    constraint = ["constraint_schema", "constraint_name"]
    primary = (
        table_constraints.where(F.col("constraint_type") == "PRIMARY KEY")
        .join(constraint_columns, constraint)
        .select(F.col("constraint_schema").alias("table_schema"), "table_name", "column_name")
        .distinct()
    )
    place = ["table_schema", "table_name", "column_name"]
    known = columns.select(*place, "data_type").distinct()
    keys = known.join(primary, place, "left_semi").withColumn("pk", F.lit(1))
    constrained = table_constraints.select(F.col("constraint_schema").alias("table_schema"), "table_name")
    others = (
        known.join(constrained, ["table_schema", "table_name"], "left_semi")
        .join(primary, place, "left_anti")
        .withColumn("pk", F.lit(0))
    )
    return keys.unionByName(others).distinct().select("table_name", "column_name", "data_type", "pk")

