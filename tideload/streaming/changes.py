"""Change streams from message topics and change folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideload.sources.delimited import (
    BAD_ROW,
    change_required,
    change_struct,
    change_text_struct,
    split_rejects,
    unescape_rows,
    with_bad_row,
)
from tideload.sources.metadata import TableMeta


def topic_options(
    servers: str, topics: str, starting: str = "latest", group: str | None = None, max_per_batch: int | None = None
) -> dict[str, str]:
    """The settings of a topic source: one reader group, from the given offsets (``earliest``, ``latest`` or a map as JSON).

    Offsets are kept in the query's checkpoint; ``starting`` counts for a new checkpoint only.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topics, "startingOffsets": starting, "failOnDataLoss": "true"}
    if group is not None:
        options["kafka.group.id"] = group
    if max_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def topic_values(spark: SparkSession, options: Mapping[str, str], fmt: str = "kafka") -> DataFrame:
    """The message values of a topic as text; all connection settings come from the caller."""
    return message_text(spark.readStream.format(fmt).options(**options).load())


def message_text(messages: DataFrame) -> DataFrame:
    """The ``value`` bytes of messages as text."""
    return messages.select(F.col("value").cast("string").alias("value"))


def split_values(values: DataFrame, meta: TableMeta, sep: str = ",", escaped: bool = False) -> DataFrame:
    """A ``value`` column of delimited change rows as text columns. Works on streams and tables.

    ``_bad_row`` has values with a wrong number of fields.
    """
    struct = change_text_struct(meta)
    ddl = ", ".join(f"`{f.name}` STRING" for f in with_bad_row(struct).fields)
    options = {
        "sep": sep, "quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": "", "columnNameOfCorruptRecord": BAD_ROW
    }
    text = values.select(F.from_csv("value", ddl, options).alias("_row")).select("_row.*")
    return unescape_rows(text, struct) if escaped else text


def parse_values_checked(
    values: DataFrame, meta: TableMeta, sep: str = ",", escaped: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Message values as typed changes that can be applied, and the others as text with a ``reason``."""
    return split_rejects(split_values(values, meta, sep, escaped), change_struct(meta), change_required(meta))


def parse_values(values: DataFrame, meta: TableMeta, sep: str = ",", escaped: bool = False) -> DataFrame:
    """Message values as typed changes that can be applied."""
    return parse_values_checked(values, meta, sep, escaped)[0]


def rejected_values(values: DataFrame, meta: TableMeta, sep: str = ",", escaped: bool = False) -> DataFrame:
    """The messages that can't be applied, as text with a ``reason``."""
    return parse_values_checked(values, meta, sep, escaped)[1]


def change_folder_checked(
    spark: SparkSession,
    folder: str,
    meta: TableMeta,
    sep: str = ",",
    archive_folder: str | None = None,
    escaped: bool = True,
    **options: str,
) -> tuple[DataFrame, DataFrame]:
    """New change files of a folder as two streams: changes that can be applied, and the other rows as text.

    Each file is read once by each stream that is started. With ``archive_folder`` a file is
    moved there after the batch that follows its own has committed, so only consumed files are
    moved; the newest files stay until more arrive. Archive in one of the two streams only.
    """
    struct = change_text_struct(meta)
    reader = (
        spark.readStream.schema(with_bad_row(struct))
        .options(sep=sep, quote='"', escape='"', nullValue="\\N", emptyValue="")
        .options(columnPruning="false", columnNameOfCorruptRecord=BAD_ROW)
        .options(**options)
    )
    if archive_folder:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_folder)
    text = reader.csv(folder)
    return split_rejects(unescape_rows(text, struct) if escaped else text, change_struct(meta), change_required(meta))


def change_folder(
    spark: SparkSession,
    folder: str,
    meta: TableMeta,
    sep: str = ",",
    archive_folder: str | None = None,
    escaped: bool = True,
    **options: str,
) -> DataFrame:
    """New change files of a folder as a stream of typed changes that can be applied."""
    return change_folder_checked(spark, folder, meta, sep, archive_folder, escaped, **options)[0]


def append_stream(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a stream to a Parquet folder, each input row once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def print_stream(stream: DataFrame, **trigger) -> StreamingQuery:
    """Show a stream's batches on the console, for debugging."""
    return stream.writeStream.format("console").trigger(**(trigger or {"processingTime": "1 second"})).start()
