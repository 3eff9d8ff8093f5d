"""Change streams. Files are landed in two parts, and the stream runs once after each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tideload.operators.merge import TIMESTAMP
from tideload.queries.loading import CHANGE_FILE_SQL, CHANGE_FILE_TIEBREAK, order_change_rows, order_meta
from tideload.queries.merging import ORDER_COLUMNS, ORDER_KEY, ORDER_MERGE_SQL
from tideload.queries.registry import Tables, query
from tideload.sources.delimited import write_snapshot
from tideload.streaming.changes import append_stream, change_folder, parse_values
from tideload.streaming.levelled import LevelledTable
from tideload.streaming.upsert import UpsertTable, start_upsert

_OUT = [*ORDER_COLUMNS, "header__operation", TIMESTAMP, "h5"]


def in_two_parts(t: Tables, folder: str, run: Callable[[], object]) -> None:
    """Land the changes of finished lines, run; land those of open lines, run again."""
    rows = order_change_rows(t)
    for part in (rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus <> 'F'")):
        write_snapshot(part, folder, mode="append")
        run()


def _collect(t: Tables, stream: Callable[[], DataFrame], folder: str) -> DataFrame:
    out, checkpoint = t.scratch("stream-out"), t.scratch("stream-checkpoint")
    in_two_parts(t, folder, lambda: append_stream(stream(), out, checkpoint).awaitTermination())
    return t.spark.read.parquet(out).select(*_OUT)


@query("stream_parse_values", CHANGE_FILE_SQL)
def _stream_parse_values(t: Tables) -> DataFrame:
    """Lines of text stand for message values."""
    folder, meta = t.scratch("messages"), order_meta(t)
    return _collect(t, lambda: parse_values(t.spark.readStream.text(folder), meta), folder)


@query("stream_available_now", CHANGE_FILE_SQL)
def _stream_available_now(t: Tables) -> DataFrame:
    folder, meta = t.scratch("change-files"), order_meta(t)
    return _collect(t, lambda: change_folder(t.spark, folder, meta), folder)


@query("stream_archive_source", CHANGE_FILE_SQL)
def _stream_archive_source(t: Tables) -> DataFrame:
    folder, archive, meta = t.scratch("change-files"), t.scratch("archive"), order_meta(t)
    return _collect(t, lambda: change_folder(t.spark, folder, meta, archive_folder=archive), folder)


def _upsert_table(t: Tables) -> UpsertTable:
    table = UpsertTable(t.spark, t.scratch("upsert"), ORDER_KEY, ORDER_COLUMNS, tiebreak=CHANGE_FILE_TIEBREAK)
    table.seed(t.orders, order_change_rows(t))
    return table


@query("stream_upsert", ORDER_MERGE_SQL)
def _stream_upsert(t: Tables) -> DataFrame:
    table, folder, checkpoint, meta = _upsert_table(t), t.scratch("change-files"), t.scratch("checkpoint"), order_meta(t)
    in_two_parts(
        t, folder, lambda: start_upsert(change_folder(t.spark, folder, meta), table, checkpoint).awaitTermination()
    )
    return table.read()


@query("stream_replay_idempotent", ORDER_MERGE_SQL)
def _stream_replay_idempotent(t: Tables) -> DataFrame:
    """Each part is applied twice under its batch number, and once more after compaction."""
    table, rows = _upsert_table(t), order_change_rows(t)
    parts = [rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus <> 'F'")]
    for batch_id, part in enumerate(parts):
        table.apply_batch(part, batch_id)
        table.apply_batch(part, batch_id)
        table.compact()
        table.apply_batch(part, batch_id)
    return table.read()


@query("stream_new_checkpoint", ORDER_MERGE_SQL)
def _stream_new_checkpoint(t: Tables) -> DataFrame:
    """The first part by one stream; after a compaction both parts by a stream with a new checkpoint."""
    table, folder, meta = _upsert_table(t), t.scratch("change-files"), order_meta(t)
    checkpoints = [t.scratch("checkpoint"), t.scratch("checkpoint")]

    def run() -> None:
        stream = change_folder(t.spark, folder, meta)
        start_upsert(stream, table, checkpoints.pop(), compact_every=1).awaitTermination()

    in_two_parts(t, folder, run)
    return table.read()


@query("stream_levelled_state", ORDER_MERGE_SQL)
def _stream_levelled_state(t: Tables) -> DataFrame:
    """The change files one by one into levelled runs, with compactions on the way."""
    folder, checkpoint, meta = t.scratch("change-files"), t.scratch("checkpoint"), order_meta(t)
    table = LevelledTable(
        t.spark, t.scratch("levelled"), t.database(), ORDER_KEY, ORDER_COLUMNS,
        tiebreak=CHANGE_FILE_TIEBREAK, buckets=8, fanout=2, first_rows=t.orders.count() // 16,
    )
    table.seed(t.orders, order_change_rows(t))

    def run() -> None:
        stream = change_folder(t.spark, folder, meta, maxFilesPerTrigger="3")
        start_upsert(stream, table, checkpoint, compact_every=2).awaitTermination()

    in_two_parts(t, folder, run)
    return table.read()
