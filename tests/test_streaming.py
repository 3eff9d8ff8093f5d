import os

import pytest
from conftest import DATA, rows

from tideload.operators.merge import merge_changes
from tideload.queries.loading import CHANGE_FILE_TIEBREAK, order_change_rows, order_meta
from tideload.queries.merging import ORDER_COLUMNS, ORDER_KEY
from tideload.queries.registry import Tables
from tideload.sources.delimited import write_snapshot
from tideload.sources.metadata import Field, TableMeta
from tideload.streaming.changes import append_stream, change_folder, parse_values, rejected_values
from tideload.streaming.upsert import UpsertTable, start_upsert

META = TableMeta("t", (Field("k", "int", True), Field("v", "varchar", False)))


def line(k, v, op, ts, seq):
    return f'0,0,0,0,{op},{seq:05d},2024-01-01 {ts},{k},{v}\n'


def write_file(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.writelines(lines)


@pytest.fixture
def table(spark, scratch):
    table = UpsertTable(spark, f"{scratch}/table", ["k"], ["k", "v"], tiebreak=["h5"])
    sample = spark.createDataFrame([], "k int, v string, h5 string")
    table.seed(spark.createDataFrame([(1, "one"), (2, "two")], "k int, v string"), sample)
    return table


def run(spark, scratch, table, **options):
    stream = change_folder(spark, f"{scratch}/in", META, **options)
    start_upsert(stream, table, f"{scratch}/checkpoint").awaitTermination()


def test_many_batches_equal_one_merge(spark, scratch):
    t = Tables(spark, str(DATA / "sf0.001"))
    changes = order_change_rows(t)
    write_snapshot(changes.repartition(5), f"{scratch}/in")
    target = UpsertTable(spark, f"{scratch}/table", ORDER_KEY, ORDER_COLUMNS, tiebreak=CHANGE_FILE_TIEBREAK)
    target.seed(t.orders, changes)
    stream = change_folder(spark, f"{scratch}/in", order_meta(t), maxFilesPerTrigger="1")
    start_upsert(stream, target, f"{scratch}/checkpoint").awaitTermination()
    assert len(target._pending()) == 5
    expected = rows(merge_changes(t.orders, changes, ORDER_KEY, tiebreak=CHANGE_FILE_TIEBREAK))
    assert rows(target.read()) == expected
    target.compact()
    target.vacuum()
    assert rows(target.read()) == expected and target._pending() == []


def test_late_changes_lose_and_deletes_are_remembered(spark, scratch, table):
    write_file(f"{scratch}/in", "a.csv", line(1, "new", "UPDATE", "10:00:05", 5), line(2, "", "DELETE", "10:00:05", 6))
    run(spark, scratch, table)
    assert rows(table.read()) == [(1, "new")]
    table.compact()
    write_file(f"{scratch}/in", "b.csv", line(1, "late", "UPDATE", "10:00:01", 1), line(2, "late", "UPDATE", "10:00:01", 2))
    run(spark, scratch, table)
    assert rows(table.read()) == [(1, "new")]
    write_file(f"{scratch}/in", "c.csv", line(2, "again", "INSERT", "10:00:09", 9))
    run(spark, scratch, table)
    assert rows(table.read()) == [(1, "new"), (2, "again")]


def test_no_new_files_means_no_batch(spark, scratch, table):
    write_file(f"{scratch}/in", "a.csv", line(3, "three", "INSERT", "10:00:00", 1))
    run(spark, scratch, table)
    run(spark, scratch, table)
    assert table._log().keys() == {0}


def test_replayed_batches_count_once(spark, table):
    feed = spark.createDataFrame(
        [(1, "x", "UPDATE", "2024-01-01", "1"), (2, "", "DELETE", "2024-01-01", "2")],
        "k int, v string, header__operation string, ts string, h5 string",
    ).selectExpr("k", "v", "header__operation", "cast(ts as timestamp_ntz) header__timestamp", "h5")
    for _ in range(3):
        table.apply_batch(feed, 0)
    assert rows(table.read()) == [(1, "x")]
    table.compact()
    table.apply_batch(feed.withColumn("v", feed.v), 0)
    assert table._pending() == [] and rows(table.read()) == [(1, "x")]


def test_old_tombstones_can_be_dropped(spark, scratch, table):
    write_file(f"{scratch}/in", "a.csv", line(2, "", "DELETE", "10:00:05", 6))
    run(spark, scratch, table)
    table.compact(forget_before="2025-01-01")
    assert table.state().count() == 1 and rows(table.read()) == [(1, "one")]


def test_seed_comes_first(spark, scratch):
    table = UpsertTable(spark, f"{scratch}/none", ["k"], ["k", "v"])
    with pytest.raises(FileNotFoundError):
        table.read()


def test_consumed_files_are_archived(spark, scratch):
    folder, archive = f"{scratch}/in", f"{scratch}/archive"
    for name in ("a.csv", "b.csv", "c.csv"):
        write_file(folder, name, line(1, name, "UPDATE", "10:00:00", 1))
        stream = change_folder(spark, folder, META, archive_folder=archive)
        append_stream(stream, f"{scratch}/out", f"{scratch}/checkpoint").awaitTermination()
    moved = {f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".csv")}
    left = {f for f in os.listdir(folder) if f.endswith(".csv")}
    assert moved and moved | left == {"a.csv", "b.csv", "c.csv"} and not moved & left
    assert "c.csv" in left
    assert rows(spark.read.parquet(f"{scratch}/out"), "v") == [("a.csv",), ("b.csv",), ("c.csv",)]


def test_values_with_quotes_and_bad_numbers(spark):
    values = spark.createDataFrame(
        [('0,0,0,0,UPDATE,00001,2024-01-01 10:00:00.5,7,"a, ""b"""',), ("0,0,0,0,UPDATE,1,2024-01-01,x,y",)], "value string"
    )
    assert rows(parse_values(values, META), "k", "v") == [(7, 'a, "b"')]
    assert rows(rejected_values(values, META), "k") == [("x",)]


def feed_of(spark, *rows):
    """(k, v, operation, second) rows as changes."""
    text = [(k, v, op, f"2024-01-01 00:00:{s:02d}", f"{s:05d}") for k, v, op, s in rows]
    frame = spark.createDataFrame(text, "k int, v string, header__operation string, ts string, h5 string")
    return frame.selectExpr("k", "v", "header__operation", "cast(ts as timestamp_ntz) header__timestamp", "h5")


@pytest.mark.parametrize("compacted", [False, True])
def test_sources_do_not_meet(spark, table, compacted):
    table.apply_batch(feed_of(spark, (1, "first", "UPDATE", 1)), 0, "a")
    if compacted:
        table.compact()
        table.vacuum()
    table.apply_batch(feed_of(spark, (3, "second", "INSERT", 2)), 0, "b")
    assert rows(table.read()) == [(1, "first"), (2, "two"), (3, "second")]
    table.apply_batch(feed_of(spark, (9, "replayed", "INSERT", 2)), 0, "b")
    assert rows(table.read()) == [(1, "first"), (2, "two"), (9, "replayed")]
    table.apply_batch(feed_of(spark, (1, "first", "UPDATE", 1)), 0, "a")
    table.compact()
    table.apply_batch(feed_of(spark, (7, "late replay", "INSERT", 2)), 0, "a")
    assert rows(table.read()) == [(1, "first"), (2, "two"), (9, "replayed")]
    with pytest.raises(ValueError, match="source"):
        table.apply_batch(feed_of(spark), 0, "../a")


@pytest.mark.parametrize("compacted", [False, True])
def test_a_new_checkpoint_neither_skips_nor_overwrites(spark, scratch, table, compacted):
    write_file(f"{scratch}/in", "a.csv", line(1, "new", "UPDATE", "10:00:05", 5))
    run(spark, scratch, table)
    if compacted:
        table.compact()
        table.vacuum()
    write_file(f"{scratch}/more", "b.csv", line(3, "three", "INSERT", "10:00:06", 6))
    stream = change_folder(spark, f"{scratch}/more", META)
    start_upsert(stream, table, f"{scratch}/other checkpoint").awaitTermination()
    assert rows(table.read()) == [(1, "new"), (2, "two"), (3, "three")]


def test_the_log_is_compacted_as_the_stream_runs(spark, scratch, table):
    for i in range(7):
        write_file(f"{scratch}/in", f"{i}.csv", line(10 + i, f"v{i}", "INSERT", f"10:00:{i:02d}", i))
    stream = change_folder(spark, f"{scratch}/in", META, maxFilesPerTrigger="1")
    start_upsert(stream, table, f"{scratch}/checkpoint", compact_every=3).awaitTermination()
    assert len(table._pending()) < 3 and len(table._versions()) == 2
    assert len(rows(table.read())) == 9


def test_one_second_trigger(spark, scratch, table):
    import time

    write_file(f"{scratch}/in", "a.csv", line(3, "three", "INSERT", "10:00:00", 1))
    running = start_upsert(change_folder(spark, f"{scratch}/in", META), table, f"{scratch}/checkpoint", processingTime="1 second")
    try:
        for i, wanted in enumerate(([1, 2, 3], [1, 2, 3, 4])):
            deadline = time.time() + 60
            while [r[0] for r in rows(table.read(), "k")] != wanted and time.time() < deadline:
                time.sleep(0.3)
            assert [r[0] for r in rows(table.read(), "k")] == wanted
            write_file(f"{scratch}/in", f"more{i}.csv", line(4, "four", "INSERT", "10:00:01", 2))
    finally:
        running.stop()


GOOD = "0,0,0,0,UPDATE,00001,2024-01-01 10:00:00,7,seven"
BAD = {
    "0,0,0,0,UPDATE,00001,2024-01-01 10:00:00,1": "number of fields",
    "0,0,0,0,UPDATE,00001,2024-01-01 10:00:00,1,x,y": "number of fields",
    "0,0,0,0,UPDATE,00001,2024-01-01 10:00:00,one,x": "malformed field",
    "0,0,0,0,UPDATE,00001,noon,1,x": "malformed field",
    r"0,0,0,0,UPDATE,00001,2024-01-01 10:00:00,\N,x": "missing value",
    r"0,0,0,0,\N,00001,2024-01-01 10:00:00,1,x": "missing value",
    r"0,0,0,0,UPDATE,00001,\N,1,x": "missing value",
}


def test_bad_changes_are_rejected_everywhere(spark, scratch, table):
    from tideload.sources.delimited import read_changes_checked
    from tideload.streaming.changes import change_folder_checked, parse_values_checked

    lines = [GOOD, *BAD]
    write_file(f"{scratch}/in", "a.csv", *[f"{x}\n" for x in lines])
    values = spark.createDataFrame([(x,) for x in lines], "value string")
    for good, bad in (parse_values_checked(values, META), read_changes_checked(spark, f"{scratch}/in", META)):
        assert rows(good, "k", "v") == [(7, "seven")] and rows(good, "k") == [(7,)]
        assert sorted(r.reason for r in bad.collect()) == sorted(BAD.values())
        assert bad.select("reason").count() == len(BAD)
    good, bad = change_folder_checked(spark, f"{scratch}/in", META)
    start_upsert(good, table, f"{scratch}/checkpoint").awaitTermination()
    append_stream(bad, f"{scratch}/rejects", f"{scratch}/checkpoint2").awaitTermination()
    assert rows(table.read()) == [(1, "one"), (2, "two"), (7, "seven")]
    assert sorted(r.reason for r in spark.read.parquet(f"{scratch}/rejects").collect()) == sorted(BAD.values())


def test_topic_options_and_message_text(spark):
    from tideload.streaming.changes import message_text, topic_options

    options = topic_options("a:9092,b:9092", "orders", "earliest", "loader", 1000)
    assert options["kafka.bootstrap.servers"] == "a:9092,b:9092" and options["subscribe"] == "orders"
    assert options["startingOffsets"] == "earliest" and options["kafka.group.id"] == "loader"
    assert options["maxOffsetsPerTrigger"] == "1000"
    assert "kafka.group.id" not in topic_options("a:9092", "orders")
    messages = spark.createDataFrame([(None, bytearray(GOOD.encode())), (None, None)], "key binary, value binary")
    assert rows(parse_values(message_text(messages), META), "k") == [(7,)]
    assert rejected_values(message_text(messages), META).count() == 1
