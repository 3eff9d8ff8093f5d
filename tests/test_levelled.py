"""Levelled runs: what is moved, what is rewritten, and what counts."""

import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tideload.streaming.levelled import BASE, LevelledTable
from tideload.streaming.upsert import UpsertTable

FEED = "k int, v string, header__operation string, n int"


@pytest.fixture
def database(spark):
    name = "levelled_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def feed(spark, *data):
    df = spark.createDataFrame(list(data), FEED)
    return df.withColumn("header__timestamp", F.timestamp_add("SECOND", F.col("n"), F.lit("2024-01-01").cast("timestamp_ntz")))


def make(spark, scratch, database, count=2, **options):
    table = LevelledTable(spark, f"{scratch}/t", database, ["k"], ["k", "v"], tiebreak=["n"], buckets=4, **options)
    start = spark.range(count).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("b"), "id").alias("v"))
    table.seed(start, spark.createDataFrame([], "k int, v string, n int"))
    return table, start


@pytest.mark.parametrize("seed", range(2))
def test_equals_the_plain_upsert(spark, scratch, database, seed):
    rng = random.Random(seed)
    table, start = make(spark, scratch, database, 40, fanout=2, first_rows=4)
    plain = UpsertTable(spark, f"{scratch}/u", ["k"], ["k", "v"], tiebreak=["n"])
    plain.seed(start, spark.createDataFrame([], "k int, v string, n int"))
    rewritten = []
    for batch in range(6):
        part = [(rng.randrange(60), f"{batch}-{i}", rng.choice(["INSERT", "UPDATE", "DELETE"]), rng.randrange(50)) for i in range(rng.choice([2, 12]))]
        table.apply_batch(feed(spark, *part), batch)
        plain.apply_batch(feed(spark, *part), batch)
        if batch % 2:
            rewritten += table.compact()
        if batch == 3:
            table.vacuum()
    assert rows(table.read()) == rows(plain.read())
    assert rewritten and rows(table.lookup([3, 4, 59])) == rows(plain.read().where("k IN (3, 4, 59)"))


def test_a_compaction_rewrites_one_level(spark, scratch, database):
    table, _ = make(spark, scratch, database, 10_000, fanout=4, first_rows=1000)
    base = table.runs()[-1]
    for batch in range(3):
        table.apply_batch(feed(spark, *[(k, "new", "UPDATE", batch) for k in range(batch * 100, batch * 100 + 100)]), batch)
    assert [r.level for r in table.runs()] == [0, 0, 0, BASE] and len(table._pending()) == 3
    assert table.compact() == [1]
    assert [r.level for r in table.runs()] == [1, BASE] and table.runs()[-1] == base
    table.apply_batch(feed(spark, (1, "newer", "UPDATE", 9)), 3)
    assert table.compact() == [1] and table.runs()[-1] == base
    assert table.read().where("v LIKE 'new%'").count() == 300 and rows(table.lookup([1])) == [(1, "newer")]
    # Once the levels above hold a fair share of its rows, the base is rewritten.
    table.apply_batch(feed(spark, *[(k, "many", "UPDATE", 20) for k in range(5000)]), 4)
    assert BASE in table.compact() and [r.level for r in table.runs()] == [BASE]
    table.vacuum()
    assert table.read().where("v = 'many'").count() == 5000 and table.read().count() == 10_000


def steps_above(plan, name):
    """The operators above each scan of a table, up to the first join."""
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-|")) for line in lines]
    for i, line in enumerate(lines):
        if "FileScan" in line and name in line:
            found, at = [], depth[i]
            for j in range(i - 1, -1, -1):
                if depth[j] < at:
                    found.append(lines[j].strip())
                    at = depth[j]
                    if "Join" in lines[j]:
                        break
            yield found


def test_neither_a_read_nor_a_compaction_moves_the_base(spark, scratch, database):
    """Nor the levels above it, whatever the session's number of partitions."""
    table, _ = make(spark, scratch, database, 5000, fanout=4, first_rows=1000)
    table.apply_batch(feed(spark, *[(k, "new", "UPDATE", 1) for k in range(100)]), 0)
    table.compact()
    table.apply_batch(feed(spark, (7, "newest", "UPDATE", 2)), 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = table.runs()
        assert [r.level for r in runs] == [0, 1, BASE]
        for state in (table.read(), table._merged(runs[:2])):
            plan = plan_of(state)
            for run in runs[1:]:
                for found in steps_above(plan, run.name):
                    assert "SortMergeJoin" in found[-1] and not any("Exchange" in step for step in found)
        assert len(list(steps_above(plan_of(table.read()), runs[-1].name))) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    location = table.compact() and table.runs()[0].name
    files = spark.read.parquet(f"{table.path}/runs/{location}").select(F.input_file_name()).distinct().count()
    assert files <= 4


def test_replays_late_changes_and_tombstones(spark, scratch, database):
    table, _ = make(spark, scratch, database, 10_000)
    part = feed(spark, (0, "new", "UPDATE", 5), (1, None, "DELETE", 5))
    for _ in range(2):
        table.apply_batch(part, 0)
    assert len(table._pending()) == 1
    table.compact()
    table.apply_batch(part, 0)
    assert table._pending() == [] and table.read().count() == 9_999
    # Another source numbers its batches anew.
    table.apply_batch(feed(spark, (0, "late", "UPDATE", 1), (1, "late", "INSERT", 1)), 0, "other")
    table.compact()
    assert rows(table.lookup([0, 1])) == [(0, "new")]
    with pytest.raises(ValueError, match="source"):
        table.apply_batch(part, 1, "a/b")
    with pytest.raises(Exception, match="no whole key"):
        table.apply_batch(feed(spark, (None, "x", "INSERT", 1)), 1)
    assert table._pending() == []


def test_old_tombstones_go_with_the_base(spark, scratch, database):
    table, _ = make(spark, scratch, database, 4)
    table.apply_batch(feed(spark, (1, None, "DELETE", 5)), 0)
    assert table.compact(forget_before="2025-01-01") == [BASE]
    assert table.state().count() == 3 and table.compact() == []


def test_another_session_finds_the_runs(spark, scratch, database):
    table, _ = make(spark, scratch, database, 50)
    table.apply_batch(feed(spark, (7, "new", "UPDATE", 5)), 0)
    for run in table.runs():
        spark.sql(f"DROP TABLE IF EXISTS {table._table(run.name)}")
    again = LevelledTable(spark, f"{scratch}/t", database, ["k"], ["k", "v"], tiebreak=["n"], buckets=4)
    assert again.read().count() == 50 and rows(again.lookup([7])) == [(7, "new")]
    with pytest.raises(FileNotFoundError):
        LevelledTable(spark, f"{scratch}/none", database, ["k"], ["k", "v"]).read()
