"""Tables in files by key range: what a merge reads, rewrites and commits."""

import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tideload.operators.merge import merge_changes, merge_latest
from tideload.operators import ranged
from tideload.operators.ranged import RangedTable, interval_of

CHANGES = "k int, v string, header__operation string, ts string"


def changes(spark, *data):
    df = spark.createDataFrame(list(data), CHANGES)
    return df.withColumn("header__timestamp", F.col("ts").cast("timestamp_ntz")).drop("ts")


def base(spark, count):
    return spark.range(count).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("b"), "id").alias("v"))


@pytest.fixture
def table(spark, scratch):
    table = RangedTable(spark, f"{scratch}/t", ["k"])
    table.create(base(spark, 100_000), files=50)
    return table


def test_a_small_change_rewrites_the_files_of_its_keys(spark, table):
    """0.1 % of the keys, next to each other."""
    before = table.manifest.versions()[-1]
    files = {r.file for r in table.manifest.read().collect()}
    feed = changes(spark, *[(k, "new", "UPDATE", "2024-01-01") for k in range(70_000, 70_100)], (100_000, "added", "INSERT", "2024-01-01"))
    done = table.merge(feed)
    assert done.files == len(files) == 50 and 1 <= done.rewritten <= 3
    kept = {r.file for r in table.manifest.read().collect()} & files
    assert len(kept) == 50 - done.rewritten
    # A reader of the earlier manifest sees the earlier rows.
    assert table.read(before).where("v = 'new'").count() == 0 and table.rows(before) == 100_000
    assert table.read().where("v = 'new'").count() == 100 and table.rows() == 100_001 == table.read().count()
    assert rows(table.read().where("k >= 99999")) == [(100_000, "added"), (99_999, "b99999")]


def test_no_change_is_no_rewrite(spark, table):
    done = table.merge(changes(spark, (1, "x", "BEFOREIMAGE", "2024-01-01")))
    assert (done.rewritten, done.written) == (0, 0) and table.rows() == 100_000


@pytest.mark.parametrize("seed", range(2))
def test_many_merges_equal_plain_ones(spark, scratch, seed):
    rng = random.Random(seed)
    table = RangedTable(spark, f"{scratch}/t", ["a", "b"], file_rows=7)
    start = [(a, rng.choice(["x", "y", None]), f"v{a}") for a in [None, *range(0, 60, 2)]]
    plain = spark.createDataFrame(start, "a int, b string, v string")
    table.create(plain, files=4)
    for step in range(3):
        feed = spark.createDataFrame(
            [(rng.choice([None, *range(70)]), rng.choice(["x", "y", None]), f"s{step}", rng.choice(["INSERT", "UPDATE", "DELETE", "BEFOREIMAGE"]),
              rng.randrange(100)) for _ in range(rng.choice([1, 40]))],
            "a int, b string, v string, header__operation string, n int",
        ).withColumn("header__timestamp", F.timestamp_add("SECOND", F.col("n"), F.lit("2024-01-01").cast("timestamp_ntz")))
        plain = spark.createDataFrame(merge_changes(plain, feed, ["a", "b"], tiebreak=["n", "v"]).collect(), plain.schema)
        table.merge(feed, tiebreak=["n", "v"])
        assert rows(table.read()) == rows(plain)
        lowest = [r.lower for r in table.manifest.read().collect()]
        assert len(lowest) == len(set(lowest))
    everything = plain.select("a", "b", "v", F.lit("DELETE").alias("header__operation"), F.lit("2025-01-01").cast("timestamp_ntz").alias("header__timestamp"))
    table.merge(everything)
    assert rows(table.read()) == [] and table.rows() == 0
    table.merge(everything.limit(2).withColumn("header__operation", F.lit("INSERT")))
    assert table.read().count() == 2


def test_rows_without_operations(spark, scratch):
    table = RangedTable(spark, f"{scratch}/t", ["k"])
    stored = spark.createDataFrame([(1, "a", 5), (2, "b", 5), (9, "z", 5)], "k int, v string, at int")
    table.create(stored, files=3)
    feed = spark.createDataFrame([(1, "old", 4), (2, "new", 6), (3, "c", 1)], "k int, v string, at int")
    table.merge(feed, op=None, ts="at")
    assert rows(table.read()) == rows(merge_latest(stored, feed, ["k"], ts="at"))


def test_a_merge_that_fails_leaves_nothing_but_a_folder(spark, table, monkeypatch):
    feed = changes(spark, (5, "new", "UPDATE", "2024-01-01"))
    version = table.manifest.versions()

    def fail(*_):
        raise InterruptedError

    monkeypatch.setattr(table.manifest, "publish", fail)
    with pytest.raises(InterruptedError):
        table.merge(feed)
    monkeypatch.undo()
    assert table.manifest.versions() == version and table.read().where("v = 'new'").count() == 0
    table.merge(feed)
    from tideload.files import folder_names

    assert len(folder_names(spark, f"{table.path}/data")) == 3
    table.vacuum(keep=1)
    assert len(folder_names(spark, f"{table.path}/data")) == 2 and table.rows() == 100_000
    assert rows(table.read().where("k = 5")) == [(5, "new")]


def test_many_new_rows_of_one_range_become_many_files(spark, scratch):
    table = RangedTable(spark, f"{scratch}/t", ["k"], file_rows=1000)
    table.create(base(spark, 10), files=1)
    new = base(spark, 20_000).select("k", "v", F.lit("INSERT").alias("header__operation"), F.lit("2024-01-01").cast("timestamp_ntz").alias("header__timestamp"))
    assert table.merge(new).written >= 20
    assert table.rows() == 20_000 and table.merge(changes(spark, (10_500, "x", "UPDATE", "2024-01-02"))).rewritten == 1


def test_the_range_of_a_key_is_found_by_halving(spark):
    values = spark.range(-1, 40).select(F.col("id").cast("int").alias("k"), F.array(*[F.lit(b) for b in (0, 3, 4, 10, 30)]).alias("bounds"))
    got = dict(rows(values.select("k", interval_of(F.col("k"), F.col("bounds"), 5))))
    assert got == {k: sum(b <= k for b in (0, 3, 4, 10, 30)) for k in got}


def test_no_products_and_no_python_step(spark, table):
    feed = changes(spark, (5, "new", "UPDATE", "2024-01-01"))
    plan = plan_of(table._sliced(feed, table._bounds(table.manifest.read()), 50))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert table.read_ranges_of(feed).count() <= 4000


def test_stored_rows_are_added_to_where_they_lie(spark, scratch, monkeypatch):
    """No exchange of a table's rows; its files and a delta of a few files meet one by one."""
    table = RangedTable(spark, f"{scratch}/t", ["k"])
    table.create(spark.range(1000).select("id", F.lit(1).alias("n")).withColumnsRenamed({"id": "k"}), files=8)
    monkeypatch.setattr(table, "_placed", lambda *_, **__: pytest.fail("exchanged"))
    delta = spark.createDataFrame([(-5, 1), (3, 4), (4, -1), (999, 1), (2000, 7), (2001, 0)], "k long, n int")
    done = table.add(delta, "n", "run")
    assert (done.files, done.rewritten, done.written) == (8, 2, 2) and table.tag() == "run"
    want = {**dict.fromkeys(range(1000), 1), -5: 1, 3: 5, 999: 2, 2000: 7}
    del want[4]
    assert dict(rows(table.read())) == want and table.rows() == len(want)
    assert table.add(delta.limit(0), "n").rewritten == 0 and table.rows() == len(want)


@pytest.mark.parametrize("cells", [1 << 24, 12])
def test_many_deltas_equal_plain_sums(spark, scratch, monkeypatch, cells):
    """With files that one task takes and with files that are too large for it, NULL keys and keys below the lowest."""
    monkeypatch.setattr(ranged, "ADDED_CELLS", cells)
    rng = random.Random(cells)
    table = RangedTable(spark, f"{scratch}/t", ["a", "b"])
    schema = "a int, b string, n long, v long"
    plain = {(a, b): [2, a] for a in range(20, 60, 2) for b in ("x", None)}
    table.create(spark.createDataFrame([(*k, *v) for k, v in plain.items()], schema), files=4, unique=True)
    for _ in range(3):
        delta = {(rng.choice([None, *range(70)]), rng.choice(["x", "y", None])): [rng.choice([-2, 1]), rng.randrange(9)] for _ in range(30)}
        table.add(spark.createDataFrame([(*k, *v) for k, v in delta.items()], schema), "n")
        for k, v in delta.items():
            plain[k] = [x + y for x, y in zip(plain.get(k, [0, 0]), v, strict=True)]
        plain = {k: v for k, v in plain.items() if v[0] > 0}
        assert rows(table.read()) == sorted([(*k, *v) for k, v in plain.items()], key=str)
    assert table.rows() == len(plain)
    gone = spark.createDataFrame([(*k, -n, 0) for k, (n, _) in plain.items()], schema)
    table.add(gone, "n")
    assert table.rows() == 0 and rows(table.read()) == []
    table.add(spark.createDataFrame([(1, "x", 1, 1)], schema), "n")
    assert rows(table.read()) == [(1, "x", 1, 1)]


def test_a_file_out_of_order_is_not_committed(spark, table):
    spark.range(10).select(F.col("id").cast("int").alias("k"), F.lit("v").alias("v"), F.lit(0).alias("_slice")).coalesce(1).orderBy(F.desc("k")).write.partitionBy("_slice").parquet(f"{table.path}/data/odd")
    with pytest.raises(Exception, match="not in key order"):
        table._files_in("odd", table._schema()).collect()
