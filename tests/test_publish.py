import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tideload.operators.publish import (
    BUCKET,
    VersionedTable,
    append_rows,
    ensure_table,
    full_load,
    merge_into_buckets,
    publish_swap,
    save_table,
    truncate_table,
    write_bucketed,
)

CHANGES = "k int, v string, header__operation string, header__timestamp timestamp_ntz"


def changes(spark, *data):
    df = spark.createDataFrame([(k, v, op) for k, v, op in data], "k int, v string, header__operation string")
    return df.withColumn("header__timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))


def test_versions(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/t")
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.publish(spark.range(3)) == 1
    assert table.publish(table.read().where("id > 0")) == 2
    assert rows(table.read()) == [(1,), (2,)] and table.read(1).count() == 3
    table.publish(table.read())
    table.vacuum(keep=1)
    assert table.versions() == [3]


def test_a_failed_write_changes_nothing(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/t")
    table.publish(spark.range(3))
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        table.publish(broken)
    os.makedirs(f"{scratch}/t/v=2", exist_ok=True)
    assert table.versions() == [1] and table.read().count() == 3
    assert table.publish(spark.range(5)) == 2 and table.read().count() == 5


def test_swap_and_table_commands(spark):
    spark.sql("CREATE DATABASE swap_db")
    full_load(spark.range(3), "swap_db.t_final")
    save_table(spark.table("swap_db.t_final").where("id > 1"), "swap_db.t_stg")
    publish_swap(spark, "swap_db.t_stg", "swap_db.t_final")
    assert rows(spark.table("swap_db.t_final")) == [(2,)]
    assert [r.tableName for r in spark.sql("SHOW TABLES IN swap_db").collect()] == ["t_final"]
    save_table(spark.range(1), "swap_db.new_stg")
    publish_swap(spark, "swap_db.new_stg", "swap_db.new_final")
    assert spark.table("swap_db.new_final").count() == 1
    ensure_table(spark, "swap_db.t_final", spark.range(1).schema)
    append_rows(spark.range(2), "swap_db.t_final")
    assert spark.table("swap_db.t_final").count() == 3
    truncate_table(spark, "swap_db.t_final")
    assert spark.table("swap_db.t_final").count() == 0


def test_bucketed_merge_rewrites_touched_buckets_only(spark, scratch):
    path = f"{scratch}/b"
    base = spark.range(100).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("b"), "id").alias("v"))
    write_bucketed(base, path, ["k"], 16)
    files = {f"{d}/{f}" for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    feed = changes(spark, (5, "five", "UPDATE"), (7, "", "DELETE"), (500, "new", "INSERT"))
    touched = merge_into_buckets(spark, path, feed, ["k"], 16)
    after = {f"{d}/{f}" for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    kept = {f for f in files if int(f.split(f"{BUCKET}=")[1].split("/")[0]) not in touched}
    assert len(touched) <= 3 and kept <= after and len(files & after) == len(kept)
    got = dict(rows(spark.read.parquet(path), "k", "v"))
    assert got[5] == "five" and 7 not in got and got[500] == "new" and len(got) == 100


def test_a_bucket_that_loses_its_last_row_is_emptied(spark, scratch):
    path = f"{scratch}/b"
    write_bucketed(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"), path, ["k"], 64)
    feed = changes(spark, (2, "", "DELETE"))
    for _ in range(2):
        merge_into_buckets(spark, path, feed, ["k"], 64)
        assert rows(spark.read.parquet(path), "k", "v") == [(1, "a"), (3, "c")]
    assert merge_into_buckets(spark, path, feed.limit(0), ["k"], 64) == []


def test_a_merge_keeps_the_buckets_without_moving_the_base(spark):
    from conftest import plan_of
    from tideload.operators.merge import merge_changes

    base = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("b"), "id").alias("v"))
    save_table(base, "placed_base", ["k"], 8)
    feed = changes(spark, (5, "five", "UPDATE"), (7, "", "DELETE"), (5000, "new", "INSERT"))
    merged = merge_changes(spark.table("placed_base"), feed, ["k"], form="join", unique_base=True, key_partitioned=True)
    save_table(merged, "placed_next", ["k"], 8, placed=True)
    location = spark.sql("DESCRIBE EXTENDED placed_next").where("col_name = 'Location'").first().data_type
    files = [f for f in os.listdir(location.removeprefix("file:")) if f.endswith(".parquet")]
    assert len(files) == 8
    both = spark.table("placed_next").join(spark.table("placed_next").withColumnRenamed("v", "w"), "k")
    assert "Exchange hashpartitioning" not in plan_of(both.hint("merge"))
    got = dict(rows(spark.table("placed_next")))
    assert got[5] == "five" and 7 not in got and got[5000] == "new" and len(got) == 1000
    # Rows are found by bucket, so each lies in the bucket of its key.
    assert spark.table("placed_next").where("k = 5000").count() == 1
    for name in ("placed_base", "placed_next"):
        spark.sql(f"DROP TABLE {name}")


def test_change_files_are_merged_once_and_archived(spark, scratch):
    from tideload.plans.cycles import run_change_files
    from tideload.plans.loads import LoadSpec, run_full
    from tideload.sources.metadata import Field, TableMeta

    meta = TableMeta("t", (Field("k", "int", True), Field("v", "varchar", False)))
    spec = LoadSpec.from_metadata(meta)
    run_full(spec, spark.createDataFrame([(1, "one")], "k int, v string"), f"{scratch}/root")
    folders = (f"{scratch}/in", f"{scratch}/archive", f"{scratch}/root")
    versions = VersionedTable(spark, f"{scratch}/root/t")
    assert run_change_files(spark, spec, meta, *folders) == 0 and versions.versions() == [1]
    os.makedirs(folders[0])
    for name, line in (("a.csv", "0,0,0,0,UPDATE,1,2024-01-01 00:00:00,1,new"), ("b.csv", "0,0,0,0,INSERT,1,2024-01-01 00:00:00,2")):
        with open(f"{folders[0]}/{name}", "w") as out:
            out.write(line + "\n")
    assert run_change_files(spark, spec, meta, *folders, rejects=f"{scratch}/rejects") == 2
    assert rows(versions.read()) == [(1, "new")]
    assert [r.reason for r in spark.read.parquet(f"{scratch}/rejects").collect()] == ["number of fields"]
    assert sorted(os.listdir(folders[1])) == ["a.csv", "b.csv"]
    assert not [f for f in os.listdir(folders[0]) if f.endswith(".csv") and not f.startswith(".")]
    assert run_change_files(spark, spec, meta, *folders) == 0
