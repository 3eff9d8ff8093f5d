from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideload.functions.casting import spark_type
from tideload.operators.audit import advance_watermark, count_mismatches, init_watermark, key_check
from tideload.operators.cells import encode_cells, from_cells, to_cells
from tideload.plans.loads import LoadSpec
from tideload.sources.delimited import read_changes, read_snapshot, read_snapshot_checked, write_snapshot
from tideload.sources.extract import extract_since, jdbc_reader, land
from tideload.sources.metadata import (
    Field,
    TableMeta,
    discover_metadata,
    discover_metadata_by_constraint,
    meta_of,
    metadata_frame,
    read_metadata,
    table_metas,
    write_metadata,
)

META = TableMeta(
    "rooms",
    (
        Field("RoomId", "bigint", True),
        Field("Name", "varchar", False),
        Field("IsActive", "bit", False),
        Field("Level", "tinyint", False),
        Field("Price", "numeric", False),
        Field("CreatedTime", "datetime", False),
        Field("Remark", "varchar", False),
    ),
)


def text_file(folder, content, name="part.csv"):
    path = f"{folder}/{name}"
    with open(path, "w", newline="") as out:
        out.write(content)
    return path


def test_snapshot_types_and_hard_values(spark, scratch):
    path = text_file(
        scratch,
        '1,"a, b",1,200,1.5,2024-01-02 03:04:05.678,x\n2,"say ""hi""",0,0,,,\n',
    )
    got = read_snapshot(spark, path, META).orderBy("RoomId").collect()
    assert (got[0].Name, got[0].IsActive, got[0].Level, str(got[0].Price)) == ("a, b", True, 200, "1.500000")
    assert got[0].CreatedTime == datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert (got[1].Name, got[1].IsActive, got[1].Price, got[1].CreatedTime) == ('say "hi"', False, None, None)
    assert len(got) == 2


def test_line_breaks_inside_values(spark, scratch):
    path = text_file(scratch, '1,"two\nlines",1,1,1,2024-01-02 00:00:00,x\n')
    assert read_snapshot(spark, path, META, multiline=True).first().Name == "two\nlines"


def test_malformed_rows_are_rejected_not_lost(spark, scratch):
    path = text_file(scratch, "1,a,1,5,1.0,2024-01-02 00:00:00,x\nx,b,1,5,1.0,2024-01-02 00:00:00,y\n3,c,1,5,1e,,z\n")
    good, bad = read_snapshot_checked(spark, path, META)
    assert [r.RoomId for r in good.collect()] == [1]
    assert sorted(r.RoomId for r in bad.collect()) == ["3", "x"]
    path = text_file(scratch, "1,a,1,5,1.0\n2,a,1,5,1.0,2024-01-02 00:00:00,x,more\n3,a,1,5,1.0,,x\n", "other.csv")
    good, bad = read_snapshot_checked(spark, path, META)
    assert [r.RoomId for r in good.select("RoomId").collect()] == [3]
    assert [r.reason for r in bad.select("reason").collect()] == ["number of fields"] * 2


def test_line_breaks_and_backslashes_survive_by_default(spark, scratch):
    hard = ["two\nlines", "\r\n", "back\\slash", "\\n", "\\\n\\\\n", "\\N", "\\", "", None, 'quote " , and \n break']
    df = spark.createDataFrame(list(enumerate(hard)), "id int, a string")
    meta = meta_of("t", df.schema, ["id"])
    write_snapshot(df, f"{scratch}/out")
    good, bad = read_snapshot_checked(spark, f"{scratch}/out", meta)
    assert rows(good) == rows(df) and bad.count() == 0
    path = text_file(scratch, "1,C:\\new\n")
    assert read_snapshot(spark, path, meta, escaped=False).first().a == "C:\\new"


def test_empty_and_missing_text_survive(spark, scratch):
    schema = "id bigint, a string, b string"
    df = spark.createDataFrame([(1, "", None), (2, None, ""), (3, "\\N", ' pad "q" ,')], schema)
    meta = meta_of("t", df.schema, ["id"])
    write_snapshot(df.where("id < 3"), f"{scratch}/out")
    assert rows(read_snapshot(spark, f"{scratch}/out", meta)) == rows(df.where("id < 3"))
    write_snapshot(df.where("id = 3").withColumn("a", F.lit("x")), f"{scratch}/out3")
    assert rows(read_snapshot(spark, f"{scratch}/out3", meta)) == [(3, "x", ' pad "q" ,')]


def test_every_type_survives(spark, scratch):
    df = spark.createDataFrame(
        [(1, True, 1.5, datetime(2024, 1, 2, 3, 4, 5, 6), bytearray(b"\x00\xff")), (2, None, None, None, None)],
        "id int, flag boolean, x double, ts timestamp_ntz, raw binary",
    ).withColumn("d", F.col("ts").cast("date"))
    meta = meta_of("t", df.schema, ["id"])
    assert [f.dataType for f in meta.struct()] == [f.dataType for f in df.schema]
    write_snapshot(df, f"{scratch}/out")
    assert rows(read_snapshot(spark, f"{scratch}/out", meta)) == rows(df)


def test_change_file(spark, scratch):
    meta = TableMeta("t", (Field("Id", "bigint", True), Field("Name", "varchar", False)))
    path = text_file(scratch, "a,b,c,d,UPDATE,00017,2024-01-01 10:00:00.25,5,Five\n")
    row = read_changes(spark, path, meta).first()
    assert (row.header__operation, row.h5, row.Id, row.Name) == ("UPDATE", "00017", 5, "Five")
    assert row.header__timestamp == datetime(2024, 1, 1, 10, 0, 0, 250000)


def test_unknown_type():
    assert spark_type(" TINYINT ") == T.ShortType()
    assert spark_type("numeric", T.DecimalType(10, 2)) == T.DecimalType(10, 2)
    with pytest.raises(ValueError, match="geography"):
        spark_type("geography")


def test_metadata_files(spark, scratch):
    text_file(scratch, "FieldName,DataType,IsPrimary\r\nId,bigint,1\r\nName,varchar,0\r\n", "Rooms.csv")
    text_file(scratch, "name,character varying,0\nkey,integer,1\n", "dim_room.csv")
    text_file(scratch, "FieldName,DataType,IsPrimary\nA,char,1\nB,varchar,1\nC,varchar,1\nT,datetime,0\n", "Latch.csv")
    found = table_metas(read_metadata(spark, scratch))
    assert found["Rooms"].columns == ["Id", "Name"] and found["Rooms"].keys == ["Id"]
    assert found["dim_room"].columns == ["name", "key"] and found["dim_room"].keys == ["key"]
    assert found["Latch"].keys == ["A", "B", "C"] and found["Latch"].others == ["T"]
    assert LoadSpec.from_metadata(found["dim_room"]).columns == ["key", "name"]
    with pytest.raises(ValueError, match="no key"):
        LoadSpec.from_metadata(TableMeta("x", (Field("a", "int", False),)))


def test_metadata_round_trip(spark, scratch):
    write_metadata(metadata_frame(spark, [META]), f"{scratch}/meta")
    assert table_metas(read_metadata(spark, f"{scratch}/meta"))["rooms"].fields == META.fields


def test_discovery_orders_keys_first_and_skips_tables_without(spark):
    columns = spark.createDataFrame(
        [(1, 1, "zip", 10), (1, 2, "id", 11), (2, 1, "a", 10)],
        "object_id int, column_id int, column_name string, user_type_id int",
    )
    types = spark.createDataFrame([(10, "varchar"), (11, "bigint")], "user_type_id int, type_name string")
    index_columns = spark.createDataFrame([(1, 2, 1), (1, 1, 2)], "object_id int, column_id int, index_id int")
    indexes = spark.createDataFrame([(1, 1, True), (1, 2, False)], "object_id int, index_id int, is_primary_key boolean")
    got = [tuple(r) for r in discover_metadata(columns, types, index_columns, indexes).collect()]
    assert got == [(1, "id", "bigint", 1), (1, "zip", "varchar", 0)]


def test_discovery_by_constraint(spark):
    tc = spark.createDataFrame(
        [("s", "pk_a", "a", "PRIMARY KEY"), ("s", "ck_b", "b", "CHECK")],
        "constraint_schema string, constraint_name string, table_name string, constraint_type string",
    )
    ccu = spark.createDataFrame(
        [("s", "pk_a", "id"), ("s", "ck_b", "x")], "constraint_schema string, constraint_name string, column_name string"
    )
    col = spark.createDataFrame(
        [("s", "a", "id", "bigint"), ("s", "a", "v", "text"), ("s", "b", "x", "int"), ("s", "c", "y", "int")],
        "table_schema string, table_name string, column_name string, data_type string",
    )
    got = rows(discover_metadata_by_constraint(tc, ccu, col))
    assert got == [("a", "id", "bigint", 1), ("a", "v", "text", 0), ("b", "x", "int", 0)]


def test_watermark(spark, scratch):
    df = spark.createDataFrame([(i, datetime(2024, 1, i)) for i in range(1, 6)], "id int, ts timestamp_ntz")
    empty = spark.createDataFrame([], "table_name string, run_time timestamp_ntz")
    control = init_watermark(empty, "t", F.lit("2024-01-03"))
    for pushed in (True, False):
        assert [r.id for r in extract_since(df, "ts", control, "t", pushed).collect()] == [4, 5]
        assert extract_since(df, "ts", control, "unknown", pushed).count() == 0
    extract = extract_since(df, "ts", control, "t")
    moved = advance_watermark(control, extract, "ts", "t")
    assert rows(moved) == [("t", datetime(2024, 1, 5))]
    assert rows(advance_watermark(moved, extract.where("id > 9"), "ts", "t")) == [("t", datetime(2024, 1, 5))]
    with pytest.raises(ValueError, match="mode"):
        land(df, scratch, "replace")


def test_jdbc_reader_is_only_a_reader(spark):
    assert callable(jdbc_reader(spark, {"url": "jdbc:none"}))


def test_cells(spark):
    df = spark.createDataFrame(
        [(1, "a", "x", True), (2, None, None, False)], "id int, part string, name string, flag boolean"
    )
    cells = to_cells(df, ["id", "part"])
    assert rows(cells, "rowkey", "qualifier", "value") == [
        ("1_a", "flag", "1"),
        ("1_a", "name", "x"),
        ("2_", "flag", "0"),
        ("2_", "name", ""),
    ]
    assert encode_cells(cells).where("rowkey = X'315F61'").count() == 2
    assert rows(from_cells(cells, ["name", "flag"])) == [("1_a", "x", "1"), ("2_", "", "0")]


def test_counts_and_key_check(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "tablename string, count bigint")
    b = spark.createDataFrame([("x", 1), ("y", 3), ("z", 1)], "tablename string, count bigint")
    assert rows(count_mismatches(a, b)) == [("y", 2, 3), ("z", None, 1)]
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a int, b int")
    assert rows(key_check({"t": (df, ["a", "b"])})) == [("t", "a,b", 3, 2)]


def test_extracts_land_once_and_advance(spark, scratch):
    from tideload.operators.audit import advance_watermark
    from tideload.operators.publish import VersionedTable
    from tideload.plans.extracts import control_of, landed_rows, ledger_of, run_extracts, vacuum_landing
    from tideload.sources.extract import jdbc_reader

    day = lambda d: datetime(2024, 1, d)
    now = {"a": [(1, day(1)), (2, day(2))], "b": []}
    reader = lambda t: spark.createDataFrame(now[t], "id int, ts timestamp_ntz")
    args = ({"a": "ts", "b": "ts"}, f"{scratch}/control", f"{scratch}/landing")
    control = VersionedTable(spark, f"{scratch}/control")
    run_extracts(spark, reader, *args, "one")
    assert rows(control_of(control), "table_name", "run_time") == [("a", day(2)), ("b", None)]
    now["a"].append((3, day(3)))
    now["b"].append((1, day(1)))
    # A run that fails before it commits, and is repeated: its folder is replaced.
    with pytest.raises(KeyError):
        run_extracts(spark, reader, {"a": "ts", "c": "ts"}, *args[1:], "two", workers=1)
    for _ in range(2):
        run_extracts(spark, reader, *args, "two")
    assert rows(landed_rows(control, "a"), "id") == [(1,), (2,), (3,)]
    assert rows(landed_rows(control, "b"), "id") == [(1,)]
    assert rows(control_of(control), "table_name", "run_time") == [("a", day(3)), ("b", day(1))]
    # A run that failed, and another one in its place: rows landed by both count once.
    now["a"].append((4, day(4)))
    with pytest.raises(KeyError):
        run_extracts(spark, reader, {"a": "ts", "c": "ts"}, *args[1:], "three", workers=1)
    run_extracts(spark, reader, *args, "four")
    assert rows(landed_rows(control, "a"), "id") == [(1,), (2,), (3,), (4,)]
    assert rows(landed_rows(control, "a", "four"), "id") == [(4,)]
    assert [r.rows for r in ledger_of(control).where("table_name = 'a'").orderBy("commit_number").collect()] == [2, 1, 1]
    assert vacuum_landing(control, f"{scratch}/landing") == [f"{scratch}/landing/a/run=three"]
    assert landed_rows(control, "a").count() == 4 and vacuum_landing(control, f"{scratch}/landing") == []
    with pytest.raises(FileNotFoundError, match="no run"):
        landed_rows(control, "c")
    # A table that the control does not know gets its row.
    known = spark.createDataFrame([("a", day(1))], "table_name string, run_time timestamp_ntz")
    moved = advance_watermark(known, reader("b"), "ts", "b")
    assert rows(moved) == [("a", day(1)), ("b", day(1))]
    assert rows(advance_watermark(known, reader("b").limit(0), "ts", "b")) == [("a", day(1))]
    with pytest.raises(ValueError, match="no bounds"):
        jdbc_reader(spark, {"url": "jdbc:x"})("large")
