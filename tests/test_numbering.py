import pytest
from pyspark.sql import functions as F

from tideload.files import file_names
from tideload.operators.numbering import dense_number, with_load_time, with_surrogate
from tideload.session import clear_staged, fresh_dir


@pytest.mark.parametrize("partitions", [1, 13])
def test_numbers_are_dense_and_ordered(spark, partitions):
    # A third of the rows share the leading order column.
    df = spark.range(0, 5000, 1, partitions).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") * 7919) % 1000).alias("a"), F.col("id").alias("b")
    )
    got = dense_number(df, ["a", "b"], "n", start=100).collect()
    expected = sorted((r.a, r.b) for r in got)
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.n)] == expected
    assert sorted(r.n for r in got) == list(range(100, 5100))


def test_rows_are_placed_once(spark):
    numbered = dense_number(spark.range(1000), ["id"], "n")
    assert numbered.collect() and rows_of(numbered) == rows_of(numbered)
    assert numbered.count() == numbered.select("n").distinct().count() == 1000


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_no_rows(spark):
    assert dense_number(spark.range(0), ["id"], "n").count() == 0


def test_surrogate_comes_first(spark):
    df = with_surrogate(spark.range(3), ["id"], "key")
    assert df.columns == ["key", "id"] and rows_of(df) == [(1, 0), (2, 1), (3, 2)]


def test_load_time(spark):
    fixed = with_load_time(spark.range(1), F.lit("2024-01-01").cast("timestamp_ntz"), "Asia/Kolkata")
    assert str(fixed.first().lastmodifieddate) == "2024-01-01 05:30:00"
    assert dict(with_load_time(spark.range(1)).dtypes)["lastmodifieddate"] == "timestamp_ntz"


def test_staged_data_lies_in_the_shared_folder_and_can_be_cleared(spark):
    path = fresh_dir(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(3).write.parquet(path)
    assert file_names(spark, path)
    clear_staged(spark)
    assert not file_names(spark, path)
