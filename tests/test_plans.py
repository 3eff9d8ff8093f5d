"""Physical plans the jobs must get."""

import re

import pytest
from conftest import DATA, plan_of, rows
from pyspark.sql import functions as F

from tideload.operators.joins import (
    attach_one_row,
    hot_keys,
    lookup_join,
    not_in,
    split_hot_join,
    with_match,
    without_match,
)
from tideload.operators.merge import merge_changes
from tideload.operators.publish import save_table
from tideload.queries import QUERIES
from tideload.queries.merging import ORDER_KEY, ORDER_TIEBREAK, order_changes
from tideload.queries.registry import Tables, clear_query_data
from tideload.sources.inline import inline_rows

FOLDER = str(DATA / "sf0.001")


@pytest.fixture
def t(spark):
    return Tables(spark, FOLDER)


def exchanges(plan):
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_window_form_has_one_exchange_and_a_map_side_limit(t):
    plan = plan_of(merge_changes(t.orders, order_changes(t), ORDER_KEY, tiebreak=ORDER_TIEBREAK, form="window"))
    assert exchanges(plan) == 1
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "NestedLoop" not in plan


def test_lookup_form_does_not_exchange_the_base(t):
    plan = plan_of(merge_changes(t.orders, order_changes(t), ORDER_KEY, tiebreak=ORDER_TIEBREAK, form="lookup", unique_base=True))
    assert "NestedLoop" not in plan and "SortMergeJoin" not in plan
    first = plan[: plan.index("BroadcastExchange")]
    assert "o_orderkey" in first and "Exchange hashpartitioning" not in first


def test_join_form_reads_a_bucketed_base_without_exchange(spark, t):
    save_table(t.orders, "plan_orders", ORDER_KEY, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.table("plan_orders")
        plan = plan_of(
            merge_changes(
                base, order_changes(t), ORDER_KEY, tiebreak=ORDER_TIEBREAK, form="join", unique_base=True, key_partitioned=True
            )
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin") :]
    base_side = join[: join.index("FileScan")]
    assert "FullOuter" in join and "Exchange" not in base_side
    spark.sql("DROP TABLE plan_orders")


def test_auto_form_follows_the_sizes(spark, t):
    args = (t.orders, order_changes(t), ORDER_KEY)
    assert "LeftAnti" in plan_of(merge_changes(*args, tiebreak=ORDER_TIEBREAK, unique_base=True))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        more_changes = plan_of(merge_changes(*args, tiebreak=ORDER_TIEBREAK, unique_base=True))
        more_base = t.orders
        for _ in range(5):
            more_base = more_base.unionByName(more_base)
        fewer_changes = plan_of(merge_changes(more_base, *args[1:], tiebreak=ORDER_TIEBREAK, unique_base=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FullOuter" not in more_changes and "LeftAnti" not in more_changes
    assert "FullOuter" in fewer_changes and "LeftAnti" not in fewer_changes


@pytest.mark.parametrize("limit", ["10485760", "-1"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_needs_a_nested_loop_or_product(spark, name, limit):
    """With broadcasting, and without it, as with large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        plan = plan_of(QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    clear_query_data(spark)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["extract_since_watermark"](spark, FOLDER).select("o_orderkey"))
    assert "GreaterThan(o_orderdate,2000-01-01" in plan
    assert "o_totalprice" not in plan.split("ReadSchema")[1]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, rows_=60000):
    fact = spark.range(0, rows_, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).alias("k"), F.col("id").alias("v")
    )
    dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    return fact, dim


def test_run_time_splits_a_hot_partition(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact, dim = skewed(spark)
        df = lookup_join(fact, dim, ["k"])
        assert "isSkewJoin=true" in final_plan(df) or "skew=true" in final_plan(df)
        assert df.count() == 60000
    finally:
        for k in settings:
            spark.conf.unset(k)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_hot_join_equals_plain_join(spark, how):
    fact, dim = skewed(spark, 3000)
    fact = fact.unionByName(spark.range(900).select(F.lit(None).cast("bigint").alias("k"), F.col("id").alias("v")))
    dim = dim.where("k % 7 <> 3")
    got = split_hot_join(fact, dim, ["k"], how, share=0.01)
    assert rows(got) == rows(fact.join(dim, "k", how))
    keys = {r.k for r in hot_keys(fact, ["k"], 0.01).collect()}
    assert keys == {1, None}


def test_lookup_join_splits_itself_when_the_session_does_not(spark):
    fact, dim = skewed(spark, 3000)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = lookup_join(fact, dim, ["k"], "left")
        assert "LeftSemi" in plan_of(df)
        got = rows(df)
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == rows(fact.join(dim, "k", "left"))


def test_not_in_follows_null_rules(spark):
    left = inline_rows(spark, [(1,), (2,), (None,)], "k int")
    some = inline_rows(spark, [(2,), (2,)], "x int")
    with_null = inline_rows(spark, [(2,), (None,)], "x int")
    assert rows(not_in(left, "k", some, "x")) == [(1,)]
    assert rows(not_in(left, "k", with_null, "x")) == []
    assert rows(not_in(left, "k", some.where("x > 5"), "x")) == [(1,), (2,), (None,)]


def test_semi_and_anti(spark):
    left = inline_rows(spark, [(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    right = inline_rows(spark, [(2,), (2,), (3,)], "k int")
    assert rows(with_match(left, right, ["k"])) == [(2, "b"), (3, "c")]
    assert rows(without_match(left, right, ["k"])) == [(1, "a")]


def test_one_row_is_enforced(spark):
    df = spark.range(3)
    one = inline_rows(spark, [("p",)], "x string")
    assert attach_one_row(df, one, {"prefix": "x"}).count() == 3
    assert attach_one_row(df, one.where("x = 'q'"), {"prefix": "x"}).count() == 0
    two = inline_rows(spark, [("p",), ("q",)], "x string")
    with pytest.raises(Exception, match="(?i)more than one row|SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        attach_one_row(df, two, {"prefix": "x"}).collect()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_fanout_join_equals_plain_join_without_broadcasting_the_table(spark, how):
    from tideload.operators.joins import fanout_join

    fact, dim = skewed(spark, 3000)
    many = dim.unionByName(dim.withColumn("w", F.col("w") + 1)).where("k % 7 <> 3")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = fanout_join(fact, many, ["k"], how)
        plan = plan_of(df)
        got = rows(df)
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_part" in plan and got == rows(fact.join(many, "k", how))
    assert got == rows(fanout_join(fact, many, ["k"], how))


def test_expand_up_to_uses_the_numbers_that_exist(spark):
    from tideload.operators.joins import expand_up_to

    steps = inline_rows(spark, [(1, "first"), (5_000_000, "second"), (9_000_000, "third")], "n int, name string")
    last = steps.where("name = 'second'").select("n")
    got = rows(expand_up_to(spark.range(3), steps, "n", last), "id", "n", "name")
    assert got == sorted([(i, n, s) for i in range(3) for n, s in ((1, "first"), (5_000_000, "second"))], key=str)


def test_a_booking_without_a_flag_takes_its_slot(spark):
    from tideload.plans.appointments import free_slots

    slots = inline_rows(spark, [(1, s, 1, u) for s, u in ((10, False), (20, False), (30, False), (40, True))], "doctor_id int, start_time int, overbook_count int, is_used boolean")
    booked = inline_rows(spark, [(1, 10, None), (1, 20, False)], "doctor_id int, start_time int, is_overbooked boolean")
    got = rows(free_slots(slots, booked), "start_time", "is_shared")
    assert got == [(20, True), (30, False)]
