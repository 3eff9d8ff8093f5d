"""Merges and latest-row queries.

The change table of ``orders`` is made of all of ``lineitem``: each line is a change
of its order, several per order and several within one second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideload.functions.dates import trunc_second
from tideload.operators.latest import latest_by_aggregate, latest_per_key
from tideload.operators.merge import (
    OPERATION,
    TIMESTAMP,
    apply_deletes,
    apply_puts,
    compact_changes,
    effective_changes,
    merge_changes,
    merge_latest,
)
from tideload.operators.publish import bucket_count, merge_into_buckets, write_bucketed
from tideload.queries.registry import Tables, query

ORDER_KEY = ["o_orderkey"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_TIEBREAK = ["seq_line", "seq_part", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"]


def line_operation() -> Column:
    returned, finished = F.col("l_returnflag"), F.col("l_linestatus") == "F"
    return (
        F.when((returned == "R") & finished, "DELETE")
        .when(returned == "R", "UPDATE")
        .when((returned == "A") & finished, "UPDATE")
        .when(returned == "A", "BEFOREIMAGE")
        .otherwise("INSERT")
    )


def order_changes(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_suppkey").alias("o_custkey"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_shipdate").alias("o_orderdate"),
        F.col("l_returnflag").alias("o_orderpriority"),
        line_operation().alias(OPERATION),
        F.timestamp_add("MILLISECOND", F.col("l_linenumber") * 300, F.col("l_shipdate")).alias(TIMESTAMP),
        F.col("l_linenumber").alias("seq_line"),
        F.col("l_partkey").alias("seq_part"),
    )


_COLS = ", ".join(ORDER_COLUMNS)

ORDER_CHANGES_SQL = """
SELECT l_orderkey AS o_orderkey, l_suppkey AS o_custkey, l_linestatus AS o_orderstatus,
       l_extendedprice AS o_totalprice, l_shipdate AS o_orderdate, l_returnflag AS o_orderpriority,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'DELETE'
            WHEN l_returnflag = 'R' THEN 'UPDATE'
            WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'UPDATE'
            WHEN l_returnflag = 'A' THEN 'BEFOREIMAGE'
            ELSE 'INSERT' END AS header__operation,
       l_shipdate + to_milliseconds(l_linenumber * 300) AS header__timestamp,
       l_linenumber AS seq_line, l_partkey AS seq_part
FROM lineitem"""


def merge_sql(changes: str) -> str:
    return f"""
SELECT {_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY
      date_trunc('second', header__timestamp) DESC NULLS LAST, seq_line DESC NULLS LAST,
      seq_part DESC NULLS LAST, o_custkey DESC, o_totalprice DESC, o_orderpriority DESC, o_orderstatus DESC) AS rnk
  FROM (
    SELECT {_COLS}, 'INSERT' AS header__operation, TIMESTAMP '1900-01-01' AS header__timestamp,
           NULL AS seq_line, NULL AS seq_part
    FROM orders
    UNION ALL
    SELECT {_COLS}, header__operation, header__timestamp, seq_line, seq_part
    FROM ({changes}) AS c WHERE header__operation <> 'BEFOREIMAGE'
  ) AS u
) AS a WHERE rnk = 1 AND header__operation <> 'DELETE'"""


ORDER_MERGE_SQL = merge_sql(ORDER_CHANGES_SQL)


@query("merge_changes", ORDER_MERGE_SQL)
def _merge_changes(t: Tables) -> DataFrame:
    return merge_changes(t.orders, order_changes(t), ORDER_KEY, tiebreak=ORDER_TIEBREAK, unique_base=True)


@query("merge_changes_window", ORDER_MERGE_SQL)
def _merge_changes_window(t: Tables) -> DataFrame:
    return merge_changes(t.orders, order_changes(t), ORDER_KEY, tiebreak=ORDER_TIEBREAK, form="window")


@query("merge_changes_join", ORDER_MERGE_SQL)
def _merge_changes_join(t: Tables) -> DataFrame:
    return merge_changes(t.orders, order_changes(t), ORDER_KEY, tiebreak=ORDER_TIEBREAK, form="join", unique_base=True)


@query("merge_changes_lookup", ORDER_MERGE_SQL)
def _merge_changes_lookup(t: Tables) -> DataFrame:
    return merge_changes(t.orders, order_changes(t), ORDER_KEY, tiebreak=ORDER_TIEBREAK, form="lookup", unique_base=True)


@query("merge_bucketed", ORDER_MERGE_SQL)
def _merge_bucketed(t: Tables) -> DataFrame:
    path = t.scratch("bucketed")
    buckets = bucket_count(t.orders)
    write_bucketed(t.orders, path, ORDER_KEY, buckets)
    merge_into_buckets(t.spark, path, order_changes(t), ORDER_KEY, buckets, tiebreak=ORDER_TIEBREAK)
    return t.spark.read.parquet(path).select(*ORDER_COLUMNS)


# Orders by customer: a base in which most keys repeat.
REPEATED_KEY = ["o_custkey"]
REPEATED_TIEBREAK = ["seq_line", "seq_part", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus"]
REPEATED_SQL = f"""
SELECT {_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
      date_trunc('second', header__timestamp) DESC NULLS LAST, seq_line DESC NULLS LAST,
      seq_part DESC NULLS LAST, o_orderkey DESC, o_totalprice DESC, o_orderdate DESC, o_orderpriority DESC,
      o_orderstatus DESC) AS rnk
  FROM (
    SELECT {_COLS}, 'INSERT' AS header__operation, TIMESTAMP '1900-01-01' AS header__timestamp,
           NULL AS seq_line, NULL AS seq_part
    FROM orders
    UNION ALL
    SELECT {_COLS}, header__operation, header__timestamp, seq_line, seq_part
    FROM ({ORDER_CHANGES_SQL}) AS c WHERE header__operation <> 'BEFOREIMAGE'
  ) AS u
) AS a WHERE rnk = 1 AND header__operation <> 'DELETE'"""


def _merge_repeated(t: Tables, form: str) -> DataFrame:
    merged = merge_changes(t.orders, order_changes(t), REPEATED_KEY, tiebreak=REPEATED_TIEBREAK, form=form)
    return merged.select(*ORDER_COLUMNS)


@query("merge_repeated_base", REPEATED_SQL)
def _merge_repeated_base(t: Tables) -> DataFrame:
    return _merge_repeated(t, "auto")


@query("merge_repeated_base_join", REPEATED_SQL)
def _merge_repeated_base_join(t: Tables) -> DataFrame:
    return _merge_repeated(t, "join")


# A tenth of the orders change: few changes on a large base.
FEW_CHANGES_SQL = f"SELECT * FROM ({ORDER_CHANGES_SQL}) AS c WHERE seq_line = 7"


@query("merge_few_changes", merge_sql(FEW_CHANGES_SQL))
def _merge_few_changes(t: Tables) -> DataFrame:
    few = order_changes(t).where("seq_line = 7")
    return merge_changes(t.orders, few, ORDER_KEY, tiebreak=ORDER_TIEBREAK, unique_base=True)


REINSERT_SQL = f"""{ORDER_CHANGES_SQL}
UNION ALL
SELECT {_COLS}, 'INSERT', TIMESTAMP '2030-01-01', 100, 0 FROM orders WHERE o_orderstatus = 'P'"""


@query("merge_delete_reinsert", merge_sql(REINSERT_SQL))
def _merge_delete_reinsert(t: Tables) -> DataFrame:
    again = t.orders.where("o_orderstatus = 'P'").select(
        *ORDER_COLUMNS,
        F.lit("INSERT").alias(OPERATION),
        F.lit("2030-01-01").cast("timestamp_ntz").alias(TIMESTAMP),
        F.lit(100).alias("seq_line"),
        F.lit(0).cast("bigint").alias("seq_part"),
    )
    changes = order_changes(t).unionByName(again)
    return merge_changes(t.orders, changes, ORDER_KEY, tiebreak=ORDER_TIEBREAK)


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]


@query(
    "merge_composite_key",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY ts DESC,
      l_suppkey DESC NULLS LAST, l_partkey DESC, l_quantity DESC, l_extendedprice DESC) AS rnk
  FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, 'INSERT' AS op,
           TIMESTAMP '1900-01-01' AS ts, NULL AS l_suppkey
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS first
          FROM lineitem) AS d
    WHERE first = 1
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + 1, l_extendedprice,
           CASE l_returnflag WHEN 'R' THEN 'DELETE' WHEN 'A' THEN 'UPDATE' ELSE 'BEFOREIMAGE' END,
           l_shipdate, l_suppkey
    FROM lineitem WHERE l_returnflag IN ('R', 'A')
  ) AS u
) AS a WHERE rnk = 1 AND op <> 'DELETE'""",
)
def _merge_composite_key(t: Tables) -> DataFrame:
    first = [F.col(c).asc() for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")]
    base = latest_per_key(t.lineitem, LINE_KEY, first).select(*LINE_COLUMNS)
    flag = F.col("l_returnflag")
    changes = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_quantity") + 1).alias("l_quantity"),
        "l_extendedprice",
        F.when(flag == "R", "DELETE").when(flag == "A", "UPDATE").otherwise("BEFOREIMAGE").alias(OPERATION),
        F.col("l_shipdate").alias(TIMESTAMP),
        "l_suppkey",
    )
    tiebreak = ["l_suppkey", "l_partkey", "l_quantity", "l_extendedprice"]
    return merge_changes(base, changes, LINE_KEY, tiebreak=tiebreak)


def _customer_versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    base = t.customer.select(
        "c_custkey", "c_acctbal", "c_mktsegment", F.lit("1999-01-01").cast("timestamp_ntz").alias("lastmodifieddate")
    )
    changes = t.orders.select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
        F.col("o_orderdate").alias("lastmodifieddate"),
    )
    return base, changes


MERGE_LATEST_SQL = """
SELECT c_custkey, c_acctbal, c_mktsegment, lastmodifieddate FROM (
  SELECT *, row_number() OVER (PARTITION BY c_custkey
      ORDER BY lastmodifieddate DESC, c_acctbal DESC, c_mktsegment DESC) AS rnk
  FROM (
    SELECT c_custkey, c_acctbal, c_mktsegment, TIMESTAMP '1999-01-01' AS lastmodifieddate FROM customer
    UNION ALL
    SELECT o_custkey, o_totalprice, o_orderpriority, o_orderdate FROM orders
  ) AS u
) AS a WHERE rnk = 1"""


@query("merge_latest", MERGE_LATEST_SQL)
def _merge_latest(t: Tables) -> DataFrame:
    base, changes = _customer_versions(t)
    return merge_latest(base, changes, ["c_custkey"], tiebreak=["c_acctbal", "c_mktsegment"])


@query("merge_latest_window", MERGE_LATEST_SQL)
def _merge_latest_window(t: Tables) -> DataFrame:
    base, changes = _customer_versions(t)
    return merge_latest(base, changes, ["c_custkey"], tiebreak=["c_acctbal", "c_mktsegment"], form="window")


@query("merge_latest_join", MERGE_LATEST_SQL)
def _merge_latest_join(t: Tables) -> DataFrame:
    base, changes = _customer_versions(t)
    return merge_latest(base, changes, ["c_custkey"], tiebreak=["c_acctbal", "c_mktsegment"], form="join")


# Every event twice within one microsecond, so that seconds hold ties.
_USER_OPS = {"signup": "INSERT", "purchase": "UPDATE", "click": "UPDATE", "view": "BEFOREIMAGE", "error": "DELETE"}


def user_changes(t: Tables) -> DataFrame:
    op = F.lit(None)
    for event, name in _USER_OPS.items():
        op = F.when(F.col("event_type") == event, name).otherwise(op)
    rows = t.events.select(
        "user_id",
        "event_type",
        "value",
        op.alias(OPERATION),
        F.col("ts").alias(TIMESTAMP),
        (F.col("event_id") * 2).alias("seq"),
    )
    tick = F.make_dt_interval(secs=F.lit("0.000001").cast("decimal(18,6)"))
    again = rows.withColumns({TIMESTAMP: F.col(TIMESTAMP) + tick, "seq": F.col("seq") + 1})
    return rows.unionByName(again)


USER_LATEST_SQL = """
SELECT user_id, event_type, value, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) DESC, seq DESC) AS rnk
  FROM (
    SELECT user_id, event_type, value, ts, event_id * 2 AS seq FROM events
    UNION ALL
    SELECT user_id, event_type, value, ts + to_microseconds(1), event_id * 2 + 1 FROM events
  ) AS e
  WHERE event_type IN ('signup', 'purchase', 'click', 'error')
) AS a WHERE rnk = 1 AND event_type <> 'error'"""


@query("window_latest", USER_LATEST_SQL)
def _window_latest(t: Tables) -> DataFrame:
    rows = effective_changes(user_changes(t))
    newest = latest_per_key(rows, ["user_id"], [trunc_second(F.col(TIMESTAMP)).desc(), F.col("seq").desc()])
    return newest.where(F.col(OPERATION) != "DELETE").select("user_id", "event_type", "value", "seq")


@query("latest_by_maxby", USER_LATEST_SQL)
def _latest_by_maxby(t: Tables) -> DataFrame:
    rows = effective_changes(user_changes(t)).withColumn("second", trunc_second(F.col(TIMESTAMP)))
    newest = latest_by_aggregate(rows, ["user_id"], ["second", "seq"])
    return newest.where(F.col(OPERATION) != "DELETE").select("user_id", "event_type", "value", "seq")


_NEWEST_CHANGE_SQL = f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY
      date_trunc('second', header__timestamp) DESC, seq_line DESC, seq_part DESC, o_custkey DESC,
      o_totalprice DESC, o_orderpriority DESC, o_orderstatus DESC) AS rnk
  FROM ({ORDER_CHANGES_SQL}) AS c WHERE header__operation <> 'BEFOREIMAGE'
) AS n WHERE rnk = 1"""


def newest_order_changes(t: Tables) -> DataFrame:
    return compact_changes(order_changes(t), ORDER_KEY, ORDER_COLUMNS, tiebreak=ORDER_TIEBREAK)


@query(
    "apply_deletes",
    f"""SELECT {_COLS} FROM orders AS o WHERE NOT EXISTS (
  SELECT 1 FROM ({_NEWEST_CHANGE_SQL}) AS d
  WHERE d.header__operation = 'DELETE' AND d.o_orderkey = o.o_orderkey)""",
)
def _apply_deletes(t: Tables) -> DataFrame:
    return apply_deletes(t.orders, newest_order_changes(t).where("_op = 'DELETE'"), ORDER_KEY)


@query(
    "apply_puts",
    f"""
WITH puts AS (SELECT * FROM ({_NEWEST_CHANGE_SQL}) AS p WHERE header__operation <> 'DELETE')
SELECT {_COLS} FROM puts
UNION ALL
SELECT {_COLS} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM puts)""",
)
def _apply_puts(t: Tables) -> DataFrame:
    return apply_puts(t.orders, newest_order_changes(t).where("_op <> 'DELETE'"), ORDER_KEY)
