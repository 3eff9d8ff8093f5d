"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideload.functions.dates import (
    age_unit,
    age_value,
    at_time,
    boundary_days,
    boundary_months,
    boundary_years,
    trunc_second,
    weekday_name,
)
from tideload.functions.numbers import body_mass_index, money
from tideload.functions.text import resplit, single_line
from tideload.plans.billing import LAB_STAGE_HOURS, stage_times
from tideload.queries.registry import Tables, query


@query(
    "fn_cast",
    """SELECT p_partkey, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_number, TRY_CAST(p_name AS INTEGER) AS no_number,
  CAST(p_size AS VARCHAR) AS size_text, CAST(floor(p_retailprice) AS INTEGER) AS price_rounded_down,
  CAST('2024-02-29 10:11:12' AS TIMESTAMP) AS at_time, CAST(p_retailprice AS DECIMAL(10,2)) AS price
FROM part AS p""",
)
def _fn_cast(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        F.substring("p_brand", 7, 10).try_cast("int").alias("brand_number"),
        F.col("p_name").try_cast("int").alias("no_number"),
        F.col("p_size").cast("string").alias("size_text"),
        F.col("p_retailprice").cast("int").alias("price_rounded_down"),
        F.lit("2024-02-29 10:11:12").cast("timestamp_ntz").alias("at_time"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


@query("fn_trunc_second", "SELECT event_id, date_trunc('second', ts) AS second FROM events")
def _fn_trunc_second(t: Tables) -> DataFrame:
    return t.events.select("event_id", trunc_second(F.col("ts")).alias("second"))


@query(
    "fn_case",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'closed urgent'
  WHEN o_orderstatus = 'F' THEN 'closed' WHEN o_orderstatus = 'O' THEN 'open' END AS label FROM orders""",
)
def _fn_case(t: Tables) -> DataFrame:
    closed = F.col("o_orderstatus") == "F"
    label = (
        F.when(closed & (F.col("o_orderpriority") == "1-URGENT"), "closed urgent")
        .when(closed, "closed")
        .when(F.col("o_orderstatus") == "O", "open")
    )
    return t.orders.select("o_orderkey", label.alias("label"))


@query(
    "fn_coalesce",
    """SELECT c_custkey, coalesce(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_mktsegment END, c_name) AS payer
FROM customer""",
)
def _fn_coalesce(t: Tables) -> DataFrame:
    sponsor = F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.col("c_mktsegment"))
    return t.customer.select("c_custkey", F.coalesce(sponsor, "c_name").alias("payer"))


@query(
    "fn_concat",
    """SELECT c_custkey, 'The customer ' || c_name || ' is in ' || c_mktsegment || '.' AS sentence,
  'C-' || CAST(c_custkey AS VARCHAR) || '-' || CAST(c_nationkey AS VARCHAR) AS label FROM customer""",
)
def _fn_concat(t: Tables) -> DataFrame:
    sentence = F.concat(F.lit("The customer "), "c_name", F.lit(" is in "), "c_mktsegment", F.lit("."))
    label = F.concat_ws("-", F.lit("C"), F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"))
    return t.customer.select("c_custkey", sentence.alias("sentence"), label.alias("label"))


@query(
    "fn_split_join",
    """SELECT doc_id, replace(text, ' ', '_') AS joined, split_part(text, ' ', 1) AS head,
  len(string_split(text, ',')) AS parts FROM documents""",
)
def _fn_split_join(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        resplit(F.col("text"), " ", "_").alias("joined"),
        F.split("text", " ", -1)[0].alias("head"),
        F.size(F.split("text", ",", -1)).cast("bigint").alias("parts"),
    )


@query(
    "fn_clean_text",
    "SELECT doc_id, replace(replace(text, chr(13), ''), chr(10), '') AS line FROM documents",
)
def _fn_clean_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", single_line(F.col("text")).alias("line"))


@query(
    "fn_dateadd_stages",
    "SELECT o_orderkey, "
    + ", ".join(f"o_orderdate + INTERVAL {h} HOUR AS {stage}" for stage, h in LAB_STAGE_HOURS.items())
    + " FROM orders",
)
def _fn_dateadd_stages(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", *stage_times(F.col("o_orderdate"), LAB_STAGE_HOURS))


_AS_OF = "2001-08-01"


@query(
    "fn_datediff_boundary",
    f"""SELECT o_orderkey, date_diff('year', o_orderdate, TIMESTAMP '{_AS_OF}') AS years,
  date_diff('month', o_orderdate, TIMESTAMP '{_AS_OF}') AS months,
  date_diff('day', o_orderdate, TIMESTAMP '{_AS_OF}') AS days FROM orders""",
)
def _fn_datediff_boundary(t: Tables) -> DataFrame:
    start, end = F.col("o_orderdate"), F.lit(_AS_OF).cast("timestamp_ntz")
    return t.orders.select(
        "o_orderkey",
        boundary_years(start, end).cast("bigint").alias("years"),
        boundary_months(start, end).cast("bigint").alias("months"),
        boundary_days(start, end).cast("bigint").alias("days"),
    )


@query(
    "fn_date_plus_time",
    """SELECT l_orderkey, l_linenumber, l_partkey,
  date_trunc('day', l_shipdate) + to_seconds(28800 + l_linenumber * 900) AS starts,
  dayname(l_shipdate) AS weekday FROM lineitem""",
)
def _fn_date_plus_time(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        at_time(F.col("l_shipdate"), F.lit(28800) + F.col("l_linenumber") * 900).alias("starts"),
        weekday_name(F.col("l_shipdate")).alias("weekday"),
    )


@query(
    "fn_math",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS rounded,
  CAST(ceil(l_quantity / 4) AS BIGINT) AS packs, CAST(l_quantity AS BIGINT) % 4 AS loose,
  (0 - CAST(l_quantity AS BIGINT)) % 4 AS owed, CAST(trunc(l_extendedprice) AS BIGINT) AS whole FROM lineitem""",
)
def _fn_math(t: Tables) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(money(F.col("l_extendedprice")), 1).alias("rounded"),
        F.ceil(F.col("l_quantity") / 4).alias("packs"),
        (quantity % 4).alias("loose"),
        (-quantity % 4).alias("owed"),
        F.col("l_extendedprice").cast("bigint").alias("whole"),
    )


@query(
    "vitals_bmi",
    """SELECT p_partkey, CAST((2 * cents * 10000 + h * h) // (2 * h * h) AS DECIMAL(10,0)) * 0.01 AS bmi FROM (
  SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents,
         CAST(150 + p_size AS BIGINT) AS h FROM part) AS p""",
)
def _vitals_bmi(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", body_mass_index(money(F.col("p_retailprice")), (F.lit(150) + F.col("p_size")).cast("decimal(10,0)")).alias("bmi")
    )


@query(
    "age_bucket",
    f"""SELECT o_orderkey, CAST(CASE WHEN m < 1 THEN d WHEN y < 1 THEN m ELSE y END AS INTEGER) AS age,
  CASE WHEN m < 1 THEN 'DAYS' WHEN y < 1 THEN 'MONTHS' ELSE 'YEARS' END AS unit FROM (
  SELECT o_orderkey, date_diff('year', o_orderdate, TIMESTAMP '{_AS_OF}') AS y,
    date_diff('month', o_orderdate, TIMESTAMP '{_AS_OF}') AS m, date_diff('day', o_orderdate, TIMESTAMP '{_AS_OF}') AS d
  FROM orders) AS o""",
)
def _age_bucket(t: Tables) -> DataFrame:
    birth, as_of = F.col("o_orderdate"), F.lit(_AS_OF).cast("timestamp_ntz")
    return t.orders.select("o_orderkey", age_value(birth, as_of).alias("age"), age_unit(birth, as_of).alias("unit"))
