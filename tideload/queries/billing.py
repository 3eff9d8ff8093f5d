"""Billing and appointments.

Roles: customer is the patient, supplier the doctor, part the service and product,
nation the entitlement, region the institute, orders the order and lineitem its
services. Customers of the automobile segment are sponsored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideload.functions.dates import at_time
from tideload.functions.numbers import money
from tideload.operators.joins import lookup_join
from tideload.plans.appointments import dated_slots, diary_slots, free_slots, full_starts, mark_overbooked
from tideload.plans.billing import (
    LAB_STAGE_HOURS,
    PRODUCT_TOTALS,
    RADIOLOGY_STAGE_HOURS,
    REFERENCE_RANGES,
    SPONSORED_TOTALS,
    allocate_prescriptions,
    cash_payments,
    classify_results,
    consultation_services,
    explode_panels,
    fill_header_totals,
    invoice_headers,
    laboratory_records,
    map_receipts,
    price_by_agreement,
    price_products,
    price_services,
    radiology_records,
    receipts,
    reference_ranges,
    stage_audit,
)
from tideload.queries.registry import Tables, query
from tideload.sources.inline import inline_rows

PATIENT_CLASS = 2


def order_lines(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), "l_linenumber", F.col("l_partkey").alias("service_id")
    )
    return lookup_join(lines, order_rows(t), ["order_id"])


def order_rows(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").alias("order_date"),
    )


def line_orders(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("order_id"))


def sponsors(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("patient_id"),
        F.col("c_custkey").alias("patient_sponsor_id"),
        F.col("c_nationkey").alias("entitlement_id"),
        (F.col("c_mktsegment") == "AUTOMOBILE").alias("is_active"),
    )


def sequences(t: Tables) -> DataFrame:
    rows = [("INV", "OAD", "A", True), ("INV", "OLD", "Z", False), ("OPR", "RCP", "B", True)]
    return inline_rows(t.spark, rows, "sequence_code string, prefix string, suffix string, is_active boolean")


def priced_lines(t: Tables) -> DataFrame:
    price = money(F.col("p_retailprice"))
    tariff = t.part.select(
        F.col("p_partkey").alias("service_id"),
        F.lit(PATIENT_CLASS).alias("patient_class_id"),
        price.alias("service_tariff"),
    )
    agreed = t.part.select(
        F.col("p_partkey").alias("service_id"),
        F.lit(PATIENT_CLASS).alias("patient_class_id"),
        (F.col("p_size") % 5).alias("institute_id"),
        (price * F.lit("0.8").cast("decimal(2,1)")).cast("decimal(18,2)").alias("institute_tariff"),
        (F.col("p_type") != "ECONOMY").alias("is_active"),
    )
    entitlements = t.nation.select(F.col("n_nationkey").alias("entitlement_id"), F.col("n_regionkey").alias("institute_id"))
    return price_services(order_lines(t), tariff, sponsors(t), entitlements, agreed, PATIENT_CLASS)


PRICED_SQL = """
SELECT l_orderkey AS order_id, l_linenumber, l_partkey AS service_id, o_custkey AS patient_id, o_orderdate AS order_date,
  tariff AS service_amount,
  CASE WHEN sponsored THEN 0 ELSE tariff END AS patient_gross_amount,
  CASE WHEN sponsored THEN 0 ELSE tariff END AS patient_net_amount,
  CASE WHEN sponsored THEN coalesce(agreed, tariff) ELSE 0 END AS sponsor_gross_amount,
  CASE WHEN sponsored THEN coalesce(agreed, tariff) ELSE 0 END AS sponsor_net_amount
FROM (
  SELECT l.*, o_custkey, o_orderdate, c_mktsegment = 'AUTOMOBILE' AS sponsored,
    CAST(t.p_retailprice AS DECIMAL(18,2)) AS tariff,
    CAST(CAST(d.p_retailprice AS DECIMAL(18,2)) * 0.8 AS DECIMAL(18,2)) AS agreed
  FROM lineitem l JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN part t ON t.p_partkey = l_partkey
  LEFT JOIN part d ON d.p_partkey = l_partkey AND d.p_size % 5 = n_regionkey AND d.p_type <> 'ECONOMY'
) AS x"""


@query("invoice_pricing", PRICED_SQL)
def _invoice_pricing(t: Tables) -> DataFrame:
    return priced_lines(t)


@query(
    "invoice_pricing_agreed",
    """
SELECT l_orderkey AS order_id, l_linenumber, l_partkey AS service_id, l_suppkey AS institute_id,
  coalesce(package, CASE WHEN p_type <> 'SMALL' THEN CAST(p_retailprice AS DECIMAL(18,2)) END) AS service_amount,
  coalesce(package, CASE WHEN p_type <> 'SMALL' THEN CAST(p_retailprice AS DECIMAL(18,2)) END) AS patient_gross_amount
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
LEFT JOIN (SELECT l_partkey AS part, l_suppkey AS institute, min(CAST(l_extendedprice AS DECIMAL(18,2))) AS package
           FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2) AS a ON part = l_partkey AND institute = l_suppkey""",
)
def _invoice_pricing_agreed(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        "l_linenumber",
        F.col("l_partkey").alias("service_id"),
        F.col("l_suppkey").alias("institute_id"),
    )
    tariff = t.part.select(
        F.col("p_partkey").alias("service_id"),
        F.lit(PATIENT_CLASS).alias("patient_class_id"),
        money(F.col("p_retailprice")).alias("service_tariff"),
        (F.col("p_type") != "SMALL").alias("is_active"),
    )
    agreements = (
        t.lineitem.where("l_returnflag = 'N'")
        .groupBy(F.col("l_partkey").alias("service_id"), F.col("l_suppkey").alias("institute_id"))
        .agg(F.min(money(F.col("l_extendedprice"))).alias("package_tariff"))
        .select("*", F.lit(PATIENT_CLASS).alias("patient_class_id"), F.lit(True).alias("is_active"))
    )
    return price_by_agreement(lines, tariff, agreements, PATIENT_CLASS)


HEADERS_SQL = """
SELECT row_number() OVER (ORDER BY o_orderkey) AS invoice_id,
  'OAD-' || CAST(row_number() OVER (ORDER BY o_orderkey) AS VARCHAR) || '-A' AS invoice_number,
  o_orderkey AS order_id, o_custkey AS patient_id, o_orderdate AS order_date,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_nationkey END AS entitlement_id
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)"""

_HEADER_COLUMNS = ["invoice_id", "invoice_number", "order_id", "patient_id", "order_date", "entitlement_id"]


def open_headers(t: Tables) -> DataFrame:
    return invoice_headers(order_rows(t), line_orders(t), sponsors(t), sequences(t), "INV")


@query("invoice_headers", HEADERS_SQL)
def _invoice_headers(t: Tables) -> DataFrame:
    return open_headers(t).select(*_HEADER_COLUMNS)


FILLED_SQL = f"""
SELECT h.*, invoice_amount, settled_amount, patient_gross_amount, sponsor_gross_amount
FROM ({HEADERS_SQL}) AS h JOIN (
  SELECT order_id, sum(service_amount) AS invoice_amount, sum(service_amount) AS settled_amount,
    sum(patient_gross_amount) AS patient_gross_amount, sum(sponsor_gross_amount) AS sponsor_gross_amount
  FROM ({PRICED_SQL}) AS p GROUP BY order_id) AS s USING (order_id)"""


def filled_headers(t: Tables, headers: DataFrame) -> DataFrame:
    return fill_header_totals(headers, priced_lines(t))


@query("update_from_agg", FILLED_SQL)
def _update_from_agg(t: Tables) -> DataFrame:
    amounts = ["invoice_amount", "settled_amount", "patient_gross_amount", "sponsor_gross_amount"]
    return filled_headers(t, open_headers(t)).select(*_HEADER_COLUMNS, *amounts)


RECEIPTS_SQL = f"""
SELECT row_number() OVER (ORDER BY invoice_id) AS receipt_id,
  'RCP-' || CAST(row_number() OVER (ORDER BY invoice_id) AS VARCHAR) || '-B' AS receipt_number,
  order_id, invoice_id, patient_id, invoice_amount AS receipt_amount, order_date AS receipt_date
FROM ({FILLED_SQL}) AS f
WHERE patient_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')"""


def paid_receipts(t: Tables, headers: DataFrame) -> DataFrame:
    return receipts(filled_headers(t, headers), sponsors(t), sequences(t), "OPR")


@query("receipts_unsponsored", RECEIPTS_SQL)
def _receipts_unsponsored(t: Tables) -> DataFrame:
    return paid_receipts(t, open_headers(t))


@query(
    "receipt_invoice_map",
    f"""SELECT receipt_id, receipt_amount, CAST(0 AS DECIMAL(38,2)) AS utilized_amount, h.invoice_id
FROM ({RECEIPTS_SQL}) AS r JOIN ({HEADERS_SQL}) AS h USING (order_id)""",
)
def _receipt_invoice_map(t: Tables) -> DataFrame:
    headers = open_headers(t)
    return map_receipts(paid_receipts(t, headers), headers)


@query(
    "cash_payments",
    f"""SELECT receipt_id, receipt_amount AS amount, 2 AS currency_id, receipt_amount AS base_amount
FROM ({RECEIPTS_SQL}) AS r JOIN ({HEADERS_SQL}) AS h USING (order_id)""",
)
def _cash_payments(t: Tables) -> DataFrame:
    headers = open_headers(t)
    return cash_payments(paid_receipts(t, headers), headers, 2)


def stock_rows(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("l_suppkey").alias("warehouse_id"),
        F.col("l_partkey").alias("product_id"),
        F.concat_ws("-", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")).alias("stock_id"),
        F.col("l_returnflag").alias("batch_number"),
        money(F.col("l_extendedprice")).alias("price"),
    )


def _products(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("display_name"))


@query(
    "invoice_product_lines",
    """
WITH batches AS (SELECT l_suppkey, l_partkey, l_returnflag, min(CAST(l_extendedprice AS DECIMAL(18,2))) AS cost_price,
    max(CAST(l_extendedprice AS DECIMAL(18,2))) AS selling_price FROM lineitem GROUP BY ALL)
SELECT l_orderkey AS order_id, l_linenumber, l_partkey AS product_id, l_suppkey AS warehouse_id,
  l_returnflag AS batch_number, CAST(l_quantity AS INTEGER) AS issued_quantity, p_name AS display_name, cost_price,
  selling_price, selling_price + cost_price AS mrp, selling_price AS service_amount,
  CAST(l_quantity AS INTEGER) * selling_price AS patient_gross_amount,
  CAST(l_quantity AS INTEGER) * selling_price AS patient_net_amount, CAST(0 AS DECIMAL(18,2)) AS sponsor_gross_amount,
  CAST(0 AS DECIMAL(18,2)) AS sponsor_net_amount
FROM lineitem JOIN batches USING (l_suppkey, l_partkey, l_returnflag) JOIN part ON p_partkey = l_partkey""",
)
def _invoice_product_lines(t: Tables) -> DataFrame:
    return product_lines(t)


def product_lines(t: Tables) -> DataFrame:
    ordered = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        "l_linenumber",
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("warehouse_id"),
        F.col("l_returnflag").alias("batch_number"),
        F.col("l_quantity").cast("int").alias("issued_quantity"),
    )
    rows = stock_rows(t.lineitem)
    stock = rows.select("warehouse_id", "product_id", "stock_id").distinct()
    batches = rows.groupBy("stock_id", "batch_number").agg(
        F.min("price").alias("cost_price"), F.max("price").alias("selling_price")
    )
    batches = batches.withColumn("mrp", F.col("selling_price") + F.col("cost_price"))
    return price_products(ordered, stock, batches, _products(t))


_TOTALS = ["invoice_amount", "settled_amount", "patient_gross_amount", "patient_net_amount", "sponsor_gross_amount", "sponsor_net_amount"]


@query(
    "product_invoice_totals",
    f"""
WITH batches AS (SELECT l_suppkey, l_partkey, l_returnflag, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS selling_price
                 FROM lineitem GROUP BY ALL),
sums AS (SELECT l_orderkey AS order_id, CAST(sum(CAST(l_quantity AS INTEGER) * selling_price) AS DECIMAL(38,2)) AS net
         FROM lineitem JOIN batches USING (l_suppkey, l_partkey, l_returnflag) JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT h.*, coalesce(net, 0) AS invoice_amount, coalesce(net, 0) AS settled_amount, coalesce(net, 0) AS patient_gross_amount,
  coalesce(net, 0) AS patient_net_amount, CAST(0 AS DECIMAL(38,2)) AS sponsor_gross_amount,
  CAST(0 AS DECIMAL(38,2)) AS sponsor_net_amount
FROM ({HEADERS_SQL}) AS h LEFT JOIN sums USING (order_id)""",
)
def _product_invoice_totals(t: Tables) -> DataFrame:
    filled = fill_header_totals(open_headers(t), product_lines(t), totals=PRODUCT_TOTALS)
    return filled.select(*_HEADER_COLUMNS, *_TOTALS)


@query(
    "sponsored_invoice_totals",
    f"""
WITH agreed AS (SELECT l_partkey AS part, l_suppkey AS institute, min(CAST(l_extendedprice AS DECIMAL(18,2))) AS package
                FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2),
sums AS (
  SELECT l_orderkey AS order_id, CAST(sum(coalesce(package,
      CASE WHEN p_type <> 'SMALL' THEN CAST(p_retailprice AS DECIMAL(18,2)) END)) AS DECIMAL(38,2)) AS amount
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN agreed ON part = l_partkey AND institute = l_suppkey
  GROUP BY 1)
SELECT h.*, amount AS invoice_amount, amount AS settled_amount, CAST(0 AS DECIMAL(38,2)) AS patient_gross_amount,
  CAST(0 AS DECIMAL(38,2)) AS patient_net_amount, amount AS sponsor_gross_amount, amount AS sponsor_net_amount
FROM ({HEADERS_SQL}) AS h JOIN sums USING (order_id)""",
)
def _sponsored_invoice_totals(t: Tables) -> DataFrame:
    """Priced by agreement; an order none of whose services has a price gets NULL amounts."""
    filled = fill_header_totals(open_headers(t), _invoice_pricing_agreed(t), totals=SPONSORED_TOTALS)
    return filled.select(*_HEADER_COLUMNS, *_TOTALS)


@query(
    "prescription_alloc",
    """
WITH first_batch AS (SELECT l_suppkey, l_partkey, min(l_returnflag) AS batch_number FROM lineitem
                     WHERE l_linestatus = 'O' GROUP BY 1, 2)
SELECT l_orderkey AS medication_id, l_linenumber AS days, l_partkey AS product_id, l_suppkey AS warehouse_id,
  CAST(l_quantity AS INTEGER) AS dosage, CAST(0.5 AS DECIMAL(2,1)) AS units,
  CAST(ceil(0.5 * CAST(l_quantity AS BIGINT) * l_linenumber) AS BIGINT) AS quantity, batch_number
FROM lineitem JOIN first_batch USING (l_suppkey, l_partkey)""",
)
def _prescription_alloc(t: Tables) -> DataFrame:
    """Lines still open are what the warehouses hold."""
    medications = t.lineitem.select(
        F.col("l_orderkey").alias("medication_id"),
        F.col("l_linenumber").alias("days"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("warehouse_id"),
        F.col("l_quantity").cast("int").alias("dosage"),
        F.lit("0.5").cast("decimal(2,1)").alias("units"),
    )
    rows = stock_rows(t.lineitem.where("l_linestatus = 'O'"))
    stock = rows.select("warehouse_id", "product_id", "stock_id").distinct()
    batches = rows.select("stock_id", "batch_number").distinct()
    return allocate_prescriptions(medications, stock, batches).withColumn("quantity", F.col("quantity").cast("bigint"))


_PRIORITIES = [("1-URGENT", 1, 2), ("2-HIGH", 3, 4), ("3-MEDIUM", 5, 6), ("4-NOT SPECIFIED", 9, 10), ("5-LOW", 7, 8)]


@query(
    "consultation_services",
    """SELECT o_orderkey AS order_id, o_orderpriority AS consultation_type_id, o_orderstatus = 'F' AS is_first,
  p_partkey AS service_id, p_name FROM orders
JOIN (VALUES ('1-URGENT', 1, 2), ('2-HIGH', 3, 4), ('3-MEDIUM', 5, 6),
              ('4-NOT SPECIFIED', 9, 10), ('5-LOW', 7, 8)) AS f(type, first, second)
  ON type = o_orderpriority
JOIN part ON (p_partkey = first AND o_orderstatus = 'F') OR (p_partkey = second AND o_orderstatus <> 'F')""",
)
def _consultation_services(t: Tables) -> DataFrame:
    appointments = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("consultation_type_id"),
        (F.col("o_orderstatus") == "F").alias("is_first"),
    )
    followups = inline_rows(
        t.spark, _PRIORITIES, "consultation_type_id string, first_service_id bigint, second_service_id bigint"
    )
    services = t.part.select(F.col("p_partkey").alias("service_id"), "p_name")
    return consultation_services(appointments, followups, services).select(
        "order_id", "consultation_type_id", "is_first", "service_id", "p_name"
    )


PANELS_SQL = """
SELECT p_partkey AS panel, p_partkey + step AS component FROM part, (VALUES (1), (2)) AS s(step)
WHERE p_type = 'PROMO' AND p_size > 25"""


def panels(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("panel_id"),
        F.explode(F.array(F.col("p_partkey") + 1, F.col("p_partkey") + 2)).alias("component_id"),
        ((F.col("p_type") == "PROMO") & (F.col("p_size") > 25)).alias("is_active"),
    )


@query(
    "join_coalesce_key",
    f"""SELECT l_orderkey AS order_id, l_linenumber, p_partkey AS service_id, p_name
FROM lineitem LEFT JOIN ({PANELS_SQL}) AS panels ON panel = l_partkey
JOIN part ON p_partkey = coalesce(component, l_partkey)""",
)
def _join_coalesce_key(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), "l_linenumber", F.col("l_partkey").alias("service_id")
    )
    services = t.part.select(F.col("p_partkey").alias("service_id"), "p_name")
    return lookup_join(explode_panels(lines, panels(t)), services, ["service_id"]).select(
        "order_id", "l_linenumber", "service_id", "p_name"
    )


# A part's size stands for the section of the service, the customer key for the registration number.
def services(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("service_id"), (F.col("p_size") % 7).alias("section_id"))


def registered(patients: DataFrame) -> DataFrame:
    return patients.withColumn("registration_number", F.concat(F.lit("REG-"), F.col("patient_id").cast("string")))


_STAGES = [(1, "Arrival"), (2, "Attend"), (3, "Result"), (4, "Authentication"), (5, "Issue")]
_STAGES_SQL = "(VALUES (1, 'Arrival'), (2, 'Attend'), (3, 'Result'), (4, 'Authentication'), (5, 'Issue')) AS s(stage_id, stage_name)"


def stages(t: Tables) -> DataFrame:
    return inline_rows(t.spark, _STAGES, "stage_id int, stage_name string")


@query(
    "laboratory_records",
    f"""
WITH births AS (SELECT o_custkey, min(o_orderdate) AS born FROM orders GROUP BY 1)
SELECT l_orderkey AS order_id, l_linenumber, part.p_partkey AS service_id, o.o_custkey AS patient_id, o_orderdate AS order_date,
  'REG-' || CAST(o.o_custkey AS VARCHAR) AS registration_number, ordered.p_size % 7 AS section_id,
  part.p_brand AS result_type, 5 AS current_stage_id, 4 AS previous_stage_id, {', '.join(f'o_orderdate + INTERVAL {h} HOUR AS {stage}' for stage, h in LAB_STAGE_HOURS.items())},
  CAST(CASE WHEN date_diff('month', born, TIMESTAMP '2001-08-01') < 1 THEN date_diff('day', born, TIMESTAMP '2001-08-01')
    WHEN date_diff('year', born, TIMESTAMP '2001-08-01') < 1 THEN date_diff('month', born, TIMESTAMP '2001-08-01')
    ELSE date_diff('year', born, TIMESTAMP '2001-08-01') END AS INTEGER) AS patient_age,
  CASE WHEN date_diff('month', born, TIMESTAMP '2001-08-01') < 1 THEN 'DAYS'
    WHEN date_diff('year', born, TIMESTAMP '2001-08-01') < 1 THEN 'MONTHS' ELSE 'YEARS' END AS age_unit
FROM lineitem JOIN orders o ON o_orderkey = l_orderkey LEFT JOIN ({PANELS_SQL}) AS panels ON panel = l_partkey
JOIN part ON part.p_partkey = coalesce(component, l_partkey) JOIN part AS ordered ON ordered.p_partkey = l_partkey
JOIN births ON births.o_custkey = o.o_custkey""",
)
def _laboratory_records(t: Tables) -> DataFrame:
    """A customer's first order stands for the birth date."""
    investigations = t.part.select(F.col("p_partkey").alias("service_id"), F.col("p_brand").alias("result_type"))
    patients = t.orders.groupBy(F.col("o_custkey").alias("patient_id")).agg(F.min("o_orderdate").alias("birth_date"))
    as_of = F.lit("2001-08-01").cast("timestamp_ntz")
    return laboratory_records(order_lines(t), panels(t), investigations, registered(patients), services(t), stages(t), as_of)


@query(
    "join_range_stage",
    f"""SELECT o_orderkey AS transaction_id, stage_id, stage_name FROM orders JOIN {_STAGES_SQL}
ON stage_id <= (SELECT stage_id FROM {_STAGES_SQL} WHERE stage_name = 'Authentication')""",
)
def _join_range_stage(t: Tables) -> DataFrame:
    records = t.orders.select(F.col("o_orderkey").alias("transaction_id"))
    return stage_audit(records, stages(t), "Authentication").select("transaction_id", "stage_id", "stage_name")


@query(
    "radiology_records",
    "SELECT l_orderkey AS order_id, l_linenumber, l_partkey AS service_id, o_custkey AS patient_id, "
    "o_orderdate AS order_date, 'REG-' || CAST(o_custkey AS VARCHAR) AS registration_number, e.p_size % 7 AS section_id, "
    "e.p_size AS department_id, 3 AS current_stage_id, 2 AS previous_stage_id, "
    + ", ".join(f"o_orderdate + INTERVAL {h} HOUR AS {stage}" for stage, h in RADIOLOGY_STAGE_HOURS.items())
    + """, template_id, template
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part e ON e.p_partkey = l_partkey AND e.p_type <> 'ECONOMY'
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY service_id ORDER BY template_id) AS first FROM (
    SELECT DISTINCT l_partkey AS service_id, l_suppkey AS template_id, 'T' || CAST(l_suppkey AS VARCHAR) AS template
    FROM lineitem WHERE l_linestatus = 'F') AS d) AS tpl
  ON tpl.service_id = l_partkey AND first = 1""",
)
def _radiology_records(t: Tables) -> DataFrame:
    examinations = t.part.select(
        F.col("p_partkey").alias("service_id"),
        F.col("p_size").alias("department_id"),
        (F.col("p_type") != "ECONOMY").alias("is_active"),
    )
    templates = t.lineitem.select(
        F.col("l_partkey").alias("service_id"),
        F.col("l_suppkey").alias("template_id"),
        F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("template"),
        (F.col("l_linestatus") == "F").alias("is_active"),
    )
    patients = registered(t.orders.select(F.col("o_custkey").alias("patient_id")).distinct())
    return radiology_records(order_lines(t), examinations, templates, patients, services(t), stages(t), "Result")


_TESTS = [
    ("click", "Ammonia"),
    ("view", "Serum Sodium"),
    ("purchase", "HDL Cholesterol"),
    ("signup", "LDL Cholesterol"),
    ("error", "Triglycerides"),
]


@query(
    "reference_range",
    f"""SELECT event_id, service, value, normal_min, normal_max, critical_min, critical_max,
  CASE WHEN value < critical_min THEN 'critical low' WHEN value > critical_max THEN 'critical high'
       WHEN value < normal_min THEN 'low' WHEN value > normal_max THEN 'high' ELSE 'normal' END AS level
FROM events JOIN (VALUES {', '.join(str(r) for r in _TESTS)}) AS m(event_type, service) USING (event_type)
JOIN (VALUES {', '.join(str(r) for r in REFERENCE_RANGES)})
  AS r(service, normal_min, normal_max, critical_min, critical_max) USING (service)""",
)
def _reference_range(t: Tables) -> DataFrame:
    tests = inline_rows(t.spark, _TESTS, "event_type string, service string")
    results = t.events.select("event_id", "event_type", "value").join(tests, "event_type").drop("event_type")
    return classify_results(results, reference_ranges(t.spark))


# Appointments: every line is a booking of its supplier on the ship date, half an hour
# per line number from nine o'clock. Every supplier keeps two places per half hour on
# Mondays and one on other days, and ends earlier or later by nation.
_WEEK = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
_WEEK_SQL = "(VALUES " + ", ".join(f"('{d}')" for d in _WEEK) + ") AS w(weekday)"

DIARY_SQL = f"""
SELECT s_suppkey AS doctor_id, weekday, s_nationkey % 2 AS overbook_count, slot_second FROM (
  SELECT *, CAST(unnest(range(32400, 39600 + s_nationkey * 300 - 1799, 1800)) AS INTEGER) AS slot_second
  FROM supplier, (SELECT weekday FROM {_WEEK_SQL} UNION ALL SELECT 'Monday') AS days) AS x"""


def diary(t: Tables) -> DataFrame:
    days = F.array(*[F.lit(d) for d in (*_WEEK, "Monday")])
    return t.supplier.select(
        F.col("s_suppkey").alias("doctor_id"),
        F.explode(days).alias("weekday"),
        (F.col("s_nationkey") % 2).alias("overbook_count"),
        F.lit(32400).alias("start_second"),
        (F.lit(39600) + F.col("s_nationkey") * 300).alias("end_second"),
        F.lit(1800).alias("slot_seconds"),
    )


@query("slot_explode", DIARY_SQL)
def _slot_explode(t: Tables) -> DataFrame:
    return diary_slots(diary(t))


def appointments(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("appointment_id"),
        "l_linenumber",
        F.col("l_partkey").alias("reason_id"),
        F.col("l_suppkey").alias("doctor_id"),
        at_time(F.col("l_shipdate"), F.lit(30600) + F.col("l_linenumber") * 1800).alias("start_time"),
        (F.col("l_returnflag") == "R").alias("is_overbooked"),
    )


APPOINTMENTS_SQL = """
SELECT l_orderkey AS appointment_id, l_linenumber, l_partkey AS reason_id, l_suppkey AS doctor_id,
  date_trunc('day', l_shipdate) + to_seconds(30600 + l_linenumber * 1800) AS start_time, l_returnflag = 'R' AS is_overbooked
FROM lineitem"""

SLOT_COUNTS_SQL = f"SELECT doctor_id, start_time, count(*) AS taken FROM ({APPOINTMENTS_SQL}) AS a GROUP BY 1, 2"


@query("slot_counts", SLOT_COUNTS_SQL)
def _slot_counts(t: Tables) -> DataFrame:
    return appointments(t).groupBy("doctor_id", "start_time").agg(F.count(F.lit(1)).alias("taken"))


_DATED_SQL = f"""
SELECT doctor_id, weekday, overbook_count, day + to_seconds(slot_second) AS start_time
FROM (SELECT DISTINCT l_suppkey AS doctor_id, date_trunc('day', CAST(l_shipdate AS TIMESTAMP)) AS day FROM lineitem) AS d
JOIN (SELECT DISTINCT * FROM ({DIARY_SQL}) AS q) AS s USING (doctor_id)
WHERE weekday = dayname(day)"""


def open_days(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").alias("doctor_id"), F.col("l_shipdate").cast("date").alias("day")
    ).distinct()


@query(
    "join_computed_ts",
    f"""SELECT a.appointment_id, a.l_linenumber, a.reason_id, s.doctor_id, s.start_time, s.weekday
FROM ({_DATED_SQL}) AS s JOIN ({APPOINTMENTS_SQL}) AS a ON a.doctor_id = s.doctor_id AND a.start_time = s.start_time""",
)
def _join_computed_ts(t: Tables) -> DataFrame:
    slots = dated_slots(diary_slots(diary(t)).distinct(), open_days(t))
    booked = appointments(t).select("appointment_id", "l_linenumber", "reason_id", "doctor_id", "start_time")
    placed = slots.select("doctor_id", "start_time", "weekday")
    return lookup_join(booked, placed, ["doctor_id", "start_time"])


# Slots of every fifth doctor and half hour are in use, and bookings of orders with an even key have no flag.
_USED_SQL = "(doctor_id + date_diff('second', date_trunc('day', s.start_time), s.start_time) // 1800) % 5 = 0"


@query(
    "slot_availability",
    f"""
WITH booked AS (
  SELECT doctor_id, start_time, bool_or(NOT flag) AS single
  FROM (SELECT *, CASE WHEN appointment_id % 2 = 1 THEN is_overbooked END AS flag FROM ({APPOINTMENTS_SQL}) AS q) AS a
  GROUP BY 1, 2)
SELECT s.doctor_id, weekday, overbook_count, s.start_time, b.start_time IS NOT NULL AS is_shared
FROM ({_DATED_SQL}) AS s LEFT JOIN booked b ON b.doctor_id = s.doctor_id AND b.start_time = s.start_time
WHERE (b.start_time IS NULL OR (overbook_count <> 0 AND single)) AND NOT {_USED_SQL.replace('doctor_id', 's.doctor_id')}""",
)
def _slot_availability(t: Tables) -> DataFrame:
    """The free slots themselves."""
    slots = dated_slots(diary_slots(diary(t)).distinct(), open_days(t))
    used = (F.col("doctor_id") + F.floor(F.col("slot_second") / 1800)) % 5 == 0
    booked = appointments(t).withColumn(
        "is_overbooked", F.when(F.col("appointment_id") % 2 == 1, F.col("is_overbooked"))
    )
    free = free_slots(slots.withColumn("is_used", used), booked)
    return free.select("doctor_id", "weekday", "overbook_count", "start_time", "is_shared")


_FULL_SQL = f"""
SELECT b.doctor_id, b.start_time, taken FROM ({SLOT_COUNTS_SQL}) AS b JOIN (
  SELECT doctor_id, weekday, slot_second, count(*) AS capacity FROM ({DIARY_SQL}) AS q GROUP BY 1, 2, 3) AS c
ON c.doctor_id = b.doctor_id AND c.weekday = dayname(b.start_time)
  AND c.slot_second = date_diff('second', date_trunc('day', b.start_time), b.start_time) AND c.capacity = b.taken"""


@query("join_agg_agg", _FULL_SQL)
def _join_agg_agg(t: Tables) -> DataFrame:
    return full_starts(appointments(t), diary_slots(diary(t)))


@query(
    "mark_overbooked",
    f"""SELECT appointment_id, l_linenumber, reason_id, a.doctor_id, a.start_time,
  is_overbooked OR f.doctor_id IS NOT NULL AS is_overbooked
FROM ({APPOINTMENTS_SQL}) AS a LEFT JOIN ({_FULL_SQL}) AS f ON f.doctor_id = a.doctor_id AND f.start_time = a.start_time""",
)
def _mark_overbooked(t: Tables) -> DataFrame:
    rows = mark_overbooked(appointments(t), diary_slots(diary(t)))
    return rows.select("appointment_id", "l_linenumber", "reason_id", "doctor_id", "start_time", "is_overbooked")
