"""Billing: pricing, invoices, receipts, laboratory and radiology records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideload.functions.dates import age_unit, age_value, shift
from tideload.functions.numbers import dispensed_quantity
from tideload.functions.text import numbered_label
from tideload.operators.joins import attach_one_row, choose_key, expand_up_to, fanout_join, lookup_join, with_match, without_match
from tideload.operators.latest import latest_per_key
from tideload.operators.numbering import dense_number
from tideload.operators.updates import update_from
from tideload.sources.inline import inline_rows

# Hours from the order to each stage.
LAB_STAGE_HOURS = {
    "collection_date": 2,
    "distribution_date": 3,
    "process_date": 4,
    "result_entry_date": 5,
    "result_authenticate_date": 6,
    "report_dispatched_date": 7,
    "report_acknowledgement_date": 8,
    "report_issue_date": 9,
}
RADIOLOGY_STAGE_HOURS = {
    "arrival_date": 3,
    "attend_date": 4,
    "result_date": 5,
    "exit_date": 6,
    "authentication_date": 7,
    "dispatch_date": 8,
    "acknowledgement_date": 9,
    "issue_date": 10,
}

# Service, normal minimum and maximum, critical minimum and maximum.
REFERENCE_RANGES = (
    ("Ammonia", 9, 50, 4, 60),
    ("Serum Sodium", 135, 145, 125, 160),
    ("HDL Cholesterol", 40, 50, 30, 60),
    ("LDL Cholesterol", 90, 100, 80, 120),
    ("Total Cholesterol", 150, 200, 100, 230),
    ("Triglycerides", 100, 150, 80, 200),
)

# Diagnosis code per complaint.
COMPLAINT_CODES = (
    ("Chest Pain", "R07.9"),
    ("Abdominal Pain", "R10"),
    ("Breathing Difficulty", "R06.8"),
)

INVOICE_AMOUNTS = (
    "service_amount",
    "patient_gross_amount",
    "patient_net_amount",
    "sponsor_gross_amount",
    "sponsor_net_amount",
)


def reference_ranges(spark: SparkSession) -> DataFrame:
    return inline_rows(
        spark,
        REFERENCE_RANGES,
        "service string, normal_min int, normal_max int, critical_min int, critical_max int",
    )


def complaint_codes(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, COMPLAINT_CODES, "complaint string, icd_code string")


def price_services(
    lines: DataFrame,
    tariff: DataFrame,
    sponsors: DataFrame,
    entitlements: DataFrame,
    institute_tariffs: DataFrame,
    patient_class: int,
) -> DataFrame:
    """Invoice lines for ordered services.

    Unsponsored patients pay the tariff. For sponsored ones the sponsor pays the
    tariff agreed with its institute, or else the ordinary tariff.
    """
    base = tariff.where(F.col("patient_class_id") == patient_class).select("service_id", "service_tariff")
    agreed = institute_tariffs.where(F.col("is_active") & (F.col("patient_class_id") == patient_class)).select(
        "service_id", "institute_id", "institute_tariff"
    )
    payers = sponsors.where("is_active").join(
        entitlements.select("entitlement_id", "institute_id"), "entitlement_id", "left"
    )
    priced = lookup_join(lines, base, ["service_id"])
    priced = lookup_join(priced, payers.select("patient_id", "patient_sponsor_id", "institute_id"), ["patient_id"], "left")
    priced = lookup_join(priced, agreed, ["service_id", "institute_id"], "left")
    sponsored = F.col("patient_sponsor_id").isNotNull()
    nothing = F.lit(0).cast("decimal(18,2)")
    patient = F.when(sponsored, nothing).otherwise(F.col("service_tariff"))
    sponsor = F.when(sponsored, F.coalesce("institute_tariff", "service_tariff")).otherwise(nothing)
    return priced.select(
        *lines.columns,
        F.col("service_tariff").alias("service_amount"),
        patient.alias("patient_gross_amount"),
        patient.alias("patient_net_amount"),
        sponsor.alias("sponsor_gross_amount"),
        sponsor.alias("sponsor_net_amount"),
    )


def price_by_agreement(
    lines: DataFrame, tariff: DataFrame, agreements: DataFrame, patient_class: int
) -> DataFrame:
    """Invoice lines of sponsored orders: the package tariff of the institute, or else the ordinary one.

    Lines carry the ``institute_id`` of their invoice; a service without any tariff stays, unpriced.
    """
    own = agreements.where(F.col("is_active") & (F.col("patient_class_id") == patient_class)).select(
        "service_id", "institute_id", "package_tariff"
    )
    base = tariff.where(F.col("is_active") & (F.col("patient_class_id") == patient_class)).select(
        "service_id", "service_tariff"
    )
    priced = lookup_join(lookup_join(lines, own, ["service_id", "institute_id"], "left"), base, ["service_id"], "left")
    amount = F.coalesce("package_tariff", "service_tariff")
    return priced.select(*lines.columns, amount.alias("service_amount"), amount.alias("patient_gross_amount"))


def price_products(order_products: DataFrame, stock: DataFrame, stock_batches: DataFrame, products: DataFrame) -> DataFrame:
    """Invoice lines for issued products: quantity times the selling price of the issued batch.

    They carry the amounts of an invoice line, so they go through the header totals like
    services do; the patient pays, a sponsor nothing.
    """
    placed = lookup_join(order_products, stock, ["warehouse_id", "product_id"])
    batched = lookup_join(placed, stock_batches, ["stock_id", "batch_number"])
    named = lookup_join(batched, products.select("product_id", "display_name"), ["product_id"])
    amount = F.col("issued_quantity") * F.col("selling_price")
    nothing = F.lit(0).cast("decimal(18,2)")
    return named.select(
        *order_products.columns,
        "display_name",
        "cost_price",
        "selling_price",
        "mrp",
        F.col("selling_price").alias("service_amount"),
        amount.alias("patient_gross_amount"),
        amount.alias("patient_net_amount"),
        nothing.alias("sponsor_gross_amount"),
        nothing.alias("sponsor_net_amount"),
    )


def number_rows(
    df: DataFrame, order_by: Sequence[str], sequences: DataFrame, code: str, id_name: str, label_name: str, start: int = 1
) -> DataFrame:
    """Number rows and label them ``prefix-number-suffix`` from the one active sequence of ``code``."""
    active = sequences.where((F.col("sequence_code") == code) & F.col("is_active"))
    numbered = attach_one_row(
        dense_number(df, order_by, id_name, start), active, {"_prefix": "prefix", "_suffix": "suffix"}
    )
    label = numbered_label(F.col("_prefix"), F.col(id_name), F.col("_suffix"))
    return numbered.select(id_name, label.alias(label_name), *df.columns)


def invoice_headers(
    orders: DataFrame, lines: DataFrame, sponsors: DataFrame, sequences: DataFrame, code: str, start: int = 1
) -> DataFrame:
    """One numbered invoice per order that has lines (and entitlement, for sponsored patients), amounts open.

    ``has_lines`` says so on every header, so that what is made of headers need not read the lines again.
    """
    billable = with_match(orders.select("order_id", "patient_id", "order_date"), lines, ["order_id"])
    entitled = lookup_join(
        billable, sponsors.where("is_active").select("patient_id", "entitlement_id").distinct(), ["patient_id"], "left"
    )
    zero = F.lit(0).cast("decimal(38,2)")
    amounts = ("invoice_amount", "settled_amount", "balance_amount", *INVOICE_AMOUNTS[1:])
    numbered = number_rows(
        entitled.distinct(), ["order_id", "entitlement_id"], sequences, code, "invoice_id", "invoice_number", start
    )
    return numbered.select("*", F.lit(True).alias("has_lines"), *[zero.alias(a) for a in amounts])


# What a header's amounts are the sums of: for services, for the services of sponsored orders,
# and for products.
SERVICE_TOTALS = {
    "invoice_amount": "service_amount",
    "settled_amount": "service_amount",
    **{a: a for a in INVOICE_AMOUNTS[1:]},
}
SPONSORED_TOTALS = {
    a: "service_amount" for a in ("invoice_amount", "settled_amount", "sponsor_gross_amount", "sponsor_net_amount")
}
PRODUCT_TOTALS = {
    **{a: "patient_net_amount" for a in ("invoice_amount", "settled_amount", "patient_gross_amount", "patient_net_amount")},
    "sponsor_gross_amount": "sponsor_gross_amount",
    "sponsor_net_amount": "sponsor_net_amount",
}


def fill_header_totals(
    headers: DataFrame, details: DataFrame, by: str = "order_id", totals: Mapping[str, str] = SERVICE_TOTALS
) -> DataFrame:
    """Headers with the sums of their details; headers without details stay as they are.

    Details are summed up by the column they share with the headers before they meet them, so
    what is exchanged is one row per task and header, never the details.
    """
    sums = details.groupBy(by).agg(*[F.sum(a).cast("decimal(38,2)").alias(a) for a in sorted(set(totals.values()))])
    return update_from(headers, sums, [by], totals)


def receipts(headers: DataFrame, sponsors: DataFrame, sequences: DataFrame, code: str, start: int = 1) -> DataFrame:
    """A numbered receipt for every invoice of an unsponsored patient whose order has lines."""
    own = without_match(headers.where("has_lines"), sponsors.where("is_active"), ["patient_id"])
    due = own.select(
        "order_id",
        "invoice_id",
        "patient_id",
        F.col("invoice_amount").alias("receipt_amount"),
        F.col("order_date").alias("receipt_date"),
    )
    return number_rows(due, ["invoice_id"], sequences, code, "receipt_id", "receipt_number", start)


def map_receipts(receipt_rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Each receipt with the invoices of its order."""
    due = receipt_rows.select("order_id", "receipt_id", "receipt_amount")
    return due.join(headers.where("has_lines").select("order_id", "invoice_id"), "order_id").select(
        "receipt_id", "receipt_amount", F.lit(0).cast("decimal(38,2)").alias("utilized_amount"), "invoice_id"
    )


def cash_payments(receipt_rows: DataFrame, headers: DataFrame, currency_id: int) -> DataFrame:
    """A cash payment per receipt and invoice of its order."""
    return map_receipts(receipt_rows, headers).select(
        "receipt_id",
        F.col("receipt_amount").alias("amount"),
        F.lit(currency_id).alias("currency_id"),
        F.col("receipt_amount").alias("base_amount"),
    )


def consultation_services(appointments: DataFrame, followups: DataFrame, services: DataFrame) -> DataFrame:
    """The service of each consultation: the first-visit or the repeat service of its type."""
    typed = lookup_join(appointments, followups, ["consultation_type_id"])
    key = choose_key(
        (F.col("is_first"), F.col("first_service_id")), (~F.col("is_first"), F.col("second_service_id"))
    )
    keyed = typed.withColumn("service_id", key).drop("first_service_id", "second_service_id")
    return lookup_join(keyed, services, ["service_id"])


def explode_panels(lines: DataFrame, panels: DataFrame) -> DataFrame:
    """Replace a panel service by its component services; other services stay."""
    components = panels.where("is_active").select(F.col("panel_id").alias("service_id"), "component_id")
    joined = fanout_join(lines, components, ["service_id"], "left")
    return joined.withColumn("service_id", F.coalesce("component_id", "service_id")).select(*lines.columns)


def stage_times(ordered: Column, hours: Mapping[str, int]) -> list[Column]:
    """One timestamp per stage, a fixed number of hours after the order."""
    return [shift(ordered, hours=h).alias(stage) for stage, h in hours.items()]


def stage_position(stages: DataFrame, stage: str) -> DataFrame:
    """One row: the id of the named stage and of the one before it in the order of the stages."""
    # A small master table; both come from one pass over it.
    before = F.lag("stage_id").over(Window.orderBy("stage_id"))
    placed = stages.withColumn("previous_stage_id", before).where(F.col("stage_name") == stage)
    return placed.select(F.col("stage_id").alias("current_stage_id"), "previous_stage_id")


_POSITION = {c: c for c in ("current_stage_id", "previous_stage_id")}


def at_stage(records: DataFrame, stages: DataFrame, stage: str) -> DataFrame:
    """Records with the ids of the named stage, which they have reached, and of the one before it."""
    return attach_one_row(records, stage_position(stages, stage), _POSITION)


def with_registration(records: DataFrame, services: DataFrame, patients: DataFrame, service: str) -> DataFrame:
    """Records with the section of the service in column ``service`` and the registration number of the patient."""
    sections = services.select(F.col("service_id").alias(service), "section_id")
    placed = lookup_join(records, sections, [service])
    return lookup_join(placed, patients.select("patient_id", "registration_number"), ["patient_id"])


def laboratory_records(
    lines: DataFrame,
    panels: DataFrame,
    investigations: DataFrame,
    patients: DataFrame,
    services: DataFrame,
    stages: DataFrame,
    as_of: Column,
    stage: str = "Issue",
) -> DataFrame:
    """Laboratory records: panels taken apart, investigated services kept; section of the ordered service, registration
    number and age of the patient, stage times, the stage reached and the one before."""
    single = explode_panels(lines.withColumn("_ordered", F.col("service_id")), panels)
    tested = lookup_join(single, investigations.select("service_id", "result_type"), ["service_id"])
    placed = with_registration(tested, services, patients, "_ordered")
    born = lookup_join(placed, patients.select("patient_id", "birth_date"), ["patient_id"])
    return at_stage(born, stages, stage).select(
        *lines.columns,
        "registration_number",
        "section_id",
        "result_type",
        "current_stage_id",
        "previous_stage_id",
        *stage_times(F.col("order_date"), LAB_STAGE_HOURS),
        age_value(F.col("birth_date"), as_of).alias("patient_age"),
        age_unit(F.col("birth_date"), as_of).alias("age_unit"),
    )


def radiology_records(
    lines: DataFrame,
    examinations: DataFrame,
    templates: DataFrame,
    patients: DataFrame,
    services: DataFrame,
    stages: DataFrame,
    stage: str = "Issue",
) -> DataFrame:
    """Radiology records of ordered examinations: section, registration number, stage times, the stage reached and the
    one before, and the first active template of the service."""
    active = templates.where("is_active").select("service_id", "template_id", "template")
    first = latest_per_key(active, ["service_id"], [F.col("template_id").asc()])
    examined = lookup_join(lines, examinations.where("is_active").select("service_id", "department_id"), ["service_id"])
    placed = with_registration(examined, services, patients, "service_id")
    with_template = lookup_join(placed, first, ["service_id"], "left")
    return at_stage(with_template, stages, stage).select(
        *lines.columns,
        "registration_number",
        "section_id",
        "department_id",
        "current_stage_id",
        "previous_stage_id",
        *stage_times(F.col("order_date"), RADIOLOGY_STAGE_HOURS),
        "template_id",
        "template",
    )


def stage_audit(records: DataFrame, stages: DataFrame, last_stage: str) -> DataFrame:
    """One row per record and stage, from the first stage up to the named one."""
    last = stages.where(F.col("stage_name") == last_stage).select("stage_id")
    return expand_up_to(records, stages, "stage_id", last)


def classify_results(results: DataFrame, ranges: DataFrame) -> DataFrame:
    """Results with the reference range of their service and the class of their value."""
    value = F.col("value")
    level = (
        F.when(value < F.col("critical_min"), "critical low")
        .when(value > F.col("critical_max"), "critical high")
        .when(value < F.col("normal_min"), "low")
        .when(value > F.col("normal_max"), "high")
        .when(value.isNotNull(), "normal")
    )
    return lookup_join(results, ranges, ["service"]).withColumn("level", level)


def code_complaints(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows with the diagnosis code of their complaint, whatever its letter case."""
    folded = codes.select(F.lower("complaint").alias("_complaint"), "icd_code")
    return lookup_join(rows.withColumn("_complaint", F.lower("complaint")), folded, ["_complaint"]).drop("_complaint")


def allocate_prescriptions(medications: DataFrame, stock: DataFrame, stock_batches: DataFrame) -> DataFrame:
    """Prescribed products that their warehouse has in stock, with the quantity to issue and the first batch."""
    place = ["warehouse_id", "product_id"]
    first_batch = (
        lookup_join(stock_batches.select("stock_id", "batch_number"), stock.select(*place, "stock_id"), ["stock_id"])
        .groupBy(*place)
        .agg(F.min("batch_number").alias("batch_number"))
    )
    quantity = dispensed_quantity(F.col("units"), F.col("dosage"), F.col("days"))
    needed = medications.withColumn("quantity", quantity)
    return lookup_join(needed, first_batch, place).select(*medications.columns, "quantity", "batch_number")
