from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tideload.functions.dates import age_unit, age_value, boundary_months, boundary_years, ordinal_suffix, trunc_second
from tideload.functions.numbers import body_mass_index, from_units, minor_units
from tideload.functions.text import resplit, row_key, single_line
from tideload.operators.joins import expand_up_to
from tideload.operators.sampling import sample_branches, sample_top
from tideload.operators.updates import update_from, update_where_in
from tideload.plans.appointments import diary_slots, free_slots, mark_overbooked
from tideload.plans.billing import classify_results, code_complaints, complaint_codes, reference_ranges
from tideload.plans.calendar import calendar, calendar_columns, days_from
from tideload.plans.loads import LoadSpec, run_all, run_full, run_incremental
from tideload.plans.warehouse import invoice_fact


def test_calendar_range(spark):
    df = calendar(spark)
    assert len(df.columns) == 29
    bounds = df.agg(F.min("date_actual"), F.max("date_actual"), F.count("*"), F.countDistinct("date_dim_id")).first()
    assert tuple(bounds) == (date(1970, 1, 1), date(2049, 12, 31), 29220, 29220)


@pytest.mark.parametrize(
    ("day", "expected"),
    [
        ("1970-01-01", dict(date_dim_id=19700101, epoch=0, day_suffix="1st", day_name="Thursday", day_of_week=4,
                            week_of_year=1, week_of_year_iso="1970-W01-4", year_actual=1970, quarter_name="First")),
        ("2016-01-01", dict(week_of_year=53, year_actual=2015, first_day_of_year=date(2015, 1, 1),
                            last_day_of_year=date(2015, 12, 31), week_of_year_iso="2016-W53-5", week_of_month=1)),
        ("2000-02-29", dict(day_suffix="29th", last_day_of_month=date(2000, 2, 29), day_of_quarter=60, week_of_month=5,
                            mmyyyy="022000", mmddyyyy="02292000", month_name_abbreviated="Feb")),
        ("2012-12-31", dict(week_of_year=1, year_actual=2013, day_of_year=366, quarter_name="Fourth",
                            last_day_of_quarter=date(2012, 12, 31), first_day_of_quarter=date(2012, 10, 1))),
        ("2049-12-31", dict(day_suffix="31st", day_name="Friday", weekend_indr=False, month_name="December")),
        ("2024-06-22", dict(day_suffix="22nd", weekend_indr=True, first_day_of_week=date(2024, 6, 17),
                            last_day_of_week=date(2024, 6, 23), month_actual=6, quarter_actual=2)),
    ],
)
def test_calendar_days(spark, day, expected):
    row = calendar_columns(days_from(spark, day, 1)).first().asDict()
    assert {k: row[k] for k in expected} == expected


def test_strict_week_label(spark):
    assert calendar(spark, "2016-01-01", 1, strict_iso_label=True).first().week_of_year_iso == "2015-W53-5"


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_ordinals(spark):
    got = [r[0] for r in spark.range(1, 32).select(ordinal_suffix(F.col("id"))).collect()]
    assert got[:4] == ["1st", "2nd", "3rd", "4th"] and got[10:13] == ["11th", "12th", "13th"]
    assert got[20:23] == ["21st", "22nd", "23rd"] and got[30] == "31st"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_second_truncation_ignores_the_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on this day.
        got = one(spark, trunc_second(ntz("2024-03-10 02:30:15.999999")), trunc_second(ntz("1969-12-31 23:59:59.5")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == (datetime(2024, 3, 10, 2, 30, 15), datetime(1969, 12, 31, 23, 59, 59))


def test_boundaries_and_ages(spark):
    a, b = ntz("2019-12-31"), ntz("2020-01-01")
    assert one(spark, boundary_years(a, b), boundary_months(a, b)) == (1, 1)
    assert one(spark, age_value(a, b), age_unit(a, b)) == (1, "YEARS")
    assert one(spark, age_value(ntz("2020-01-01"), ntz("2020-01-31")), age_unit(ntz("2020-01-01"), ntz("2020-01-31"))) == (30, "DAYS")
    assert one(spark, age_value(ntz("2020-01-31"), ntz("2020-02-01")), age_unit(ntz("2020-01-31"), ntz("2020-02-01"))) == (1, "MONTHS")
    assert one(spark, age_unit(F.lit(None).cast("timestamp_ntz"), b)) == (None,)


def test_text_and_numbers(spark):
    df = spark.createDataFrame([("a,b,,", "x\r\ny", None)], "t string, u string, v string")
    got = df.select(resplit(F.col("t"), ",", "_"), single_line(F.col("u")), row_key(["t", "v", "u"])).first()
    assert tuple(got) == ("a_b__", "xy", "a,b,,__x\r\ny")
    assert one(spark, body_mass_index(F.lit(Decimal("70.00")), F.lit(Decimal("175")))) == (Decimal("22.86"),)
    assert one(spark, minor_units(F.lit(1.15)), minor_units(F.lit(-2.5)), from_units(F.lit(-250))) == (115, -250, Decimal("-2.50"))


def test_updates(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k int, v string, n int")
    source = spark.createDataFrame([(1, "A"), (2, None)], "k int, w string")
    assert rows(update_from(target, source, ["k"], {"v": "w"})) == [(1, "A", 1), (2, None, 2), (3, "c", 3)]
    hits = spark.createDataFrame([(3,), (3,)], "k int")
    assert rows(update_where_in(target, hits, ["k"], {"n": F.lit(0)})) == [(1, "a", 1), (2, "b", 2), (3, "c", 0)]


def test_samples_repeat(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 2)
    assert rows(sample_top(df, "id", 10)) == rows(sample_top(df.repartition(7), "id", 10))
    assert rows(sample_top(df, "id", 10, 1)) != rows(sample_top(df, "id", 10, 2))
    picked = sample_branches(df, [(F.col("g") == 0, 4), (F.col("id") < 50, 4)], "id", 100)
    assert 4 <= picked.count() <= 8 and picked.count() == picked.distinct().count()


def test_stages(spark):
    steps = spark.createDataFrame([(2, "b"), (4, "d"), (7, "g")], "stage_id int, name string")
    records = spark.range(2)
    upto = lambda n: expand_up_to(records, steps, "stage_id", steps.where(F.col("name") == n).select("stage_id"))
    assert rows(upto("d"), "id", "stage_id") == [(0, 2), (0, 4), (1, 2), (1, 4)]
    assert upto("b").count() == 2 and upto("none").count() == 0


def test_reference_values(spark):
    results = spark.createDataFrame(
        [("Ammonia", 3.0), ("Ammonia", 5.0), ("Ammonia", 9.0), ("Ammonia", 55.0), ("Ammonia", 61.0), ("Other", 1.0)],
        "service string, value double",
    )
    got = rows(classify_results(results, reference_ranges(spark)), "value", "level")
    assert got == [(3.0, "critical low"), (5.0, "low"), (55.0, "high"), (61.0, "critical high"), (9.0, "normal")]
    complaints = spark.createDataFrame([("CHEST pain",), ("Cough",)], "complaint string")
    assert rows(code_complaints(complaints, complaint_codes(spark))) == [("CHEST pain", "R07.9")]


def test_slots(spark):
    diary = spark.createDataFrame(
        [(1, "Monday", 0, 32400, 36000, 1800), (2, "Monday", 1, 32400, 35999, 1800), (3, "Monday", 1, 100, 200, 1800)],
        "doctor_id int, weekday string, overbook_count int, start_second int, end_second int, slot_seconds int",
    )
    slots = diary_slots(diary)
    assert rows(slots, "doctor_id", "slot_second") == [(1, 32400), (1, 34200), (2, 32400)]
    times = [datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 9, 30)]
    dated = spark.createDataFrame(
        [(d, t, o) for d, o in ((1, 0), (2, 1)) for t in times], "doctor_id int, start_time timestamp_ntz, overbook_count int"
    )
    booked = spark.createDataFrame(
        [(1, times[0], False), (2, times[0], False), (2, times[1], True)],
        "doctor_id int, start_time timestamp_ntz, is_overbooked boolean",
    )
    assert rows(free_slots(dated, booked), "doctor_id", "start_time") == [(1, times[1]), (2, times[0])]
    marked = rows(mark_overbooked(booked, slots), "doctor_id", "start_time", "is_overbooked")
    assert marked == [(1, times[0], True), (2, times[0], True), (2, times[1], True)]


def test_fact_counts_each_admission_without_forming_the_join(spark):
    details = spark.createDataFrame(
        [(1, 1, 1, 7, 10), (1, 1, 1, 7, 5), (2, 1, 1, 8, 3), (2, 1, 1, 9, 4)],
        "service_id int, hospital_id int, doctor_id int, patient_id int, m int",
    )
    patients = spark.createDataFrame([(7,), (8,)], "patient_id int")
    admissions = spark.createDataFrame([(7, "x"), (7, "x"), (7, "y"), (7, "?"), (7, "!")], "patient_id int, diagnosis_id string")
    diagnoses = spark.createDataFrame([("x",), ("y",)], "diagnosis_id string")
    got = rows(invoice_fact(details, patients, admissions, diagnoses, ["m"]), "patient_id", "diagnosis_id", "m")
    assert got == sorted([(7, "x", 30), (7, "y", 15), (7, None, 30), (8, None, 3)], key=str)
    once = invoice_fact(details, patients, admissions, diagnoses, ["m"], each_admission=False)
    assert rows(once, "diagnosis_id", "m") == sorted([("x", 15), ("y", 15), (None, 15), (None, 3)], key=str)


def test_loads_of_many_tables(spark, scratch):
    specs = [LoadSpec("a", ["k"], ["k", "v"]), LoadSpec("b", ["k"], ["k", "v", "ts"], op=None, ts="ts")]
    day = ntz("2024-01-01")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = a.withColumn("ts", day)
    run_all(spark, specs, run_full, {"a": a, "b": b}, f"{scratch}/w", f"{scratch}/audit")
    changes = spark.createDataFrame([(1, "", "DELETE")], "k int, v string, header__operation string")
    newer = spark.createDataFrame([(3, "z")], "k int, v string").withColumn("ts", day)
    counts = run_all(
        spark, specs, run_incremental, {"a": changes.withColumn("header__timestamp", day), "b": newer},
        f"{scratch}/w", f"{scratch}/audit",
    )
    assert rows(counts, "tablename", "count") == [("a", 1), ("b", 3)]
