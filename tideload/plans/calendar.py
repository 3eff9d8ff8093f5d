"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideload.functions.dates import iso_weekday, ordinal_suffix, week_of_month

# The published range of the dimension, 1970-01-01 to 2049-12-31.
FIRST_DAY = "1970-01-01"
DAYS = 29220

# The names of the quarters.
QUARTER_NAMES = ("First", "Second", "Third", "Fourth")


def days_from(spark: SparkSession, first: str = FIRST_DAY, days: int = DAYS, name: str = "date_actual") -> DataFrame:
    """A run of consecutive days."""
    return spark.range(days).select(F.date_add(F.lit(first).cast("date"), F.col("id").cast("int")).alias(name))


def days_between(bounds: DataFrame, first: str, last: str, name: str = "date_actual") -> DataFrame:
    """Every day of the ranges given by two date columns."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))).alias(name))


def iso_week_label(day: Column, strict: bool) -> Column:
    """``2024-W01-1``. By default with the calendar year, ``strict`` with the year of the ISO week."""
    year = F.extract(F.lit("YEAROFWEEK"), day) if strict else F.year(day)
    return F.concat(
        F.lpad(year.cast("string"), 4, "0"),
        F.lit("-W"),
        F.lpad(F.weekofyear(day).cast("string"), 2, "0"),
        F.lit("-"),
        iso_weekday(day).cast("string"),
    )


def calendar_columns(days: DataFrame, day: str = "date_actual", strict_iso_label: bool = False) -> DataFrame:
    """The 29 columns of the dimension for each day; year columns follow the ISO year."""
    d = F.col(day)
    iso_year = F.extract(F.lit("YEAROFWEEK"), d)
    quarter_start = F.trunc(d, "quarter")
    quarter_name = F.element_at(F.array(*[F.lit(q) for q in QUARTER_NAMES]), F.quarter(d))
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_dim_id"),
        d.alias("date_actual"),
        (F.unix_date(d).cast("bigint") * 86400).alias("epoch"),
        ordinal_suffix(F.dayofmonth(d)).alias("day_suffix"),
        F.date_format(d, "EEEE").alias("day_name"),
        iso_weekday(d).alias("day_of_week"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.datediff(d, quarter_start) + 1).alias("day_of_quarter"),
        F.dayofyear(d).alias("day_of_year"),
        week_of_month(d).alias("week_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        iso_week_label(d, strict_iso_label).alias("week_of_year_iso"),
        F.month(d).alias("month_actual"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_abbreviated"),
        F.quarter(d).alias("quarter_actual"),
        quarter_name.alias("quarter_name"),
        iso_year.cast("int").alias("year_actual"),
        F.date_add(d, 1 - iso_weekday(d)).alias("first_day_of_week"),
        F.date_add(d, 7 - iso_weekday(d)).alias("last_day_of_week"),
        F.trunc(d, "month").alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        quarter_start.alias("first_day_of_quarter"),
        F.last_day(F.add_months(quarter_start, 2)).alias("last_day_of_quarter"),
        F.make_date(iso_year.cast("int"), F.lit(1), F.lit(1)).alias("first_day_of_year"),
        F.make_date(iso_year.cast("int"), F.lit(12), F.lit(31)).alias("last_day_of_year"),
        F.date_format(d, "MMyyyy").alias("mmyyyy"),
        F.date_format(d, "MMddyyyy").alias("mmddyyyy"),
        (iso_weekday(d) >= 6).alias("weekend_indr"),
    )


def calendar(
    spark: SparkSession, first: str = FIRST_DAY, days: int = DAYS, strict_iso_label: bool = False
) -> DataFrame:
    """The calendar dimension for a range of days."""
    return calendar_columns(days_from(spark, first, days), strict_iso_label=strict_iso_label)
