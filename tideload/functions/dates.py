"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trunc_second(ts: Column) -> Column:
    """Drop the fraction of a second.

    Stays ``timestamp_ntz`` for such input, which ``date_trunc`` does not, so the
    value never passes through the session time zone.
    """
    fraction = F.date_part(F.lit("SECOND"), ts) - F.second(ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)


def boundary_years(start: Column, end: Column) -> Column:
    """Year boundaries crossed, not years elapsed."""
    return F.year(end) - F.year(start)


def boundary_months(start: Column, end: Column) -> Column:
    """Month boundaries crossed."""
    return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))


def boundary_days(start: Column, end: Column) -> Column:
    """Day boundaries crossed."""
    return F.datediff(end.cast("date"), start.cast("date"))


def age_unit(birth: Column, as_of: Column) -> Column:
    """DAYS below one month boundary, MONTHS below one year boundary, else YEARS."""
    return (
        F.when(boundary_months(birth, as_of) < 1, F.lit("DAYS"))
        .when(boundary_years(birth, as_of) < 1, F.lit("MONTHS"))
        .when(birth.isNotNull() & as_of.isNotNull(), F.lit("YEARS"))
    )


def age_value(birth: Column, as_of: Column) -> Column:
    """The age counted in the unit of :func:`age_unit`."""
    return (
        F.when(boundary_months(birth, as_of) < 1, boundary_days(birth, as_of))
        .when(boundary_years(birth, as_of) < 1, boundary_months(birth, as_of))
        .otherwise(boundary_years(birth, as_of))
    )


def shift(ts: Column, days: int = 0, hours: int = 0, minutes: int = 0) -> Column:
    """``ts`` moved by a fixed offset."""
    return ts + F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(0))


def at_time(day: Column, seconds_of_day: Column) -> Column:
    """A calendar day joined with a time of day given in seconds since midnight."""
    midnight = day.cast("date").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds_of_day, midnight)


def seconds_of_day(ts: Column) -> Column:
    """Whole seconds since midnight."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def weekday_name(ts: Column) -> Column:
    """Full English weekday name."""
    return F.date_format(ts.cast("date"), "EEEE")


def iso_weekday(day: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(day) + 1


def week_of_month(day: Column) -> Column:
    """Week 1 is days 1 to 7 whatever the weekday."""
    return F.floor((F.dayofmonth(day) - 1) / 7).cast("int") + 1


def ordinal_suffix(n: Column) -> Column:
    """``1st``, ``2nd``, ``3rd``, ``4th``, ``11th`` …"""
    last_digit = n % 10
    teen = (n % 100).between(11, 13)
    ending = (
        F.when(teen, F.lit("th"))
        .when(last_digit == 1, F.lit("st"))
        .when(last_digit == 2, F.lit("nd"))
        .when(last_digit == 3, F.lit("rd"))
        .otherwise(F.lit("th"))
    )
    return F.concat(n.cast("string"), ending)
