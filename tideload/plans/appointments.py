"""Appointment slots and bookings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideload.functions.dates import at_time, seconds_of_day, weekday_name
from tideload.operators.joins import fanout_join, lookup_join
from tideload.operators.updates import update_where_in


def diary_slots(diary: DataFrame) -> DataFrame:
    """One row per slot of a diary line (``start_second``, ``end_second``, ``slot_seconds``)."""
    last = F.col("end_second") - F.col("slot_seconds")
    starts = F.when(last >= F.col("start_second"), F.sequence("start_second", last, "slot_seconds"))
    keep = [c for c in diary.columns if c not in ("start_second", "end_second", "slot_seconds")]
    return diary.select(*keep, F.explode(starts).alias("slot_second"))


def dated_slots(slots: DataFrame, days: DataFrame) -> DataFrame:
    """The weekly slots of a doctor on each of the given ``(doctor_id, day)`` with their start time."""
    named = days.withColumn("weekday", weekday_name(F.col("day")))
    return fanout_join(named, slots, ["doctor_id", "weekday"]).withColumn(
        "start_time", at_time(F.col("day"), F.col("slot_second"))
    )


def free_slots(slots: DataFrame, appointments: DataFrame) -> DataFrame:
    """Dated slots that take a booking, with ``is_shared`` where there is one already.

    A slot is free if it has no booking yet, or a booking that is known not to be overbooked
    while the doctor allows overbooking. Slots whose ``is_used`` (where there is such a column)
    is not false are taken. Bookings are reduced to one row per start time first.
    """
    if "is_used" in slots.columns:
        slots = slots.where(~F.col("is_used"))
    booked = appointments.groupBy("doctor_id", "start_time").agg(
        F.bool_or(~F.col("is_overbooked")).alias("_single"), F.lit(True).alias("_booked")
    )
    joined = lookup_join(slots, booked, ["doctor_id", "start_time"], "left")
    shared = F.col("_booked").isNotNull()
    shareable = (F.col("overbook_count") != 0) & F.col("_single")
    return joined.where(~shared | shareable).select(*slots.columns, shared.alias("is_shared"))


def full_starts(appointments: DataFrame, slots: DataFrame) -> DataFrame:
    """``(doctor_id, start_time)`` at which the bookings equal the slots of that time."""
    booked = appointments.groupBy("doctor_id", "start_time").agg(F.count(F.lit(1)).alias("taken"))
    timed = booked.withColumn("weekday", weekday_name(F.col("start_time"))).withColumn(
        "slot_second", seconds_of_day(F.col("start_time"))
    )
    capacity = slots.groupBy("doctor_id", "weekday", "slot_second").agg(F.count(F.lit(1)).alias("capacity"))
    return (
        lookup_join(timed, capacity, ["doctor_id", "weekday", "slot_second"])
        .where("taken = capacity")
        .select("doctor_id", "start_time", "taken")
    )


def mark_overbooked(appointments: DataFrame, slots: DataFrame) -> DataFrame:
    """Appointments with ``is_overbooked`` set where their start time is full."""
    full = full_starts(appointments, slots)
    return update_where_in(appointments, full, ["doctor_id", "start_time"], {"is_overbooked": F.lit(True)})
