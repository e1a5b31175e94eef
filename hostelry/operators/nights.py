"""Stay intervals to nights (catalogue G01-G03)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_nights(df: DataFrame, start: str = "check_in_date", end: str = "check_out_date",
                   out: str = "date", lo: str | _dt.date | None = None,
                   hi: str | _dt.date | None = None) -> DataFrame:
    """One row per night of the half-open stay [start, end).

    Rows must already satisfy ``end > start`` (valid_interval): ``sequence``
    raises on a descending range. ``lo``/``hi`` restrict the nights to a date
    window *and* add ``start <= hi and end > lo`` before the generator, so the
    restriction reaches the scan as a pushed (partition) filter instead of
    being applied to exploded rows.
    """
    if lo is not None or hi is not None:
        cond = F.lit(True)
        if hi is not None:
            cond = cond & (F.col(start) <= F.lit(hi).cast("date"))
        if lo is not None:
            cond = cond & (F.col(end) > F.lit(lo).cast("date"))
        df = df.filter(cond)
    nights = F.explode(F.sequence(F.col(start), F.date_sub(F.col(end), 1), F.expr("INTERVAL 1 DAY")))
    df = df.select("*", nights.alias(out))
    if lo is not None:
        df = df.filter(F.col(out) >= F.lit(lo).cast("date"))
    if hi is not None:
        df = df.filter(F.col(out) <= F.lit(hi).cast("date"))
    return df


def allocate_per_night(df: DataFrame, amount: str = "total_price", nights: str = "stay_length_nights",
                       out: str = "daily_room_revenue") -> DataFrame:
    """Spread an amount evenly over the nights of its stay."""
    return df.withColumn(out, F.col(amount) / F.col(nights))


def availability_calendar(inventory: DataFrame, occupied: DataFrame, start: str | _dt.date,
                          end: str | _dt.date) -> DataFrame:
    """Full room x date calendar with ``is_available``.

    The occupied nights of a room are gathered first, at most one for each day of the
    range, and meet the room in one join of rooms; the dates are generated after it, so the
    calendar's rows are neither shuffled nor sorted. ``occupied`` must hold one row per
    (hotel_id, room_number, date), e.g. the resolved daily calendar.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    slot = F.struct("date", "res_id", "guest_id", "is_overbooked")
    occ = (occupied.filter(F.col("date").between(first, last)).groupBy("hotel_id", "room_number")
           .agg(F.collect_list(slot).alias("_occ")))
    rooms = inventory.select("hotel_id", "room_number", "room_type").join(occ, ["hotel_id", "room_number"], "left")
    rooms = rooms.withColumn("_occ", F.coalesce("_occ", F.array().cast(occ.schema["_occ"].dataType)))
    free = F.array_except(F.sequence(first, last, F.expr("INTERVAL 1 DAY")), F.col("_occ.date"))
    # the booked nights come first; the zip fills the columns of the free ones with NULL
    days = F.arrays_zip(F.concat(F.col("_occ.date"), free), F.col("_occ.res_id"), F.col("_occ.guest_id"), F.col("_occ.is_overbooked"))
    return (rooms.select("hotel_id", "room_number", "room_type", F.inline(days).alias("date", "res_id", "guest_id", "_over"))
            .select("date", "hotel_id", "room_number", "room_type",
                    F.col("res_id").isNull().alias("is_available"), "res_id", "guest_id",
                    F.coalesce(F.col("_over"), F.lit(False)).alias("is_overbooked")))
