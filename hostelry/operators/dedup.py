"""Keep-one-row-per-key operators (catalogue W01-W03, W08-W09, O06).

Top-1 per key is written as ``row_number() ... = 1``. Catalyst turns that
shape into a partial ``WindowGroupLimit`` before the shuffle, so a hot key
ships at most one row per input partition instead of all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key group under ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def drop_duplicates_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key (O06); use only where copies are equal on the
    columns that matter downstream."""
    return df.dropDuplicates(list(keys))


def resolve_overbooking(nights: DataFrame, slot: Sequence[str] = ("hotel_id", "room_number", "date"),
                        winner: str = "res_id",
                        carry: Sequence[str] = ("room_type", "guest_id", "check_in_date",
                                                "check_out_date")) -> DataFrame:
    """Flag slots booked more than once and keep the lowest ``winner`` (W08 + W09).

    Written as one aggregation rather than two windows: ``count`` and
    ``min(struct(winner, ...))`` both combine map-side, so a slot with a huge
    number of bookings never gathers its rows in one task.
    """
    first = F.min(F.struct(F.col(winner), *[F.col(c) for c in carry])).alias("_first")
    agg = nights.groupBy(*slot).agg(F.count(winner).alias("booking_count"), first)
    return agg.select(*slot, *[F.col(f"_first.{c}").alias(c) for c in (winner, *carry)],
                      (F.col("booking_count") > 1).alias("is_overbooked"), "booking_count")
