"""Silver -> gold KPI tables (catalogue P07-P12, P16, A02-A08).

The four stay-based KPIs of the source each explode the stays into nights
again. Here the nights are generated once (``stay_nights``) and every measure
is a column of one aggregation at (date, hotel_id) (``nightly_measures``);
the KPIs are projections of it, so a dashboard that needs three of them runs
one explode, one shuffle and one join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import filters, joins, nights

KEYS = ("date", "hotel_id")  # also the order of the KPI tables (O01)
MAX_TURNOVER_MINUTES = 600.0  # fixed value: turnover cap (10 h)


def stay_nights(stays: DataFrame, lo=None, hi=None) -> DataFrame:
    """G01 + G02 over the folio fact: one row per night with its revenue share."""
    n = nights.explode_nights(stays.select("res_id", "hotel_id", "check_in_date", "check_out_date",
                                           "stay_length_nights", "total_price", "total_pos_amount",
                                           "pos_item_count"), lo=lo, hi=hi)
    return nights.allocate_per_night(n)


def nightly_measures(stays: DataFrame, lo=None, hi=None) -> DataFrame:
    """A02, A04, A05 and the ancillary sums in one aggregation per (date, hotel)."""
    n = stay_nights(stays, lo, hi)
    return n.groupBy(*KEYS).agg(
        F.sum("daily_room_revenue").alias("total_room_revenue"),
        F.count(F.lit(1)).alias("rooms_sold"),
        F.count_if(F.col("pos_item_count") > 0).alias("guests_with_ancillary_spend"),
        F.sum("total_pos_amount").alias("total_ancillary_revenue"),
    )


def rooms_by_day(calendar: DataFrame) -> DataFrame:
    """Distinct rooms per (date, hotel) of the daily calendar.

    The resolved calendar holds one row per (hotel, room, date), so the
    distinct count is a plain count: no distinct-aggregate expansion."""
    return calendar.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("total_available_rooms"))


def inventory_capacity(inventory_clean: DataFrame) -> DataFrame:
    """D08 alternative: capacity = rooms in the cleaned inventory per hotel
    (one row per hotel, independent of bookings)."""
    return inventory_clean.groupBy("hotel_id").agg(
        F.countDistinct("room_number").alias("total_available_rooms"))


def kpi_revpar_inventory(measures: DataFrame, capacity: DataFrame) -> DataFrame:
    """P07 with ``capacity='inventory'``: revenue over inventory rooms, and the
    occupancy this implies, for every (date, hotel) with sales. Capacity has
    one row per hotel, so the planner broadcasts it."""
    j = measures.join(capacity, "hotel_id", "left")
    return j.select(*KEYS, F.round("total_room_revenue", 2).alias("total_room_revenue"), "rooms_sold",
                    "total_available_rooms",
                    C.safe_ratio("total_room_revenue", "total_available_rooms").alias("revpar"),
                    C.safe_percent("rooms_sold", "total_available_rooms").alias("occupancy_rate"))


def kpi_revpar(measures: DataFrame, rooms: DataFrame) -> DataFrame:
    """Rooms ⟕ revenue (J06), missing revenue 0 (C17), safe ratio."""
    j = rooms.join(measures.select(*KEYS, "total_room_revenue"), list(KEYS), "left")
    rev = F.coalesce(F.col("total_room_revenue"), F.lit(0.0))
    return j.select(*KEYS, F.round(rev, 2).alias("total_room_revenue"), "total_available_rooms",
                    C.safe_ratio(rev, "total_available_rooms").alias("revpar")).orderBy(*KEYS)


def kpi_adr(measures: DataFrame) -> DataFrame:
    """Revenue per room-night sold. All-NULL revenue gives NULL."""
    return measures.select(*KEYS, F.round("total_room_revenue", 2).alias("total_room_revenue"),
                           "rooms_sold", C.safe_ratio("total_room_revenue", "rooms_sold").alias("adr")).orderBy(*KEYS)


def kpi_ancillary(measures: DataFrame) -> DataFrame:
    """Share of room-nights whose stay has POS spend (D11: per night)."""
    return measures.select(
        *KEYS, F.col("rooms_sold").alias("total_guests"), "guests_with_ancillary_spend",
        C.safe_percent("guests_with_ancillary_spend", "rooms_sold").alias("attachment_rate_percentage"),
        F.round("total_ancillary_revenue", 2).alias("total_ancillary_revenue"),
        C.safe_ratio("total_ancillary_revenue", "rooms_sold").alias("avg_ancillary_per_guest")).orderBy(*KEYS)


def kpi_ancillary_per_guest(stays: DataFrame) -> DataFrame:
    """P09 with ``per='guest'`` (D11, the spec's reading): distinct guests in
    house per (date, hotel), distinct guests with POS spend, and each stay's POS
    total spread evenly over its nights.

    No nights are made to tell guests apart: of a guest's stays in a hotel, in the order of
    their check-in, each counts the guest from where the earlier ones end. These spans
    (date to date) cover each of the guest's nights once. Equal spans of a hotel are
    summed before their nights are made. Equal stays of a guest are one row, so a
    guest's rows are bounded by the calendar."""
    s = stays.groupBy("hotel_id", "guest_id", "check_in_date", "check_out_date").agg(
        F.sum(F.col("total_pos_amount") / F.col("stay_length_nights")).alias("pos"),
        F.max(F.col("pos_item_count") > 0).alias("spends"))
    earlier = (Window.partitionBy("hotel_id", "guest_id").orderBy("check_in_date", "check_out_date")
               .rowsBetween(Window.unboundedPreceding, -1))
    known, spends = F.col("guest_id").isNotNull(), F.col("guest_id").isNotNull() & F.col("spends")
    s = s.withColumns({"_new": F.greatest("check_in_date", F.max("check_out_date").over(earlier)),
                       "_spends": F.greatest("check_in_date", F.max(F.when(F.col("spends"), F.col("check_out_date"))).over(earlier))})

    def span(start, guest, spender, pos, stay=False):
        return F.struct(F.lit(stay).alias("stay"), F.col(start).alias("start"), F.col("check_out_date").alias("end"), F.when(guest, 1).otherwise(0).alias("guests"),
                        F.when(spender, 1).otherwise(0).alias("spenders"), pos.cast("double").alias("pos"))
    no, nothing = F.lit(False), F.lit(None)
    spans = F.array(span("check_in_date", no, no, F.col("pos"), True), span("_new", known, no, nothing), span("_spends", no, spends, nothing))
    spans = s.select("hotel_id", F.inline(spans)).filter("stay or start < end").groupBy("hotel_id", "start", "end").agg(
        F.sum("guests").alias("guests"), F.sum("spenders").alias("spenders"), F.sum("pos").alias("pos"))
    m = nights.explode_nights(spans, "start", "end").groupBy(*KEYS).agg(
        F.sum("guests").alias("total_guests"),
        F.sum("spenders").alias("guests_with_ancillary_spend"),
        F.sum("pos").alias("total_ancillary_revenue"))
    return m.select(
        *KEYS, "total_guests", "guests_with_ancillary_spend",
        C.safe_percent("guests_with_ancillary_spend", "total_guests").alias("attachment_rate_percentage"),
        F.round("total_ancillary_revenue", 2).alias("total_ancillary_revenue"),
        C.safe_ratio("total_ancillary_revenue", "total_guests").alias("avg_ancillary_per_guest"))


def kpi_dashboard(measures: DataFrame, rooms: DataFrame) -> DataFrame:
    """P12 (J14): RevPAR ⟕ ADR ⟕ ancillary on (date, hotel). ADR and ancillary
    share the key set of ``measures``, so the chain is one left join."""
    j = rooms.join(measures, list(KEYS), "left")
    rev = F.coalesce(F.col("total_room_revenue"), F.lit(0.0))
    return j.select(
        *KEYS, C.safe_ratio(rev, "total_available_rooms").alias("revpar"),
        C.safe_ratio("total_room_revenue", "rooms_sold").alias("adr_raw"),
        C.safe_percent("guests_with_ancillary_spend", "rooms_sold").alias("att_raw"),
        C.safe_ratio("total_ancillary_revenue", "rooms_sold").alias("anc_raw"),
        F.col("rooms_sold").isNotNull().alias("_m"),
    ).select(*KEYS, "revpar",
             F.when(F.col("_m"), F.col("adr_raw")).alias("adr"),
             F.when(F.col("_m"), F.col("att_raw")).alias("attachment_rate_percentage"),
             F.when(F.col("_m"), F.col("anc_raw")).alias("avg_ancillary_per_guest")).orderBy(*KEYS)


def kpi_weekend_vs_weekday(measures: DataFrame, rooms: DataFrame) -> DataFrame:
    """Per (date, hotel) with the weekend flag of the night (C27) and
    capacity from the calendar (J07). The source joins capacity to every
    night and carries it with max(); aggregating first and joining the
    aggregate gives the same rows with a far smaller join."""
    j = measures.join(rooms, list(KEYS), "left")
    return j.select(
        *KEYS, C.is_weekend("date").alias("is_weekend"),
        C.safe_ratio("total_room_revenue", "rooms_sold").alias("adr"),
        C.safe_ratio("total_room_revenue", "total_available_rooms").alias("revpar"),
        C.safe_percent("rooms_sold", "total_available_rooms").alias("occupancy_rate"),
        "rooms_sold", "total_available_rooms",
        F.round("total_room_revenue", 2).alias("total_room_revenue")).orderBy(*KEYS)


def ancillary_by_category(stays: DataFrame, pos_clean: DataFrame,
                          categories: Sequence[str] = ("Food", "Drink")) -> DataFrame:
    """Attachment restricted to POS of chosen categories (per night, as P09)."""
    spend = (pos_clean.filter(F.col("res_id").isNotNull() & F.col("category").isin(*categories))
             .groupBy("res_id").agg(F.sum("amount").alias("cat_amount"), F.count(F.lit(1)).alias("cat_items")))
    s = stays.join(spend, "res_id", "left")
    n = nights.explode_nights(s.select("res_id", "hotel_id", "check_in_date", "check_out_date",
                                       "cat_amount", "cat_items"))
    m = n.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("total_guests"),
                             F.count_if(F.col("cat_items") > 0).alias("guests_with_category_spend"),
                             F.sum(F.coalesce(F.col("cat_amount"), F.lit(0.0))).alias("category_revenue"))
    return m.select(*KEYS, "total_guests", "guests_with_category_spend",
                    C.safe_percent("guests_with_category_spend", "total_guests").alias("attachment_rate_percentage"),
                    F.round("category_revenue", 2).alias("category_revenue"))


def turnover_pairs(checkouts: DataFrame, cleanings: DataFrame,
                   max_minutes: float = MAX_TURNOVER_MINUTES) -> DataFrame:
    """J08 + C30 + C31: (check-out, cleaning) pairs with 0 < minutes <= cap, equal
    ones as one row with ``n_checkouts`` and ``n_cleanings``.

    All check-outs of a room-day share one instant, so both sides are first
    aggregated to their distinct (room, instant): the join meets one row per
    room-day with that day's cleaning instants, and its output grows with the
    input. The source window is [checkout, checkout + 1 day] followed by the
    minutes cap; only the tighter cap matters, so the interval join uses it
    and its bounded day span as an equi key."""
    room = ["hotel_id", "room_number"]
    pairs = joins.same_day_interval_join(
        cleanings.groupBy(*room, "timestamp").agg(F.count(F.lit(1)).alias("n_cleanings")),
        checkouts.groupBy(*room, "check_out_date", "checkout_timestamp").agg(
            F.count(F.lit(1)).alias("n_checkouts")),
        room, "checkout_timestamp", "timestamp", min(max_minutes, 24 * 60))
    pairs = (pairs.withColumn("turnover_time_minutes", C.minutes_between("checkout_timestamp", "timestamp"))
             .withColumn("_turnover_seconds",
                         F.unix_timestamp("timestamp") - F.unix_timestamp("checkout_timestamp")))
    return filters.bounded(pairs, "turnover_time_minutes", 0.0, max_minutes)


def kpi_housekeeping_turnover(checkouts: DataFrame, cleanings: DataFrame,
                              max_minutes: float = MAX_TURNOVER_MINUTES,
                              first_clean_only: bool = False) -> DataFrame:
    """P10: A06 + A07 per (check-out date, hotel), C24 rename.
    ``total_checkouts`` counts matched pairs (D10); with ``first_clean_only``
    each check-out keeps only its first cleaning, so it counts check-outs.

    Pairs are weighted, not expanded. The median is the smallest duration at or
    below which half of the weight lies, over the distinct durations of a (date,
    hotel), of which the cap allows ``60 * max_minutes`` at most."""
    by = ["check_out_date", "hotel_id"]
    return turnover_stats(turnover_histogram(checkouts, cleanings, max_minutes, first_clean_only), by).withColumnRenamed(
        "check_out_date", "date").orderBy(*KEYS)


def turnover_histogram(checkouts: DataFrame, cleanings: DataFrame, max_minutes: float = MAX_TURNOVER_MINUTES,
                       first_clean_only: bool = False) -> DataFrame:
    """How often each duration occurs on a (check-out date, hotel): at most ``60 * max_minutes``
    rows each. Histograms of days add up to those of any range."""
    by = ["check_out_date", "hotel_id"]
    if first_clean_only:
        checkouts = checkouts.distinct()
        t = turnover_pairs(checkouts, cleanings, max_minutes)
        t = t.groupBy(*by, "room_number", "checkout_timestamp", "n_checkouts").agg(
            F.min("turnover_time_minutes").alias("turnover_time_minutes"),
            F.min("_turnover_seconds").alias("_turnover_seconds")).withColumn("_w", F.col("n_checkouts"))
    else:
        t = turnover_pairs(checkouts, cleanings, max_minutes).withColumn(
            "_w", F.col("n_checkouts") * F.col("n_cleanings"))
    return t.groupBy(*by, "turnover_time_minutes", "_turnover_seconds").agg(F.sum("_w").alias("_w"))


def turnover_stats(d: DataFrame, by: Sequence[str]) -> DataFrame:
    """A06 + A07 of histograms, which may hold a duration several times, at the keys ``by``."""
    d = d.groupBy(*by, "turnover_time_minutes", "_turnover_seconds").agg(F.sum("_w").alias("_w"))
    w = Window.partitionBy(*by)
    d = (d.withColumn("_upto", F.sum("_w").over(w.orderBy("turnover_time_minutes").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)))
         .withColumn("_all", F.sum("_w").over(w)))
    m = F.col("turnover_time_minutes")
    return (d.groupBy(*by).agg(
        F.sum("_w").alias("total_checkouts"),
        # mean of whole seconds, then minutes: exact, so rounding is stable
        F.round(F.sum(F.col("_w") * F.col("_turnover_seconds")) / F.sum("_w") / 60.0, 2)
        .alias("avg_turnover_time_minutes"),
        F.round(F.min(F.when(F.col("_upto") * 2 >= F.col("_all"), m)), 2).alias("median_turnover_time_minutes"),
        F.round(F.min(m), 2).alias("min_turnover_time_minutes"),
        F.round(F.max(m), 2).alias("max_turnover_time_minutes")))
