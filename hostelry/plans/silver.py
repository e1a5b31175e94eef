"""Bronze -> silver pipelines (catalogue P01, P03, P05, P06, P17-P21, A01).

Every function takes DataFrames and returns a DataFrame; nothing is counted,
collected or written here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import dedup, filters, joins, nights, scd2

PRICE_BOUNDS = (0.0, 10000.0)     # fixed value: open interval for room price
POS_AMOUNT_BOUNDS = (0.0, 5000.0)  # fixed value: open interval for POS amount
#: What copies under new ids have in common.
RESERVATION_CONTENT = ("guest_id", "hotel_id", "room_number", "room_type", "check_in_date", "check_out_date", "total_price",
                       "booking_channel")
POS_CONTENT = ("res_id", "item_name", "category", "amount", "timestamp")


# --------------------------------------------------------------------------- guests
def clean_guests(guests: DataFrame) -> DataFrame:
    """Typed guests with their dedup key."""
    g = filters.require_keys(guests, ["guest_id"])
    email = C.clean_email("email")
    base = C.email_base(email)
    return g.select(
        "guest_id",
        C.clean_name("name").alias("name"),
        email.alias("email"),
        C.canonical_tier("loyalty_tier").alias("loyalty_tier"),
        C.clean_country("country").alias("country"),
        C.parse_date_multi("registration_date").alias("registration_date"),
        C.parse_ts_multi("updated_at").alias("updated_at"),
        base.alias("email_base"),
        C.dedup_key(base, "guest_id").alias("dedup_key"),
    )


def latest_guests(cleaned: DataFrame) -> DataFrame:
    """W01 then C16: one guest per dedup key (latest update, then highest id);
    guests without a parseable update time are dropped."""
    one = dedup.latest_per_key(cleaned, ["dedup_key"],
                               [F.col("updated_at").desc_nulls_last(), F.col("guest_id").desc()])
    return filters.drop_null(one, "updated_at").drop("email_base", "dedup_key")


def dim_guests_batch(guests: DataFrame, collapse: bool = False) -> DataFrame:
    """Bronze guests -> SCD2 dimension (faithful row mode by default)."""
    latest = latest_guests(clean_guests(guests))
    dim = scd2.scd2_from_history(latest, collapse=collapse, tie=["guest_id"])
    return dim.select(*scd2.DIM_COLUMNS)


HISTORY_COLUMNS = ("guest_sk", "guest_id", "loyalty_tier", "valid_from", "valid_to", "is_current", "version")


def scd2_history(changes: DataFrame, collapse: bool = False) -> DataFrame:
    """W04-W07 over an undeduplicated change log (guest_id, tier, updated_at, change_seq)."""
    h = scd2.scd2_from_history(changes, tie=["change_seq"], collapse=collapse)
    return h.select(*HISTORY_COLUMNS)


def history_columns(rows: DataFrame) -> DataFrame:
    """The history's columns from its stored rows (updated_at, valid_to, version)."""
    return rows.withColumns({"valid_from": F.col("updated_at"), "is_current": F.col("valid_to").isNull(),
                             "guest_sk": C.surrogate_key("guest_id", "version")}).select(*HISTORY_COLUMNS)


# --------------------------------------------------------------------- reservations
def parse_reservations(res: DataFrame, checkout_formats=C.CHECKOUT_DATE_FORMATS) -> DataFrame:
    """C01, C05, C06, C10-C12, C14 (no dedup)."""
    r = filters.require_keys(res, ["res_id"])
    r = r.select(
        "res_id", "guest_id", "hotel_id", "room_number",
        C.canonical_room_type("room_type").alias("room_type"),
        filters.computed_once(C.parse_date_multi("check_in_date").alias("check_in_date"),
                              C.parse_date_multi("check_out_date", checkout_formats).alias("check_out_date")),
        C.null_outside_range("total_price", *PRICE_BOUNDS).alias("total_price"),
        C.canonical_channel("booking_channel").alias("booking_channel"),
        C.parse_ts_multi("created_at").alias("created_at"),
    )
    return filters.valid_interval(r, "check_in_date", "check_out_date")


def clean_reservations(res: DataFrame, content_key: Sequence[str] = ()) -> DataFrame:
    """Typed, bounded, one row per res_id (W02: latest created_at; ties
    broken by the row content so the result is deterministic). Option (D02):
    rows equal on ``content_key`` are copies under new ids, and the one of
    smallest res_id stays."""
    one = latest_reservations(parse_reservations(res))
    return dedup.latest_per_key(one, content_key, [F.col("res_id").asc()]) if content_key else one


def latest_reservations(parsed: DataFrame) -> DataFrame:
    """Of each res_id the row created last."""
    order = [F.col("created_at").desc_nulls_last(), F.col("total_price").desc_nulls_last(),
             F.col("check_in_date").desc(), F.col("check_out_date").desc()]
    return dedup.latest_per_key(parsed, ["res_id"], order)


# ------------------------------------------------------------------------------ POS
def clean_pos(pos: DataFrame, content_key: Sequence[str] = (), also: Sequence[str] = ()) -> DataFrame:
    """C01, C07, C11, C13. Option (D02): of the rows equal on
    ``content_key`` the one of smallest txn_id stays. ``also``: further columns kept as they are."""
    p = filters.require_keys(pos, ["txn_id"])
    p = p.select("txn_id", "res_id", "item_name",
                 C.canonical_category("category").alias("category"),
                 "amount", filters.computed_once(C.parse_ts_multi("timestamp").alias("timestamp")), *also)
    p = filters.drop_null(filters.drop_outside_range(p, "amount", *POS_AMOUNT_BOUNDS), "timestamp")
    return dedup.latest_per_key(p, content_key, [F.col("txn_id").asc()]) if content_key else p


def pos_by_reservation(pos_clean: DataFrame) -> DataFrame:
    """Sum and count per reservation; walk-ins (NULL res_id) excluded.
    Partial aggregation combines map-side, so a hot res_id is cheap."""
    return (pos_clean.filter(F.col("res_id").isNotNull()).groupBy("res_id")
            .agg(F.sum("amount").alias("total_pos_amount"), F.count(F.lit(1)).alias("pos_item_count")))


def survivor_map(cleaned_guests: DataFrame) -> DataFrame:
    """D05 option: guest_id -> the id that survived its dedup group (W01), for
    every guest whose group has a survivor with a valid update time."""
    order = [F.col("updated_at").desc_nulls_last(), F.col("guest_id").desc()]
    surv = dedup.latest_per_key(cleaned_guests, ["dedup_key"], order).filter(F.col("updated_at").isNotNull())
    return cleaned_guests.select("guest_id", "dedup_key").join(
        surv.select("dedup_key", F.col("guest_id").alias("survivor_guest_id")), "dedup_key", "inner").drop("dedup_key")


def remap_guests(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace guest_id by its survivor where the map has one."""
    cols = df.columns
    j = df.join(mapping, "guest_id", "left")
    return j.select(*[F.coalesce("survivor_guest_id", "guest_id").alias("guest_id") if c == "guest_id" else c
                      for c in cols])


# ------------------------------------------------------------------------ inventory
def clean_inventory(inv: DataFrame) -> DataFrame:
    """C01 on (hotel_id, room_number), C15 room '9999', C05."""
    i = filters.require_keys(inv, ["hotel_id", "room_number"])
    i = filters.drop_sentinel(i, "room_number", C.INVALID_ROOM_SENTINEL)
    return i.select("hotel_id", "room_number", C.canonical_room_type("room_type").alias("room_type"),
                    "floor", "max_occupancy")


# ------------------------------------------------------------------------ folio fact
def fact_stays(res_clean: DataFrame, pos_totals: DataFrame) -> DataFrame:
    """Reservations with their POS totals (before the
    orphan filter)."""
    j = res_clean.join(pos_totals, "res_id", "left").withColumns(C.fill_missing({"total_pos_amount": 0.0, "pos_item_count": 0}))
    return j.select(
        "res_id", "guest_id", "hotel_id", "room_type", "check_in_date", "check_out_date",
        C.nights("check_in_date", "check_out_date").alias("stay_length_nights"),
        "total_price", "booking_channel",
        "total_pos_amount", C.null_safe_sum("total_price", "total_pos_amount").alias("total_folio_amount"),
        "pos_item_count", "created_at")


def fact_stays_unified(res_clean: DataFrame, pos_clean: DataFrame, dim_guests: DataFrame,
                       raw_inventory: DataFrame) -> DataFrame:
    """Folio fact restricted to known guests (J02) and hotels."""
    return known_stays(fact_stays(res_clean, pos_by_reservation(pos_clean)), dim_guests, raw_inventory)


def known_stays(stays: DataFrame, dim_guests: DataFrame, raw_inventory: DataFrame) -> DataFrame:
    """Stays of known guests in known hotels."""
    return joins.keep_known(joins.keep_known(stays, dim_guests, ["guest_id"]), raw_inventory, ["hotel_id"])


# ------------------------------------------------------------------ daily calendar
CALENDAR_COLUMNS = ("date", "hotel_id", "room_number", "room_type", "is_available", "res_id",
                    "guest_id", "check_in_date", "check_out_date", "is_overbooked")


def _calendar(stays_with_rooms: DataFrame) -> DataFrame:
    n = nights.explode_nights(stays_with_rooms)
    resolved = dedup.resolve_overbooking(n)
    return resolved.withColumn("is_available", F.lit(False)).select(*CALENDAR_COLUMNS)


def fact_room_availability_daily(res_clean: DataFrame) -> DataFrame:
    """Reservations with a room -> nights -> overbooking flag and
    resolution (first res_id wins). The batch form keeps room '9999'."""
    with_rooms = res_clean.filter(F.col("room_number").isNotNull())
    return _calendar(with_rooms)


def fact_room_availability_raw(res: DataFrame) -> DataFrame:
    """The streaming job's calendar: drops room '9999', parses two
    date formats, keeps the raw room type and dedups by earliest check-in (W03)."""
    r = filters.require_keys(res, ["res_id", "room_number"])
    r = filters.drop_sentinel(r, "room_number", C.INVALID_ROOM_SENTINEL)
    r = r.select("res_id", "guest_id", "hotel_id", "room_number", "room_type",
                 filters.computed_once(C.parse_date_multi("check_in_date", C.SHORT_DATE_FORMATS).alias("check_in_date"),
                                       C.parse_date_multi("check_out_date", C.SHORT_DATE_FORMATS).alias("check_out_date")))
    r = filters.valid_interval(r, "check_in_date", "check_out_date")
    # W03 orders by check_in only; ties are broken on the rest of the row.
    r = dedup.latest_per_key(r, ["res_id"], [F.col("check_in_date").asc(), F.col("check_out_date").asc(),
                                             F.col("room_number").asc(), F.col("guest_id").asc(),
                                             F.col("hotel_id").asc(), F.col("room_type").asc_nulls_first()])
    return _calendar(r)


# ------------------------------------------------------------------ gold inputs
def clean_housekeeping(logs: DataFrame) -> DataFrame:
    """P20: 'Clean' events with a valid time."""
    h = filters.require_keys(logs, ["log_id"])
    h = h.select("hotel_id", "room_number", C.canonical_status("status").alias("status"),
                 filters.computed_once(C.parse_ts_multi("timestamp").alias("timestamp")))
    return h.filter((F.col("status") == "Clean") & F.col("timestamp").isNotNull())


def checkout_events(res: DataFrame, checkout_time: str = C.CHECKOUT_TIME_OF_DAY) -> DataFrame:
    """Raw reservations with a room -> check-out instant (C10 with two
    formats, C29). Not deduplicated, as in the source."""
    r = filters.require_keys(res, ["res_id", "room_number"])
    r = r.select("res_id", "hotel_id", "room_number",
                 filters.computed_once(C.parse_date_multi("check_out_date", C.SHORT_DATE_FORMATS).alias("check_out_date")))
    r = filters.drop_null(r, "check_out_date")
    return r.withColumn("checkout_timestamp", C.at_time_of_day("check_out_date", checkout_time))
