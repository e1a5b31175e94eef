"""Hand-computed micro-fixtures for the cleaning and KPI rules."""
import datetime as dt

from pyspark.sql import functions as F

from hostelry.functions import clean as C
from hostelry.operators import dedup, filters, nights, scd2
from hostelry.plans import gold, silver


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_nights_of_stay(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 15), dt.date(2024, 1, 18))], "res_id long, check_in_date date, check_out_date date")
    got = sorted(r["date"] for r in nights.explode_nights(df).collect())
    assert got == [dt.date(2024, 1, 15), dt.date(2024, 1, 16), dt.date(2024, 1, 17)]


def test_empty_stay_dropped_before_explode(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 15), dt.date(2024, 1, 15)), (2, None, dt.date(2024, 1, 2))],
                               "res_id long, check_in_date date, check_out_date date")
    assert filters.valid_interval(df, "check_in_date", "check_out_date").count() == 0


def test_ambiguous_date_is_day_first(spark):
    assert one(spark, C.parse_date_multi, "03/04/2024") == dt.date(2024, 4, 3)
    assert one(spark, C.parse_date_multi, "12/25/2024") == dt.date(2024, 12, 25)


def test_month_first_dash_only_in_checkout_list(spark):
    assert one(spark, lambda c: C.parse_date_multi(c, C.CHECKOUT_DATE_FORMATS), "01-31-2024") == dt.date(2024, 1, 31)
    assert one(spark, lambda c: C.parse_date_multi(c, C.SHORT_DATE_FORMATS), "01-31-2024") is None


def test_timestamps(spark):
    assert one(spark, C.parse_ts_multi, "invalid-timestamp") is None
    assert one(spark, C.parse_ts_multi, "2024-01-05T10:20:30Z") == dt.datetime(2024, 1, 5, 10, 20, 30)
    assert one(spark, C.parse_ts_multi, "05/01/2024 10:20") == dt.datetime(2024, 1, 5, 10, 20)


def test_codes(spark):
    assert [one(spark, C.canonical_tier, v) for v in ("gOLD", "xyz", None)] == ["Gold", "Bronze", "Bronze"]
    assert [one(spark, C.canonical_channel, v) for v in ("walk-in", "OTA", "fax", None)] == \
        ["Walk-in", "OTA", "Unknown", "Unknown"]
    assert [one(spark, C.canonical_status, v) for v in ("Out-Of-Order", "clean", None)] == \
        ["Out-of-Order", "Clean", "Unknown"]


def test_names_emails(spark):
    assert one(spark, C.clean_name, "  Ann   Lee ") == "Ann Lee"
    assert one(spark, C.clean_name, None) == "Unknown"
    assert one(spark, C.clean_email, " Bob@X.com ") == "bob@x.com"
    assert one(spark, C.clean_email, "invalid-email") is None
    assert one(spark, C.email_base, "bob+alt@x.com") == "bob@x.com"


def test_price_bounds(spark):
    got = [one(spark, lambda c: C.null_outside_range(c, 0, 10000), v, "double") for v in (0.0, 0.01, 9999.99, 10000.0)]
    assert got == [None, 0.01, 9999.99, None]


def test_folio_with_null_price(spark):
    df = spark.createDataFrame([(None, 20.0)], "p double, pos double")
    assert df.select(C.null_safe_sum("p", "pos").alias("f")).first()["f"] == 20.0


def test_alias_email_dedup_keeps_latest_then_higher_id(spark):
    rows = [(1, "Bob", "bob+alt@x.com", "Gold", "US", "2024-01-01", "2024-01-05T00:00:00Z"),
            (2, "Bob", "bob@x.com", "Gold", "US", "2024-01-01", "2024-01-03T00:00:00Z"),
            (3, "Ann", None, "Gold", "US", None, "2024-01-03T00:00:00Z"),
            (4, "Cy", None, "Gold", "US", None, "2024-01-03T00:00:00Z"),
            (5, "Di", "di@x.com", "Gold", "US", None, "2024-01-03T00:00:00Z"),
            (6, "Di", "di@x.com", "Gold", "US", None, "2024-01-03T00:00:00Z")]
    g = spark.createDataFrame(rows, "guest_id long, name string, email string, loyalty_tier string, country string, registration_date string, updated_at string")
    kept = sorted(r["guest_id"] for r in silver.latest_guests(silver.clean_guests(g)).collect())
    assert kept == [1, 3, 4, 6]


def test_overbooking_first_res_id_wins(spark):
    n = spark.createDataFrame([(1, "7", dt.date(2024, 1, 1), 9, 1, "Suite", dt.date(2024, 1, 1), dt.date(2024, 1, 2)),
                               (1, "7", dt.date(2024, 1, 1), 7, 2, "Suite", dt.date(2024, 1, 1), dt.date(2024, 1, 3))],
                              "hotel_id long, room_number string, date date, res_id long, guest_id long, room_type string, check_in_date date, check_out_date date")
    r = dedup.resolve_overbooking(n).first()
    assert r["res_id"] == 7 and r["is_overbooked"] and r["booking_count"] == 2


def test_late_pos_on_checkout_day(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 3, 9, 0), dt.date(2024, 1, 3))], "ts timestamp, co date")
    assert df.select(C.is_late_checkout("ts", "co").alias("x")).first()["x"] is True


def test_history_versions(spark):
    h = spark.createDataFrame([(1, "Bronze", dt.datetime(2024, 1, 1), 1), (1, "Silver", dt.datetime(2024, 2, 15), 2),
                               (1, "Gold", dt.datetime(2024, 4, 20), 3)],
                              "guest_id long, loyalty_tier string, updated_at timestamp, change_seq long")
    rows = sorted(silver.scd2_history(h).collect(), key=lambda r: r["version"])
    assert [r["version"] for r in rows] == [1, 2, 3]
    assert [r["is_current"] for r in rows] == [False, False, True]
    assert rows[0]["valid_to"] == rows[1]["valid_from"]


def _dim_row(spark, tier, version=1):
    return spark.createDataFrame([(f"1_{version}", 1, "Bob", "b@x", tier, "US", None, dt.datetime(2024, 1, 1), None, True, version)],
                                 "guest_sk string, guest_id long, name string, email string, loyalty_tier string, country string, registration_date date, valid_from timestamp, valid_to timestamp, is_current boolean, version long")


def _batch(spark, tier, when):
    return spark.createDataFrame([(1, "Bob", "b@x", tier, "US", None, when)],
                                 "guest_id long, name string, email string, loyalty_tier string, country string, registration_date date, updated_at timestamp")


def test_unchanged_rerun_adds_no_version(spark):
    dim = _dim_row(spark, "Bronze")
    out = scd2.scd2_apply_batch(dim, _batch(spark, "Bronze", dt.datetime(2024, 3, 1)))
    assert out.count() == 1


def test_tier_change_expires_and_inserts(spark):
    dim = _dim_row(spark, "Bronze")
    out = {r["guest_sk"]: r for r in scd2.scd2_apply_batch(dim, _batch(spark, "Gold", dt.datetime(2024, 3, 1))).collect()}
    assert set(out) == {"1_1", "1_2"}
    assert out["1_1"]["is_current"] is False and out["1_1"]["valid_to"] == dt.datetime(2024, 3, 1)
    assert out["1_2"]["is_current"] is True and out["1_2"]["loyalty_tier"] == "Gold"


def test_kpi_examples(spark):
    m = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 12000.0, 80, 65, 100.0)],
                              "date date, hotel_id long, total_room_revenue double, rooms_sold long, guests_with_ancillary_spend long, total_ancillary_revenue double")
    rooms = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 100), (dt.date(2024, 1, 2), 1, 0)],
                                  "date date, hotel_id long, total_available_rooms long")
    rev = {r["date"]: r["revpar"] for r in gold.kpi_revpar(m, rooms).collect()}
    assert rev == {dt.date(2024, 1, 1): 120.0, dt.date(2024, 1, 2): 0.0}
    assert gold.kpi_adr(m).first()["adr"] == 150.0
    m2 = m.withColumn("rooms_sold", F.lit(100).cast("long"))
    assert gold.kpi_ancillary(m2).first()["attachment_rate_percentage"] == 65.0


def test_turnover_and_bounds(spark):
    co = spark.createDataFrame([(1, 1, "7", dt.date(2024, 1, 3))], "res_id long, hotel_id long, room_number string, check_out_date date") \
        .withColumn("checkout_timestamp", C.at_time_of_day("check_out_date"))
    logs = spark.createDataFrame([(1, "7", dt.datetime(2024, 1, 3, 11, 0)), (1, "7", dt.datetime(2024, 1, 3, 13, 30)),
                                  (1, "7", dt.datetime(2024, 1, 3, 21, 0)), (1, "7", dt.datetime(2024, 1, 3, 21, 1))],
                                 "hotel_id long, room_number string, timestamp timestamp")
    mins = sorted(r["turnover_time_minutes"] for r in gold.turnover_pairs(co, logs).collect())
    assert mins == [150.0, 600.0]


def test_weekend_flag(spark):
    got = [one(spark, C.is_weekend, d, "date") for d in (dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8))]
    assert got == [True, True, False]


def test_safe_ratio_zero_denominator(spark):
    df = spark.createDataFrame([(5.0, 0)], "n double, d long")
    assert df.select(C.safe_ratio("n", "d").alias("x")).first()["x"] == 0.0
