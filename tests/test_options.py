"""Options D02 (content_key) and D06 (processing_time) on small rows."""
import datetime as dt

from pyspark.sql import functions as F
from test_functions import _batch, _dim_row

from hostelry.operators import scd2
from hostelry.plans import silver


def test_copies_under_new_ids_go(spark):
    stay = (1, 2, "7", "Suite", "2024-01-01", "2024-01-03", 100.0, "OTA", "2024-01-01 00:00:00")
    other = (*stay[:6], None, *stay[7:])  # no price: a content of its own
    res = spark.createDataFrame([(5, *stay), (4, *stay), (4, *stay), (9, *other), (8, *other)],
                                "res_id long, guest_id long, hotel_id long, room_number string, room_type string, check_in_date string, "
                                "check_out_date string, total_price double, booking_channel string, created_at string")
    assert sorted(r.res_id for r in silver.clean_reservations(res).collect()) == [4, 5, 8, 9]
    assert sorted(r.res_id for r in silver.clean_reservations(res, silver.RESERVATION_CONTENT).collect()) == [4, 8]
    charge = ("tea", "Food", 3.0, "2024-01-01 10:00:00")
    pos = spark.createDataFrame([(2, 7, *charge), (1, 7, *charge), (3, None, *charge), (4, None, *charge), (5, 8, *charge)],
                                "txn_id long, res_id long, item_name string, category string, amount double, timestamp string")
    assert silver.clean_pos(pos).count() == 5
    assert sorted(r.txn_id for r in silver.clean_pos(pos, silver.POS_CONTENT).collect()) == [1, 3, 5]


def test_expired_rows_end_at_processing_time(spark):
    at, when = dt.datetime(2024, 5, 5, 6), dt.datetime(2024, 3, 1)
    out = {r["guest_sk"]: r for r in scd2.scd2_apply_batch(_dim_row(spark, "Bronze"), _batch(spark, "Gold", when), processing_time=F.lit(at)).collect()}
    assert out["1_1"]["valid_to"] == at and not out["1_1"]["is_current"]
    assert out["1_2"]["valid_from"] == when and out["1_2"]["valid_to"] is None and out["1_2"]["is_current"]
