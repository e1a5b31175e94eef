"""Declared schemas of the raw (bronze) JSON entities: dates and timestamps
arrive as text and are parsed by the cleaning step."""

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


GUESTS = _schema(("guest_id", _L), ("name", _S), ("email", _S), ("loyalty_tier", _S), ("country", _S),
                 ("registration_date", _S), ("updated_at", _S))
INVENTORY = _schema(("hotel_id", _L), ("room_number", _S), ("room_type", _S), ("floor", _L),
                    ("is_smoking", _B), ("last_renovated", _S), ("max_occupancy", _L))
RESERVATIONS = _schema(("res_id", _L), ("guest_id", _L), ("hotel_id", _L), ("room_number", _S), ("room_type", _S),
                       ("check_in_date", _S), ("check_out_date", _S), ("total_price", _D),
                       ("booking_channel", _S), ("created_at", _S))
POS = _schema(("txn_id", _L), ("res_id", _L), ("item_name", _S), ("category", _S), ("amount", _D),
              ("timestamp", _S))
HOUSEKEEPING = _schema(("log_id", _L), ("hotel_id", _L), ("room_number", _S), ("staff_id", _L), ("status", _S),
                       ("timestamp", _S))

BY_ENTITY = {"guests": GUESTS, "hotel_inventory": INVENTORY, "reservations": RESERVATIONS,
             "pos_transactions": POS, "housekeeping_logs": HOUSEKEEPING}
GUEST_CHANGES = _schema(("guest_id", _L), ("loyalty_tier", _S), ("updated_at", T.TimestampNTZType()),
                        ("change_seq", _L))
