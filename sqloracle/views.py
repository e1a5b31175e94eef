"""DuckDB SQL for the hotel-shaped bronze views (independent of the Spark code).

Each entry is a CTE body over the driver tables that DuckDB has registered as
views. ``with_views(names, body)`` prefixes a query with the CTEs it needs.
"""

from __future__ import annotations

ISO_TS = "'%Y-%m-%dT%H:%M:%SZ'"


def _dt(d: str, sel: str, rules: list[tuple[int, str]], default: str) -> str:
    arms = " ".join(f"WHEN {sel} = {v} THEN strftime({d}, '{f}')" for v, f in rules)
    return f"CASE {arms} ELSE strftime({d}, '{default}') END"


_GUESTS = f"""
SELECT c_custkey AS guest_id,
  CASE WHEN c_custkey % 40 = 1 THEN NULL
       WHEN c_custkey % 60 = 33 THEN c_name || ' Junior'
       WHEN c_custkey % 60 = 34 THEN c_name || ' Jr.'
       WHEN c_custkey % 10 = 3 THEN '  ' || c_name || '   '
       WHEN c_custkey % 10 = 7 THEN replace(c_name, '#', '   #')
       WHEN c_custkey % 10 = 9 THEN lower(c_name)
       ELSE c_name END AS name,
  CASE WHEN c_custkey % 25 = 0 THEN NULL
       WHEN c_custkey % 30 = 0 THEN 'invalid-email'
       WHEN c_custkey % 20 = 0 THEN 'guest' || CAST(c_custkey - 1 AS VARCHAR) || '+alt@inn.example'
       WHEN c_custkey % 45 = 44 THEN 'guest' || CAST(c_custkey - 1 AS VARCHAR) || '@inn.example'
       WHEN c_custkey % 60 BETWEEN 32 AND 34 THEN 'guest' || CAST(c_custkey - c_custkey % 60 + 31 AS VARCHAR) || '@inn.example'
       WHEN c_custkey % 9 = 0 THEN ' ' || upper('guest' || CAST(c_custkey AS VARCHAR) || '@inn.example') || ' '
       ELSE 'guest' || CAST(c_custkey AS VARCHAR) || '@inn.example' END AS email,
  CASE WHEN c_custkey % 8 = 0 THEN NULL
       WHEN c_mktsegment = 'AUTOMOBILE' THEN 'gold'
       WHEN c_mktsegment = 'BUILDING' THEN 'SILVER'
       WHEN c_mktsegment = 'FURNITURE' THEN 'Bronze'
       WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Platinum'
       ELSE 'diamond' END AS loyalty_tier,
  CASE WHEN c_custkey % 20 = 5 THEN NULL
       WHEN c_custkey % 2 = 0 THEN ' n' || CAST(c_nationkey AS VARCHAR) || ' '
       ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS country,
  CASE WHEN c_custkey % 12 = 11 THEN NULL ELSE
    {_dt("(DATE '2018-01-01' + CAST(c_custkey * 53 % 2000 AS INTEGER))", "c_custkey % 10",
         [(6, "%d/%m/%Y"), (7, "%d/%m/%Y"), (8, "%m/%d/%Y")], "%Y-%m-%d")} END AS registration_date,
  CASE WHEN c_custkey % 11 = 10 THEN 'invalid-timestamp'
       WHEN c_custkey % 10 = 7 THEN strftime(TIMESTAMP '2023-01-01 00:00:00' + to_seconds(c_custkey * 7919 % 31536000), '%d/%m/%Y %H:%M')
       WHEN c_custkey % 10 = 8 THEN strftime(TIMESTAMP '2023-01-01 00:00:00' + to_seconds(c_custkey * 7919 % 31536000), '%Y-%m-%d %H:%M:%S')
       ELSE strftime(TIMESTAMP '2023-01-01 00:00:00' + to_seconds(c_custkey * 7919 % 31536000), {ISO_TS}) END AS updated_at
FROM customer
"""

_CHANGES = """
SELECT o_custkey AS guest_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Platinum' WHEN '2-HIGH' THEN 'Gold'
       WHEN '3-MEDIUM' THEN 'Silver' ELSE 'Bronze' END AS loyalty_tier,
  o_orderdate + INTERVAL 28 YEAR AS updated_at, o_orderkey AS change_seq
FROM orders
"""

_INVENTORY = """
SELECT CASE WHEN p_partkey % 83 = 5 THEN NULL ELSE p_partkey % 5 + 1 END AS hotel_id,
  CASE WHEN p_partkey % 97 = 13 THEN '9999' WHEN p_partkey % 89 = 7 THEN NULL
       ELSE CAST(p_partkey // 5 AS VARCHAR) END AS room_number,
  CASE p_type WHEN 'LARGE' THEN 'suite' WHEN 'PROMO' THEN 'Deluxe' WHEN 'SMALL' THEN 'STANDARD'
       WHEN 'MEDIUM' THEN 'deluxe' WHEN 'STANDARD' THEN 'Presidential' ELSE p_type END AS room_type,
  CAST(p_size % 10 + 1 AS BIGINT) AS floor,
  p_size % 3 = 0 AS is_smoking,
  strftime(DATE '2015-01-01' + CAST(p_partkey * 7 % 3000 AS INTEGER), '%Y-%m-%d') AS last_renovated,
  CAST(p_size % 4 + 1 AS BIGINT) AS max_occupancy
FROM part
"""

# Reservation building blocks: check-in day, nights, price, created_at.
_RES_BASE = """
SELECT o_orderkey AS k, o_custkey, o_orderpriority,
  DATE '2024-01-01' + CAST(o_orderkey * 37 % 366 AS INTEGER) AS ci,
  CAST(o_orderkey % 7 + 1 AS INTEGER) AS n,
  (CAST(floor(o_totalprice) AS BIGINT) // 40) // 420 * 420 AS price
FROM orders
"""

_CHANNEL = """CASE WHEN k % 11 = 6 THEN 'fax' WHEN k % 9 = 4 THEN 'walk in desk'
       WHEN o_orderpriority = '1-URGENT' THEN 'website' WHEN o_orderpriority = '2-HIGH' THEN 'PHONE'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'ota' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Walk-In'
       ELSE NULL END"""
_ROOM_TYPE = """CASE (k // 3) % 6 WHEN 0 THEN 'standard' WHEN 1 THEN 'DELUXE' WHEN 2 THEN 'Suite'
       WHEN 3 THEN 'presidential' WHEN 4 THEN NULL ELSE 'Penthouse' END"""
_ROOM = """CASE WHEN k % 20 = 3 THEN '9999' WHEN k % 13 = 5 THEN NULL
       WHEN k % 4 = 0 THEN CAST(40 + o_custkey // 5 AS VARCHAR) ELSE CAST((k // 5) % 40 AS VARCHAR) END"""
_HOTEL = "(CASE WHEN k % 211 = 17 THEN 900 + k % 5 ELSE k % 5 + 1 END)"
_CREATED = "(CAST(ci - CAST(k % 60 AS INTEGER) AS TIMESTAMP) + to_seconds(k * 13 % 86400))"
_CO = "(CASE WHEN k % 31 = 4 THEN ci WHEN k % 37 = 6 THEN ci - 2 ELSE ci + n END)"

_RES_ROWS = f"""
SELECT k AS res_id,
  CASE WHEN k % 20 = 7 THEN o_custkey + 1000000 ELSE o_custkey END AS guest_id,
  {_HOTEL} AS hotel_id, {_ROOM} AS room_number, {_ROOM_TYPE} AS room_type,
  CASE WHEN k % 17 = 2 THEN NULL WHEN k % 41 = 40 THEN 'TBD' ELSE
    {_dt("ci", "k % 10", [(6, "%d/%m/%Y"), (7, "%d/%m/%Y"), (8, "%m/%d/%Y")], "%Y-%m-%d")} END AS check_in_date,
  CASE WHEN k % 23 = 8 THEN NULL ELSE
    {_dt(_CO, "(k // 10) % 10", [(6, "%d/%m/%Y"), (7, "%m-%d-%Y"), (8, "%m/%d/%Y")], "%Y-%m-%d")} END AS check_out_date,
  CASE WHEN k % 19 = 3 THEN NULL WHEN k % 50 = 11 THEN -CAST(price AS DOUBLE)
       ELSE CAST(price AS DOUBLE) END AS total_price,
  {_CHANNEL} AS booking_channel,
  CASE WHEN k % 8 = 7 THEN 'invalid-timestamp'
       WHEN k % 8 = 5 THEN strftime({_CREATED}, '%d/%m/%Y %H:%M')
       WHEN k % 8 = 6 THEN strftime({_CREATED}, '%Y-%m-%d %H:%M:%S')
       ELSE strftime({_CREATED}, {ISO_TS}) END AS created_at
FROM res_base
"""

_RESENT = f"""
SELECT k AS res_id, o_custkey AS guest_id, {_HOTEL} AS hotel_id, {_ROOM} AS room_number,
  {_ROOM_TYPE} AS room_type, strftime(ci, '%Y-%m-%d') AS check_in_date,
  strftime(ci + n, '%Y-%m-%d') AS check_out_date, CAST(price AS DOUBLE) AS total_price,
  {_CHANNEL} AS booking_channel,
  strftime({_CREATED} + INTERVAL 1 DAY, {ISO_TS}) AS created_at
FROM res_base WHERE k % 25 = 0
"""

_COPIES = f"""
SELECT res_id + 1000000000000 AS res_id, guest_id, hotel_id, room_number, room_type, check_in_date,
  check_out_date, total_price, booking_channel, created_at
FROM ({_RES_ROWS}) WHERE res_id % 101 = 0
"""

_RESERVATIONS = f"{_RES_ROWS} UNION ALL {_RESENT} UNION ALL {_COPIES}"

_POS_TS = ("(CAST(DATE '2024-01-01' + CAST(l_orderkey * 37 % 366 + (l_linenumber * 3 + l_partkey) "
           "% (l_orderkey % 7 + 2) AS INTEGER) AS TIMESTAMP) + to_seconds((l_partkey % 24) * 3600 "
           "+ (l_suppkey % 60) * 60))")

_POS_ROWS = f"""
SELECT l_orderkey * 10 + l_linenumber AS txn_id,
  CASE WHEN (l_orderkey + l_linenumber) % 7 = 0 THEN NULL
       WHEN (l_orderkey * 10 + l_linenumber) % 23 = 5 THEN l_orderkey + 2000000000000
       ELSE l_orderkey END AS res_id,
  'item-' || CAST(l_partkey AS VARCHAR) AS item_name,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 4 THEN 'Service'
       WHEN l_linenumber = 5 THEN 'minibar' WHEN l_returnflag = 'A' THEN 'food'
       WHEN l_returnflag = 'N' THEN 'DRINK' ELSE 'Spa' END AS category,
  CASE WHEN (l_orderkey * 10 + l_linenumber) % 13 = 1 THEN NULL
       WHEN (l_orderkey * 10 + l_linenumber) % 29 = 2 THEN -CAST(CAST(floor(l_extendedprice) AS BIGINT) // 10 AS DOUBLE)
       ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) // 10 AS DOUBLE) END AS amount,
  CASE WHEN (l_orderkey * 10 + l_linenumber) % 9 = 8 THEN 'invalid-timestamp'
       WHEN (l_orderkey * 10 + l_linenumber) % 9 = 7 THEN strftime({_POS_TS}, '%d/%m/%Y %H:%M')
       WHEN (l_orderkey * 10 + l_linenumber) % 9 = 6 THEN strftime({_POS_TS}, '%Y-%m-%d %H:%M:%S')
       ELSE strftime({_POS_TS}, {ISO_TS}) END AS timestamp
FROM lineitem
"""

_POS = f"""
SELECT * FROM ({_POS_ROWS})
UNION ALL
SELECT txn_id + 1000000000000000 AS txn_id, res_id, item_name, category, amount, timestamp
FROM ({_POS_ROWS}) WHERE txn_id % 53 = 0
"""

_HOUSEKEEPING = f"""
SELECT event_id AS log_id, user_id % 5 + 1 AS hotel_id, CAST((user_id // 5) % 40 AS VARCHAR) AS room_number,
  user_id % 17 AS staff_id,
  CASE WHEN event_id % 12 = 0 THEN NULL WHEN event_type = 'view' THEN 'clean'
       WHEN event_type = 'click' THEN 'CLEAN' WHEN event_type = 'purchase' THEN 'Dirty'
       WHEN event_type = 'signup' THEN 'maintenance' ELSE 'Out-Of-Order' END AS status,
  CASE WHEN event_id % 10 = 9 THEN 'invalid-timestamp'
       WHEN event_id % 10 = 7 THEN strftime(ts, '%d/%m/%Y %H:%M')
       WHEN event_id % 10 = 8 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
       ELSE strftime(ts, {ISO_TS}) END AS timestamp
FROM events
"""

VIEWS: dict[str, str] = {
    "bronze_guests": _GUESTS,
    "guest_change_log": _CHANGES,
    "bronze_inventory": _INVENTORY,
    "res_base": _RES_BASE,
    "bronze_reservations": _RESERVATIONS,
    "reservations_first": f"{_RES_ROWS} UNION ALL {_COPIES}",
    "reservations_resent": _RESENT,
    "bronze_pos": _POS,
    "bronze_housekeeping": _HOUSEKEEPING,
}

_DEPENDS = {n: ["res_base"] for n in ("bronze_reservations", "reservations_first", "reservations_resent")}


def with_views(body: str, *ctes: tuple[str, str]) -> str:
    """Prefix ``body`` with the bronze views it mentions plus extra named CTEs."""
    names: list[str] = []
    text = body + " ".join(sql for _, sql in ctes)
    for name in VIEWS:
        if name in text:
            for dep in _DEPENDS.get(name, []):
                if dep not in names:
                    names.append(dep)
            if name not in names:
                names.append(name)
    parts = [f"{n} AS ({VIEWS[n]})" for n in names]
    parts += [f"{n} AS ({sql})" for n, sql in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
