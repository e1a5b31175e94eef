"""DuckDB oracle SQL, one statement per Spark query name.

Written from the operator semantics, independently of the Spark code: the
silver steps use windows and range joins the way a SQL analyst would, so a
Spark rewrite (aggregate instead of window, equi-keyed interval join, one-pass
KPI measures) is checked against the direct formulation.

Rounding: Spark rounds half-up on the shortest decimal form of a double,
DuckDB on the binary value; for the non-negative values here ``x + 1e-9``
makes them agree.
"""

from __future__ import annotations

from .views import VIEWS as BRONZE

TS = "'%Y-%m-%dT%H:%M:%SZ'"


def ts_multi(c: str) -> str:
    return (f"coalesce(try_strptime({c}, {TS}), try_strptime({c}, '%d/%m/%Y %H:%M'), "
            f"try_strptime({c}, '%Y-%m-%d %H:%M:%S'))")


def date_multi(c: str, fmts=("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y")) -> str:
    return "CAST(coalesce(" + ", ".join(f"try_strptime({c}, '{f}')" for f in fmts) + ") AS DATE)"


def canon(c: str, labels, default: str, contains=()) -> str:
    arms = " ".join(f"WHEN upper({c}) = '{lab.upper()}' THEN '{lab}'" for lab in labels)
    arms += " " + " ".join(f"WHEN upper({c}) LIKE '%{sub}%' THEN '{lab}'" for sub, lab in contains)
    return f"CASE {arms} ELSE '{default}' END"


def r2(x: str) -> str:
    return f"round(({x}) + 1e-9, 2)"


NIGHTS = ("CAST(unnest(generate_series(CAST(check_in_date AS TIMESTAMP), "
          "CAST(check_out_date - 1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)")

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


cte("guests_clean", f"""
SELECT *, coalesce(email_base, 'guest_' || CAST(guest_id AS VARCHAR)) AS dedup_key FROM (
 SELECT *, regexp_replace(email, '\\+.*@', '@') AS email_base FROM (
  SELECT guest_id,
   coalesce(regexp_replace(trim(name), '\\s+', ' ', 'g'), 'Unknown') AS name,
   CASE WHEN email <> 'invalid-email' THEN lower(trim(email)) END AS email,
   {canon('loyalty_tier', ['Bronze', 'Silver', 'Gold', 'Platinum'], 'Bronze')} AS loyalty_tier,
   coalesce(upper(trim(country)), 'UNKNOWN') AS country,
   {date_multi('registration_date')} AS registration_date,
   {ts_multi('updated_at')} AS updated_at
  FROM bronze_guests WHERE guest_id IS NOT NULL))
""")

cte("guests_latest", """
SELECT guest_id, name, email, loyalty_tier, country, registration_date, updated_at FROM (
 SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY updated_at DESC NULLS LAST, guest_id DESC) AS rn
 FROM guests_clean) WHERE rn = 1 AND updated_at IS NOT NULL
""")

cte("dim_guests", """
SELECT CAST(guest_id AS VARCHAR) || '_' || CAST(version AS VARCHAR) AS guest_sk, guest_id, name, email,
  loyalty_tier, country, registration_date, updated_at AS valid_from, valid_to, valid_to IS NULL AS is_current,
  version
FROM (SELECT *, CAST(sum(chg) OVER (PARTITION BY guest_id ORDER BY updated_at, guest_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1 AS BIGINT) AS version,
             lead(updated_at) OVER (PARTITION BY guest_id ORDER BY updated_at, guest_id) AS valid_to
      FROM (SELECT *, CASE WHEN lag(loyalty_tier) OVER (PARTITION BY guest_id ORDER BY updated_at, guest_id)
                             <> loyalty_tier THEN 1 ELSE 0 END AS chg
            FROM guests_latest))
""")

cte("scd2_hist", """
SELECT CAST(guest_id AS VARCHAR) || '_' || CAST(version AS VARCHAR) AS guest_sk, guest_id, loyalty_tier,
  updated_at AS valid_from, valid_to, valid_to IS NULL AS is_current, version
FROM (SELECT *, CAST(sum(chg) OVER (PARTITION BY guest_id ORDER BY updated_at, change_seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1 AS BIGINT) AS version,
             lead(updated_at) OVER (PARTITION BY guest_id ORDER BY updated_at, change_seq) AS valid_to
      FROM (SELECT *, CASE WHEN lag(loyalty_tier) OVER (PARTITION BY guest_id ORDER BY updated_at, change_seq)
                             <> loyalty_tier THEN 1 ELSE 0 END AS chg
            FROM guest_change_log))
""")

cte("scd2_hist_collapsed", """
SELECT CAST(guest_id AS VARCHAR) || '_' || CAST(version AS VARCHAR) AS guest_sk, guest_id, loyalty_tier,
  updated_at AS valid_from, valid_to, valid_to IS NULL AS is_current, version
FROM (SELECT *, row_number() OVER (PARTITION BY guest_id ORDER BY updated_at, change_seq) AS version,
             lead(updated_at) OVER (PARTITION BY guest_id ORDER BY updated_at, change_seq) AS valid_to
      FROM (SELECT *, lag(loyalty_tier) OVER (PARTITION BY guest_id ORDER BY updated_at, change_seq) AS prev,
                   row_number() OVER (PARTITION BY guest_id ORDER BY updated_at, change_seq) AS rn0
            FROM guest_change_log)
      WHERE rn0 = 1 OR prev <> loyalty_tier)
""")

cte("res_parsed", f"""
SELECT res_id, guest_id, hotel_id, room_number,
  {canon('room_type', ['Standard', 'Deluxe', 'Suite', 'Presidential'], 'Standard')} AS room_type,
  {date_multi('check_in_date')} AS check_in_date,
  {date_multi('check_out_date', ('%Y-%m-%d', '%d/%m/%Y', '%m-%d-%Y', '%m/%d/%Y'))} AS check_out_date,
  CASE WHEN total_price > 0 AND total_price < 10000 THEN total_price END AS total_price,
  {canon('booking_channel', ['Website', 'Phone', 'OTA'], 'Unknown', [('WALK', 'Walk-in')])} AS booking_channel,
  {ts_multi('created_at')} AS created_at
FROM bronze_reservations WHERE res_id IS NOT NULL
""")

cte("res_clean", """
SELECT * EXCLUDE (rn) FROM (
 SELECT *, row_number() OVER (PARTITION BY res_id ORDER BY created_at DESC NULLS LAST,
        total_price DESC NULLS LAST, check_in_date DESC, check_out_date DESC) AS rn
 FROM res_parsed
 WHERE check_in_date IS NOT NULL AND check_out_date IS NOT NULL AND check_out_date > check_in_date)
WHERE rn = 1
""")

cte("pos_clean", f"""
SELECT * FROM (
 SELECT txn_id, res_id, item_name,
   {canon('category', ['Food', 'Drink', 'Service', 'Spa'], 'Other')} AS category,
   CASE WHEN amount > 0 AND amount < 5000 THEN amount END AS amount,
   {ts_multi('"timestamp"')} AS "timestamp"
 FROM bronze_pos WHERE txn_id IS NOT NULL)
WHERE amount IS NOT NULL AND "timestamp" IS NOT NULL
""")

cte("pos_agg", """
SELECT res_id, sum(amount) AS total_pos_amount, CAST(count(*) AS BIGINT) AS pos_item_count
FROM pos_clean WHERE res_id IS NOT NULL GROUP BY res_id
""")

cte("stays_all", """
SELECT r.res_id, r.guest_id, r.hotel_id, r.room_type, r.check_in_date, r.check_out_date,
  CAST(date_diff('day', r.check_in_date, r.check_out_date) AS INTEGER) AS stay_length_nights,
  r.total_price, r.booking_channel, coalesce(p.total_pos_amount, 0.0) AS total_pos_amount,
  CASE WHEN r.total_price IS NOT NULL THEN r.total_price + coalesce(p.total_pos_amount, 0.0)
       ELSE coalesce(p.total_pos_amount, 0.0) END AS total_folio_amount,
  coalesce(p.pos_item_count, 0) AS pos_item_count, r.created_at
FROM res_clean r LEFT JOIN pos_agg p ON r.res_id = p.res_id
""")

cte("fact_stays", """
SELECT * FROM stays_all
WHERE guest_id IN (SELECT guest_id FROM dim_guests)
  AND hotel_id IN (SELECT hotel_id FROM bronze_inventory)
""")

cte("occupancy_nights", f"""
SELECT {NIGHTS} AS date, hotel_id, room_number, room_type, res_id, guest_id, check_in_date, check_out_date
FROM res_clean WHERE room_number IS NOT NULL
""")

cte("calendar", """
SELECT date, hotel_id, room_number, room_type, false AS is_available, res_id, guest_id, check_in_date,
  check_out_date, is_overbooked FROM (
 SELECT *, count(res_id) OVER (PARTITION BY hotel_id, room_number, date) > 1 AS is_overbooked,
        row_number() OVER (PARTITION BY hotel_id, room_number, date ORDER BY res_id) AS rn
 FROM occupancy_nights) WHERE rn = 1
""")

cte("res_raw_rooms", f"""
SELECT * EXCLUDE (rn) FROM (
 SELECT *, row_number() OVER (PARTITION BY res_id ORDER BY check_in_date, check_out_date, room_number,
        guest_id, hotel_id, room_type NULLS FIRST) AS rn FROM (
  SELECT res_id, guest_id, hotel_id, room_number, room_type,
    {date_multi('check_in_date', ('%Y-%m-%d', '%d/%m/%Y'))} AS check_in_date,
    {date_multi('check_out_date', ('%Y-%m-%d', '%d/%m/%Y'))} AS check_out_date
  FROM bronze_reservations
  WHERE res_id IS NOT NULL AND room_number IS NOT NULL AND room_number <> '9999')
 WHERE check_in_date IS NOT NULL AND check_out_date IS NOT NULL AND check_out_date > check_in_date)
WHERE rn = 1
""")

cte("calendar_raw", f"""
SELECT date, hotel_id, room_number, room_type, false AS is_available, res_id, guest_id, check_in_date,
  check_out_date, is_overbooked FROM (
 SELECT *, count(res_id) OVER (PARTITION BY hotel_id, room_number, date) > 1 AS is_overbooked,
        row_number() OVER (PARTITION BY hotel_id, room_number, date ORDER BY res_id) AS rn
 FROM (SELECT {NIGHTS} AS date, * FROM res_raw_rooms)) WHERE rn = 1
""")

cte("stay_nights", f"""
SELECT {NIGHTS} AS date, hotel_id, res_id, total_price / stay_length_nights AS daily_room_revenue,
  pos_item_count, total_pos_amount
FROM fact_stays
""")

cte("revenue_daily", """
SELECT date, hotel_id, sum(daily_room_revenue) AS total_room_revenue, count(*) AS rooms_sold
FROM stay_nights GROUP BY date, hotel_id
""")

cte("rooms_daily", """
SELECT date, hotel_id, count(DISTINCT room_number) AS total_available_rooms FROM calendar GROUP BY date, hotel_id
""")

cte("kpi_revpar", f"""
SELECT r.date, r.hotel_id, {r2('coalesce(v.total_room_revenue, 0.0)')} AS total_room_revenue,
  r.total_available_rooms,
  CASE WHEN r.total_available_rooms > 0
       THEN {r2('coalesce(v.total_room_revenue, 0.0) / r.total_available_rooms')} ELSE 0.0 END AS revpar
FROM rooms_daily r LEFT JOIN revenue_daily v ON r.date = v.date AND r.hotel_id = v.hotel_id
""")

cte("kpi_adr", f"""
SELECT date, hotel_id, {r2('total_room_revenue')} AS total_room_revenue, rooms_sold,
  CASE WHEN rooms_sold > 0 THEN {r2('total_room_revenue / rooms_sold')} ELSE 0.0 END AS adr
FROM revenue_daily
""")

cte("kpi_ancillary", f"""
SELECT date, hotel_id, total_guests, guests_with_ancillary_spend,
  CASE WHEN total_guests > 0 THEN {r2('guests_with_ancillary_spend / total_guests * 100')} ELSE 0.0 END
    AS attachment_rate_percentage,
  {r2('total_ancillary_revenue')} AS total_ancillary_revenue,
  CASE WHEN total_guests > 0 THEN {r2('total_ancillary_revenue / total_guests')} ELSE 0.0 END
    AS avg_ancillary_per_guest
FROM (SELECT date, hotel_id, count(*) AS total_guests,
        CAST(sum(CASE WHEN pos_item_count > 0 THEN 1 ELSE 0 END) AS BIGINT) AS guests_with_ancillary_spend,
        sum(total_pos_amount) AS total_ancillary_revenue
      FROM stay_nights GROUP BY date, hotel_id)
""")

cte("checkouts", """
SELECT res_id, hotel_id, room_number, check_out_date,
  CAST(check_out_date AS TIMESTAMP) + INTERVAL 11 HOUR AS checkout_timestamp
FROM (SELECT res_id, hotel_id, room_number,
        CAST(coalesce(try_strptime(check_out_date, '%Y-%m-%d'), try_strptime(check_out_date, '%d/%m/%Y')) AS DATE)
          AS check_out_date
      FROM bronze_reservations WHERE res_id IS NOT NULL AND room_number IS NOT NULL)
WHERE check_out_date IS NOT NULL
""")

cte("hk_clean", f"""
SELECT * FROM (
 SELECT hotel_id, room_number,
   {canon('status', ['Clean', 'Dirty', 'Maintenance'], 'Unknown', [('ORDER', 'Out-of-Order')])} AS status,
   {ts_multi('"timestamp"')} AS "timestamp"
 FROM bronze_housekeeping WHERE log_id IS NOT NULL)
WHERE status = 'Clean' AND "timestamp" IS NOT NULL
""")

cte("turnover", """
SELECT * FROM (
 SELECT c.res_id, c.hotel_id, c.room_number, c.check_out_date, c.checkout_timestamp, h."timestamp",
   (epoch(h."timestamp") - epoch(c.checkout_timestamp)) / 60.0 AS turnover_time_minutes,
   CAST(epoch(h."timestamp") - epoch(c.checkout_timestamp) AS BIGINT) AS turnover_seconds
 FROM checkouts c JOIN hk_clean h ON c.hotel_id = h.hotel_id AND c.room_number = h.room_number
 WHERE h."timestamp" >= c.checkout_timestamp AND h."timestamp" <= c.checkout_timestamp + INTERVAL 1 DAY)
WHERE turnover_time_minutes > 0 AND turnover_time_minutes <= 600
""")

cte("kpi_adr_for_dash", f"""
SELECT date, hotel_id, CASE WHEN rooms_sold > 0 THEN {r2('total_room_revenue / rooms_sold')} ELSE 0.0 END AS adr
FROM revenue_daily
""")


cte("kpi_turnover", f"""
SELECT check_out_date AS date, hotel_id, count(*) AS total_checkouts,
  {r2('avg(turnover_seconds) / 60.0')} AS avg_turnover_time_minutes,
  {r2('quantile_disc(turnover_time_minutes, 0.5)')} AS median_turnover_time_minutes,
  {r2('min(turnover_time_minutes)')} AS min_turnover_time_minutes,
  {r2('max(turnover_time_minutes)')} AS max_turnover_time_minutes
FROM turnover GROUP BY check_out_date, hotel_id
""")


def _resolve(names: list[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        body = CTES.get(n) or BRONZE.get(n)
        for dep in list(BRONZE) + list(CTES):
            if dep != n and dep not in order and _mentions(body, dep):
                visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return order


def _mentions(text: str, name: str) -> bool:
    import re
    return re.search(rf"\b{name}\b", text) is not None


def build(body: str) -> str:
    """Prefix ``body`` with every CTE it (transitively) mentions."""
    used = [n for n in list(BRONZE) + list(CTES) if _mentions(body, n)]
    if not used:
        return body
    names = _resolve(used)
    parts = [f"{n} AS ({CTES.get(n) or BRONZE.get(n)})" for n in names]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body


SQL: dict[str, str] = {}


def sql(name: str, body: str) -> None:
    SQL[name] = build(body)


sql("guests_cleaned", "SELECT * FROM guests_clean")
sql("guests_latest", "SELECT * FROM guests_latest")
sql("dim_guests_batch", "SELECT * FROM dim_guests")
sql("scd2_history", "SELECT * FROM scd2_hist")
sql("scd2_history_collapsed", "SELECT * FROM scd2_hist_collapsed")
sql("clean_reservations", "SELECT * FROM res_clean")
sql("clean_pos", "SELECT * FROM pos_clean")
sql("clean_inventory", f"""
SELECT hotel_id, room_number,
  {canon('room_type', ['Standard', 'Deluxe', 'Suite', 'Presidential'], 'Standard')} AS room_type,
  floor, max_occupancy
FROM bronze_inventory WHERE hotel_id IS NOT NULL AND room_number IS NOT NULL AND room_number <> '9999'
""")
sql("clean_housekeeping", "SELECT * FROM hk_clean")
sql("checkout_events", "SELECT * FROM checkouts")
sql("pos_by_reservation", "SELECT * FROM pos_agg")
sql("fact_stays_unified", "SELECT * FROM fact_stays")
sql("fact_room_availability_daily", "SELECT * FROM calendar")
sql("fact_room_availability_raw", "SELECT * FROM calendar_raw")
sql("kpi_revpar", "SELECT * FROM kpi_revpar")
sql("kpi_adr", "SELECT * FROM kpi_adr")
sql("kpi_ancillary_attachment_rate", "SELECT * FROM kpi_ancillary")
sql("kpi_housekeeping_turnover_time", "SELECT * FROM kpi_turnover")

cte("kpi_weekend", f"""
SELECT date, hotel_id, is_weekend,
  CASE WHEN rooms_sold > 0 THEN {r2('total_room_revenue / rooms_sold')} ELSE 0.0 END AS adr,
  CASE WHEN total_available_rooms > 0 THEN {r2('total_room_revenue / total_available_rooms')} ELSE 0.0 END
    AS revpar,
  CASE WHEN total_available_rooms > 0 THEN {r2('rooms_sold / total_available_rooms * 100')} ELSE 0.0 END
    AS occupancy_rate,
  rooms_sold, total_available_rooms, {r2('total_room_revenue')} AS total_room_revenue
FROM (SELECT n.date, n.hotel_id, dayofweek(n.date) IN (0, 6) AS is_weekend,
        sum(n.daily_room_revenue) AS total_room_revenue, count(*) AS rooms_sold,
        max(r.total_available_rooms) AS total_available_rooms
      FROM stay_nights n LEFT JOIN rooms_daily r ON n.date = r.date AND n.hotel_id = r.hotel_id
      GROUP BY n.date, n.hotel_id, dayofweek(n.date) IN (0, 6))
""")
sql("kpi_weekend_vs_weekday_revenue", "SELECT * FROM kpi_weekend")
sql("kpi_executive_dashboard", """
SELECT p.date, p.hotel_id, p.revpar, a.adr, c.attachment_rate_percentage, c.avg_ancillary_per_guest
FROM kpi_revpar p
LEFT JOIN kpi_adr a ON p.date = a.date AND p.hotel_id = a.hotel_id
LEFT JOIN kpi_ancillary c ON p.date = c.date AND p.hotel_id = c.hotel_id
""")
sql("ancillary_by_category", f"""
SELECT date, hotel_id, total_guests, guests_with_category_spend,
  CASE WHEN total_guests > 0 THEN {r2('guests_with_category_spend / total_guests * 100')} ELSE 0.0 END
    AS attachment_rate_percentage,
  {r2('category_revenue')} AS category_revenue
FROM (SELECT date, hotel_id, count(*) AS total_guests,
        CAST(sum(CASE WHEN cat_items > 0 THEN 1 ELSE 0 END) AS BIGINT) AS guests_with_category_spend,
        sum(coalesce(cat_amount, 0.0)) AS category_revenue
      FROM (SELECT {NIGHTS} AS date, s.hotel_id, x.cat_amount, x.cat_items
            FROM fact_stays s LEFT JOIN (
              SELECT res_id, sum(amount) AS cat_amount, count(*) AS cat_items FROM pos_clean
              WHERE res_id IS NOT NULL AND category IN ('Food', 'Drink') GROUP BY res_id) x
            ON s.res_id = x.res_id)
      GROUP BY date, hotel_id)
""")


def r2s(x: str) -> str:
    """Half-up rounding for values of either sign."""
    return f"round(({x}) + sign({x}) * 1e-9, 2)"


cte("inv_clean", f"""
SELECT hotel_id, room_number,
  {canon('room_type', ['Standard', 'Deluxe', 'Suite', 'Presidential'], 'Standard')} AS room_type,
  floor, max_occupancy
FROM bronze_inventory WHERE hotel_id IS NOT NULL AND room_number IS NOT NULL AND room_number <> '9999'
""")

cte("late_pos", """
SELECT p.txn_id, p.res_id, s.guest_id, s.check_out_date, CAST(p."timestamp" AS DATE) AS pos_date, p."timestamp",
  p.category, p.amount, CAST(p."timestamp" AS DATE) >= s.check_out_date AS is_late_checkout
FROM pos_clean p JOIN fact_stays s ON p.res_id = s.res_id
""")

cte("guest_survivors", """
SELECT dedup_key, guest_id AS survivor_guest_id, name AS survivor_name FROM (
 SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY updated_at DESC NULLS LAST, guest_id DESC) AS rn
 FROM guests_clean) WHERE rn = 1
""")

cte("orphans", """
SELECT res_id, guest_id, hotel_id, 'guest' AS orphan_reason FROM stays_all s
WHERE NOT EXISTS (SELECT 1 FROM dim_guests d WHERE d.guest_id = s.guest_id)
UNION ALL
SELECT res_id, guest_id, hotel_id, 'hotel' AS orphan_reason FROM stays_all s
WHERE NOT EXISTS (SELECT 1 FROM bronze_inventory i WHERE i.hotel_id = s.hotel_id)
""")

sql("late_checkout_pos", "SELECT * FROM late_pos")
sql("late_checkout_analysis", f"""
SELECT count(*) AS total_pos_with_res, count(*) FILTER (WHERE is_late_checkout) AS late_checkout_count,
  CASE WHEN count(*) > 0 THEN {r2('count(*) FILTER (WHERE is_late_checkout) / count(*) * 100')} ELSE 0.0 END
    AS late_checkout_pct
FROM late_pos
""")
sql("late_pos_linked", """
SELECT txn_id, res_id, guest_id, pos_date, linked_res_id,
  CASE WHEN linked_res_id = res_id THEN 'same_stay' ELSE 'later_stay' END AS link_status
FROM (SELECT l.txn_id, l.res_id, l.guest_id, l.pos_date,
        (SELECT s.res_id FROM fact_stays s WHERE s.guest_id = l.guest_id AND s.check_in_date <= l.pos_date
         ORDER BY s.check_in_date DESC, s.res_id DESC LIMIT 1) AS linked_res_id
      FROM late_pos l WHERE l.is_late_checkout)
""")
sql("weekend_pricing_analysis", """
SELECT dayofweek(check_in_date) IN (0, 6) AS is_weekend, count(*) AS reservation_count,
  avg(total_price) AS avg_price, min(total_price) AS min_price, max(total_price) AS max_price
FROM fact_stays GROUP BY 1
""")
sql("weekend_premium", f"""
SELECT weekend_avg_price, weekday_avg_price, {r2s('(weekend_avg_price / weekday_avg_price - 1) * 100')} AS premium_pct,
  abs((weekend_avg_price / weekday_avg_price - 1) * 100 - 100) < 10 AS premium_validated
FROM (SELECT avg(CASE WHEN dayofweek(check_in_date) IN (0, 6) THEN total_price END) AS weekend_avg_price,
             avg(CASE WHEN dayofweek(check_in_date) NOT IN (0, 6) THEN total_price END) AS weekday_avg_price
      FROM fact_stays)
""")
sql("fuzzy_guest_match", """
SELECT g.guest_id, s.survivor_guest_id, g.dedup_key, g.name, s.survivor_name,
  CAST(levenshtein(lower(g.name), lower(s.survivor_name)) AS INTEGER) AS name_distance,
  levenshtein(lower(g.name), lower(s.survivor_name)) * 10 <= greatest(length(g.name), length(s.survivor_name)) * 3
    AS is_same_person
FROM guests_clean g JOIN guest_survivors s ON g.dedup_key = s.dedup_key
WHERE g.guest_id <> s.survivor_guest_id
""")
sql("fuzzy_name_links", """
SELECT DISTINCT a.dedup_key, least(a.name, b.name) AS name, greatest(a.name, b.name) AS other_name,
  CAST(levenshtein(lower(a.name), lower(b.name)) AS INTEGER) AS name_distance
FROM guests_clean a JOIN guests_clean b ON a.dedup_key = b.dedup_key AND a.guest_id < b.guest_id
WHERE levenshtein(lower(a.name), lower(b.name)) * 10 <= greatest(length(a.name), length(b.name)) * 3
""")
sql("fuzzy_name_members", """
SELECT DISTINCT g.dedup_key, g.name, g.guest_id FROM guests_clean g
WHERE EXISTS (SELECT 1 FROM guests_clean o WHERE o.dedup_key = g.dedup_key AND o.guest_id <> g.guest_id)
""")
sql("stays_summary", f"""
SELECT count(*) AS total_stays, count(*) FILTER (WHERE pos_item_count > 0) AS stays_with_pos,
  count(*) FILTER (WHERE pos_item_count = 0) AS stays_without_pos, avg(total_price) AS avg_room_price,
  avg(stay_length_nights) AS avg_stay_nights, avg(total_pos_amount) AS avg_pos_amount,
  avg(total_folio_amount) AS avg_folio_amount,
  CASE WHEN count(*) > 0 THEN {r2('count(*) FILTER (WHERE pos_item_count > 0) / count(*) * 100')} ELSE 0.0 END
    AS pos_share_pct
FROM fact_stays
""")
sql("tier_distribution", "SELECT loyalty_tier, count(*) AS n FROM dim_guests WHERE is_current GROUP BY 1")
sql("channel_distribution", "SELECT booking_channel, count(*) AS n FROM fact_stays GROUP BY 1")
sql("room_type_distribution", "SELECT room_type, count(*) AS n FROM calendar GROUP BY 1")
sql("distinct_counts", """
SELECT 'distinct_guests' AS metric, count(DISTINCT guest_id) AS value FROM fact_stays
UNION ALL SELECT 'distinct_hotels', count(DISTINCT hotel_id) FROM fact_stays
UNION ALL SELECT 'stays', count(*) FROM fact_stays
UNION ALL SELECT 'booked_room_nights', count(*) FROM calendar
UNION ALL SELECT 'overbooked_room_nights', count(*) FILTER (WHERE is_overbooked) FROM calendar
""")
sql("stay_date_range", """
SELECT min(check_in_date) AS first_check_in, max(check_in_date) AS last_check_in,
  min(check_out_date) AS first_check_out, max(check_out_date) AS last_check_out FROM fact_stays
""")


def dec_avg(col: str, digits: int = 2) -> str:
    return f"round(avg(CAST({col} AS DECIMAL(18,2))) + 1e-9, {digits})"


sql("kpi_averages", f"""
SELECT 'avg_revpar' AS metric, {dec_avg('revpar')} AS value FROM kpi_revpar
UNION ALL SELECT 'avg_adr', {dec_avg('adr')} FROM kpi_adr
UNION ALL SELECT 'avg_attachment_rate', {dec_avg('attachment_rate_percentage')} FROM kpi_ancillary
UNION ALL SELECT 'avg_ancillary_per_guest', {dec_avg('avg_ancillary_per_guest')} FROM kpi_ancillary
UNION ALL SELECT 'avg_turnover_minutes', {dec_avg('avg_turnover_time_minutes')} FROM kpi_turnover
""")
sql("guests_multi_version", """
SELECT * FROM scd2_hist WHERE guest_id IN (SELECT guest_id FROM scd2_hist GROUP BY guest_id HAVING count(*) > 1)
""")
sql("top_revpar_days", "SELECT * FROM kpi_revpar ORDER BY revpar DESC, date, hotel_id LIMIT 10")
sql("reservations_one_per_content", """
SELECT * FROM res_clean WHERE res_id IN (SELECT min(res_id) FROM res_clean GROUP BY guest_id, hotel_id, room_number,
  room_type, check_in_date, check_out_date, total_price, booking_channel)
""")
sql("pos_one_per_content", """
SELECT * FROM pos_clean WHERE txn_id IN (SELECT min(txn_id) FROM pos_clean
  GROUP BY res_id, item_name, category, amount, "timestamp")
""")
sql("reservations_one_per_id", """
SELECT DISTINCT res_id, hotel_id, guest_id FROM res_parsed
WHERE check_in_date IS NOT NULL AND check_out_date IS NOT NULL AND check_out_date > check_in_date
""")
sql("availability_calendar", """
SELECT CAST(t.d AS DATE) AS date, i.hotel_id, i.room_number, i.room_type, c.res_id IS NULL AS is_available,
  c.res_id, c.guest_id, coalesce(c.is_overbooked, false) AS is_overbooked
FROM inv_clean i CROSS JOIN generate_series((SELECT CAST(min(date) AS TIMESTAMP) FROM calendar),
  (SELECT CAST(max(date) AS TIMESTAMP) FROM calendar), INTERVAL 1 DAY) t(d)
LEFT JOIN calendar c ON c.hotel_id = i.hotel_id AND c.room_number = i.room_number AND c.date = CAST(t.d AS DATE)
""")
sql("orphan_stays", "SELECT * FROM orphans")
sql("stays_with_known_room", """
SELECT * FROM res_clean r WHERE room_number IS NOT NULL
  AND EXISTS (SELECT 1 FROM inv_clean i WHERE i.hotel_id = r.hotel_id AND i.room_number = r.room_number)
""")
sql("stays_with_tier_asof", """
SELECT s.res_id, s.guest_id, s.check_in_date, h.loyalty_tier AS tier_at_check_in, h.version AS version_at_check_in
FROM fact_stays s LEFT JOIN scd2_hist h ON h.guest_id = s.guest_id
  AND h.valid_from <= CAST(s.check_in_date AS TIMESTAMP)
  AND (h.valid_to IS NULL OR CAST(s.check_in_date AS TIMESTAMP) < h.valid_to)
""")


def _step(entity: str, read: str, kept: str) -> str:
    return (f"SELECT '{entity}' AS entity, r AS records_read, k AS records_kept, r - k AS records_dropped "
            f"FROM (SELECT (SELECT count(*) FROM {read}) AS r, (SELECT count(*) FROM {kept}) AS k)")


sql("dq_step_counts", " UNION ALL ".join([
    _step("guests", "bronze_guests", "guests_latest"),
    _step("reservations", "bronze_reservations", "res_clean"),
    _step("pos_transactions", "bronze_pos", "pos_clean"),
    _step("hotel_inventory", "bronze_inventory", "inv_clean"),
    _step("housekeeping_logs", "bronze_housekeeping", "hk_clean"),
    _step("fact_stays_unified", "res_clean", "fact_stays")]))
sql("dq_duplicate_reservations", """
SELECT 'rows_before_dedup' AS metric, count(*) AS value FROM res_parsed
  WHERE check_in_date IS NOT NULL AND check_out_date IS NOT NULL AND check_out_date > check_in_date
UNION ALL SELECT 'rows_after_dedup', count(*) FROM res_clean
UNION ALL SELECT 'content_duplicates', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (
  SELECT count(*) AS n FROM res_clean GROUP BY guest_id, hotel_id, room_number, room_type, check_in_date,
    check_out_date, total_price, booking_channel)
""")
sql("dq_overbooked_slots", """
SELECT count(*) FILTER (WHERE is_overbooked) AS overbooked_slots, count(*) AS booked_slots FROM calendar
""")
sql("dq_null_critical", "SELECT count(*) AS rows, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in
    ["res_id", "guest_id", "hotel_id", "room_number", "check_in_date", "check_out_date", "total_price",
     "created_at"]) + " FROM bronze_reservations")
sql("dq_fk_violations", """
SELECT 'guest' AS kind, count(*) AS violations FROM orphans WHERE orphan_reason = 'guest'
UNION ALL
SELECT 'hotel' AS kind, count(*) AS violations FROM orphans WHERE orphan_reason = 'hotel'
UNION ALL
SELECT 'room' AS kind, count(*) AS violations FROM res_clean r WHERE room_number IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM inv_clean i WHERE i.hotel_id = r.hotel_id AND i.room_number = r.room_number)
""")
sql("dq_metric_range", "SELECT date, hotel_id, revpar FROM kpi_revpar WHERE revpar < 0 OR revpar > 1000")
sql("dq_dimension_totals", """
SELECT count(*) AS total_rows, count(DISTINCT guest_id) AS unique_guests,
  count(*) FILTER (WHERE is_current) AS current_rows, count(*) FILTER (WHERE NOT is_current) AS historical_rows
FROM scd2_hist
""")
sql("dq_latest_load", "SELECT max(created_at) AS latest_created_at, count(*) AS rows FROM fact_stays")


def _shape(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN 'null' "
            f"WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN 'yyyy-MM-dd' "
            f"WHEN regexp_matches({c}, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$') THEN 'nn/nn/yyyy' "
            f"WHEN regexp_matches({c}, '^[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}$') THEN 'MM-dd-yyyy' ELSE 'other' END")


_RT = canon('room_type', ['Standard', 'Deluxe', 'Suite', 'Presidential'], 'Standard')
sql("dq_dirty_profile", f"""
SELECT field, shape, count(*) AS n FROM (
  SELECT 'check_in_date' AS field, {_shape('check_in_date')} AS shape FROM bronze_reservations
  UNION ALL SELECT 'check_out_date', {_shape('check_out_date')} FROM bronze_reservations
  UNION ALL SELECT 'room_type', CASE WHEN room_type IS NULL THEN 'null' WHEN room_type = {_RT} THEN 'canonical'
      WHEN upper(room_type) = upper({_RT}) THEN 'case_variant' ELSE 'unknown_code' END FROM bronze_reservations
  UNION ALL SELECT 'total_price', CASE WHEN total_price IS NULL THEN 'null' WHEN total_price <= 0 THEN 'non_positive'
      WHEN total_price >= 10000 THEN 'too_high' ELSE 'in_range' END FROM bronze_reservations
  UNION ALL SELECT 'room_number', CASE WHEN room_number IS NULL THEN 'null' WHEN room_number = '9999'
      THEN 'sentinel' ELSE 'value' END FROM bronze_reservations
  UNION ALL SELECT 'created_at', CASE WHEN created_at IS NULL THEN 'null'
      WHEN {ts_multi('created_at')} IS NULL THEN 'unparseable' ELSE 'parseable' END FROM bronze_reservations)
GROUP BY field, shape
""")
sql("analyst_current_tiers", "SELECT guest_id, name, email, loyalty_tier FROM dim_guests WHERE is_current")
sql("analyst_hotel_revenue", f"""
SELECT hotel_id, count(DISTINCT res_id) AS total_reservations, {r2('sum(total_folio_amount)')} AS total_revenue,
  {r2('avg(total_folio_amount)')} AS avg_revenue_per_stay FROM fact_stays GROUP BY hotel_id
""")
sql("analyst_revpar_by_date", f"SELECT date, {dec_avg('revpar')} AS avg_revpar_all_hotels FROM kpi_revpar GROUP BY date")
sql("analyst_hotels_by_revpar", f"SELECT hotel_id, {dec_avg('revpar')} AS avg_revpar FROM kpi_revpar GROUP BY hotel_id")
sql("analyst_turnover_by_date", f"""
SELECT date, {dec_avg('avg_turnover_time_minutes', 0)} AS avg_minutes FROM kpi_turnover GROUP BY date
""")
sql("analyst_low_attachment_hotels", f"""
SELECT hotel_id, {dec_avg('attachment_rate_percentage', 1)} AS attach_rate FROM kpi_ancillary
GROUP BY hotel_id HAVING {dec_avg('attachment_rate_percentage', 1)} < 60
""")


sql("json_roundtrip_reservations", "SELECT * FROM bronze_reservations")
sql("json_evolved_schema", "SELECT * FROM bronze_reservations")
sql("json_rescued_fields", """
SELECT res_id, NULLIF(concat_ws(',', CASE WHEN booking_channel IS NOT NULL THEN 'booking_channel' END,
                                CASE WHEN created_at IS NOT NULL THEN 'created_at' END), '') AS rescued_keys
FROM bronze_reservations
""")
sql("stream_fact_stays", "SELECT * FROM fact_stays")

cte("guest_updates", """
SELECT guest_id, name, email,
  CASE WHEN upper(coalesce(loyalty_tier, '')) = 'GOLD' THEN 'Silver' ELSE 'Gold' END AS loyalty_tier,
  country, registration_date, '2024-06-01T00:00:00Z' AS updated_at
FROM bronze_guests WHERE guest_id % 7 = 0
""")

cte("updates_latest", f"""
SELECT guest_id, name, email, loyalty_tier, country, registration_date, updated_at FROM (
 SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY updated_at DESC NULLS LAST, guest_id DESC) AS rn
 FROM (SELECT *, coalesce(email_base, 'guest_' || CAST(guest_id AS VARCHAR)) AS dedup_key FROM (
   SELECT *, regexp_replace(email, '\\+.*@', '@') AS email_base FROM (
    SELECT guest_id,
     coalesce(regexp_replace(trim(name), '\\s+', ' ', 'g'), 'Unknown') AS name,
     CASE WHEN email <> 'invalid-email' THEN lower(trim(email)) END AS email,
     {canon('loyalty_tier', ['Bronze', 'Silver', 'Gold', 'Platinum'], 'Bronze')} AS loyalty_tier,
     coalesce(upper(trim(country)), 'UNKNOWN') AS country,
     {date_multi('registration_date')} AS registration_date,
     {ts_multi('updated_at')} AS updated_at
    FROM guest_updates WHERE guest_id IS NOT NULL))))
WHERE rn = 1 AND updated_at IS NOT NULL
""")

cte("dim_v1", """
SELECT CAST(guest_id AS VARCHAR) || '_1' AS guest_sk, guest_id, name, email, loyalty_tier, country,
  registration_date, updated_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current,
  CAST(1 AS BIGINT) AS version
FROM guests_latest
""")

sql("stream_dim_guests", """
SELECT d.guest_sk, d.guest_id, d.name, d.email, d.loyalty_tier, d.country, d.registration_date, d.valid_from,
  CASE WHEN c.guest_id IS NOT NULL THEN c.updated_at ELSE d.valid_to END AS valid_to,
  d.is_current AND c.guest_id IS NULL AS is_current, d.version
FROM dim_v1 d LEFT JOIN (SELECT u.guest_id, u.updated_at FROM updates_latest u JOIN dim_v1 v
                         ON u.guest_id = v.guest_id AND v.is_current AND u.loyalty_tier <> v.loyalty_tier) c
  ON d.guest_id = c.guest_id
UNION ALL
SELECT CAST(u.guest_id AS VARCHAR) || '_' || CAST(coalesce(v.version + 1, 1) AS VARCHAR), u.guest_id, u.name,
  u.email, u.loyalty_tier, u.country, u.registration_date, u.updated_at, CAST(NULL AS TIMESTAMP), true,
  CAST(coalesce(v.version + 1, 1) AS BIGINT)
FROM updates_latest u LEFT JOIN dim_v1 v ON u.guest_id = v.guest_id AND v.is_current
WHERE v.guest_id IS NULL OR u.loyalty_tier <> v.loyalty_tier
""")

cte("tier_changes", """
SELECT u.*, v.version AS old FROM updates_latest u JOIN dim_v1 v ON u.guest_id = v.guest_id AND u.loyalty_tier <> v.loyalty_tier
""")
sql("stream_dim_guests_processing_time", """
SELECT * REPLACE (CASE WHEN guest_id IN (SELECT guest_id FROM tier_changes) THEN TIMESTAMP '2026-01-01 12:00:00' END AS valid_to,
  guest_id NOT IN (SELECT guest_id FROM tier_changes) AS is_current) FROM dim_v1
UNION ALL BY NAME
SELECT CAST(guest_id AS VARCHAR) || '_' || CAST(old + 1 AS VARCHAR) AS guest_sk, guest_id, name, email, loyalty_tier,
  country, registration_date, updated_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current,
  CAST(old + 1 AS BIGINT) AS version FROM tier_changes
UNION ALL BY NAME
SELECT CAST(guest_id AS VARCHAR) || '_1' AS guest_sk, guest_id, name, email, loyalty_tier, country, registration_date,
  updated_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current, CAST(1 AS BIGINT) AS version
FROM updates_latest WHERE guest_id NOT IN (SELECT guest_id FROM dim_v1)
""")
sql("kpi_revpar_inventory_capacity", f"""
SELECT v.date, v.hotel_id, {r2('v.total_room_revenue')} AS total_room_revenue, v.rooms_sold,
  c.total_available_rooms,
  CASE WHEN c.total_available_rooms > 0 THEN {r2('v.total_room_revenue / c.total_available_rooms')} ELSE 0.0 END
    AS revpar,
  CASE WHEN c.total_available_rooms > 0 THEN {r2('v.rooms_sold / c.total_available_rooms * 100')} ELSE 0.0 END
    AS occupancy_rate
FROM revenue_daily v LEFT JOIN (SELECT hotel_id, count(DISTINCT room_number) AS total_available_rooms
                                FROM inv_clean GROUP BY hotel_id) c ON v.hotel_id = c.hotel_id
""")
sql("kpi_turnover_first_clean", f"""
SELECT check_out_date AS date, hotel_id, count(*) AS total_checkouts,
  {r2('avg(s) / 60.0')} AS avg_turnover_time_minutes,
  {r2('quantile_disc(m, 0.5)')} AS median_turnover_time_minutes,
  {r2('min(m)')} AS min_turnover_time_minutes, {r2('max(m)')} AS max_turnover_time_minutes
FROM (SELECT res_id, hotel_id, room_number, check_out_date, checkout_timestamp,
        min(turnover_time_minutes) AS m, min(turnover_seconds) AS s
      FROM turnover GROUP BY res_id, hotel_id, room_number, check_out_date, checkout_timestamp)
GROUP BY check_out_date, hotel_id
""")

sql("kpi_ancillary_per_guest", f"""
SELECT date, hotel_id, total_guests, guests_with_ancillary_spend,
  CASE WHEN total_guests > 0 THEN {r2('guests_with_ancillary_spend / total_guests * 100')} ELSE 0.0 END
    AS attachment_rate_percentage,
  {r2('total_ancillary_revenue')} AS total_ancillary_revenue,
  CASE WHEN total_guests > 0 THEN {r2('total_ancillary_revenue / total_guests')} ELSE 0.0 END
    AS avg_ancillary_per_guest
FROM (SELECT date, hotel_id, count(DISTINCT guest_id) AS total_guests,
        count(DISTINCT CASE WHEN pos_item_count > 0 THEN guest_id END) AS guests_with_ancillary_spend,
        sum(total_pos_amount / stay_length_nights) AS total_ancillary_revenue
      FROM (SELECT {NIGHTS} AS date, hotel_id, guest_id, pos_item_count, total_pos_amount, stay_length_nights
            FROM fact_stays)
      GROUP BY date, hotel_id)
""")

cte("calendar_validated", """
SELECT date, hotel_id, room_number FROM (
 SELECT *, row_number() OVER (PARTITION BY hotel_id, room_number, date ORDER BY res_id) AS rn
 FROM occupancy_nights WHERE res_id IN (SELECT res_id FROM fact_stays)) WHERE rn = 1
""")

sql("kpi_revpar_validated", f"""
SELECT r.date, r.hotel_id, {r2('coalesce(v.total_room_revenue, 0.0)')} AS total_room_revenue,
  r.total_available_rooms,
  CASE WHEN r.total_available_rooms > 0
       THEN {r2('coalesce(v.total_room_revenue, 0.0) / r.total_available_rooms')} ELSE 0.0 END AS revpar
FROM (SELECT date, hotel_id, count(DISTINCT room_number) AS total_available_rooms FROM calendar_validated
      GROUP BY date, hotel_id) r
LEFT JOIN revenue_daily v ON r.date = v.date AND r.hotel_id = v.hotel_id
""")

cte("survivors_valid", """
SELECT g.guest_id, s.survivor_guest_id FROM guests_clean g JOIN (
  SELECT dedup_key, guest_id AS survivor_guest_id FROM (
    SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY updated_at DESC NULLS LAST, guest_id DESC) AS rn
    FROM guests_clean) WHERE rn = 1 AND updated_at IS NOT NULL) s ON g.dedup_key = s.dedup_key
""")

sql("fact_stays_survivor_map", """
SELECT * FROM (
  SELECT r.res_id, coalesce(m.survivor_guest_id, r.guest_id) AS guest_id, r.hotel_id, r.room_type,
    r.check_in_date, r.check_out_date,
    CAST(date_diff('day', r.check_in_date, r.check_out_date) AS INTEGER) AS stay_length_nights,
    r.total_price, r.booking_channel, coalesce(p.total_pos_amount, 0.0) AS total_pos_amount,
    CASE WHEN r.total_price IS NOT NULL THEN r.total_price + coalesce(p.total_pos_amount, 0.0)
         ELSE coalesce(p.total_pos_amount, 0.0) END AS total_folio_amount,
    coalesce(p.pos_item_count, 0) AS pos_item_count, r.created_at
  FROM res_clean r LEFT JOIN survivors_valid m ON r.guest_id = m.guest_id
  LEFT JOIN pos_agg p ON r.res_id = p.res_id)
WHERE guest_id IN (SELECT guest_id FROM dim_guests) AND hotel_id IN (SELECT hotel_id FROM bronze_inventory)
""")

cte("guest_corrections", """
SELECT guest_id, name, email,
  CASE WHEN upper(coalesce(loyalty_tier, '')) = 'GOLD' THEN 'Silver' ELSE 'Gold' END AS loyalty_tier,
  country, registration_date, '2024-06-01T00:00:00Z' AS updated_at
FROM bronze_guests WHERE guest_id % 7 = 0
UNION ALL
SELECT guest_id, upper(coalesce(name, 'unknown')) AS name, email, loyalty_tier, country, registration_date,
  '2024-06-01T00:00:00Z' AS updated_at
FROM bronze_guests WHERE guest_id % 11 = 0 AND guest_id % 7 <> 0
UNION ALL
SELECT guest_id, name, email,
  CASE WHEN upper(coalesce(loyalty_tier, '')) = 'PLATINUM' THEN 'Bronze' ELSE 'Platinum' END AS loyalty_tier,
  country, registration_date, '2020-01-01T00:00:00Z' AS updated_at
FROM bronze_guests WHERE guest_id % 13 = 0 AND guest_id % 7 <> 0 AND guest_id % 11 <> 0
""")

cte("corrections_latest", f"""
SELECT guest_id, name, email, loyalty_tier, country, registration_date, updated_at FROM (
 SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY updated_at DESC NULLS LAST, guest_id DESC) AS rn
 FROM (SELECT *, coalesce(email_base, 'guest_' || CAST(guest_id AS VARCHAR)) AS dedup_key FROM (
   SELECT *, regexp_replace(email, '\\+.*@', '@') AS email_base FROM (
    SELECT guest_id,
     coalesce(regexp_replace(trim(name), '\\s+', ' ', 'g'), 'Unknown') AS name,
     CASE WHEN email <> 'invalid-email' THEN lower(trim(email)) END AS email,
     {canon('loyalty_tier', ['Bronze', 'Silver', 'Gold', 'Platinum'], 'Bronze')} AS loyalty_tier,
     coalesce(upper(trim(country)), 'UNKNOWN') AS country,
     {date_multi('registration_date')} AS registration_date,
     {ts_multi('updated_at')} AS updated_at
    FROM guest_corrections WHERE guest_id IS NOT NULL))))
WHERE rn = 1 AND updated_at IS NOT NULL
""")

cte("corrections_detect", """
SELECT u.*, v.guest_id AS cur_id, v.loyalty_tier AS cur_tier, v.version AS cur_version
FROM corrections_latest u LEFT JOIN dim_v1 v ON u.guest_id = v.guest_id AND v.is_current
WHERE v.guest_id IS NULL OR u.updated_at >= v.valid_from
""")

sql("stream_dim_guests_type1", """
SELECT d.guest_sk, d.guest_id,
  CASE WHEN t.guest_id IS NOT NULL THEN t.name ELSE d.name END AS name,
  CASE WHEN t.guest_id IS NOT NULL THEN t.email ELSE d.email END AS email,
  d.loyalty_tier,
  CASE WHEN t.guest_id IS NOT NULL THEN t.country ELSE d.country END AS country,
  d.registration_date, d.valid_from,
  CASE WHEN c.guest_id IS NOT NULL THEN c.updated_at ELSE d.valid_to END AS valid_to,
  d.is_current AND c.guest_id IS NULL AS is_current, d.version
FROM dim_v1 d
LEFT JOIN (SELECT guest_id, updated_at FROM corrections_detect
           WHERE cur_id IS NOT NULL AND loyalty_tier <> cur_tier) c ON d.guest_id = c.guest_id
LEFT JOIN (SELECT guest_id, name, email, country FROM corrections_detect
           WHERE cur_id IS NOT NULL AND loyalty_tier = cur_tier) t ON d.guest_id = t.guest_id
UNION ALL
SELECT CAST(guest_id AS VARCHAR) || '_' || CAST(coalesce(cur_version + 1, 1) AS VARCHAR), guest_id, name, email,
  loyalty_tier, country, registration_date, updated_at, CAST(NULL AS TIMESTAMP), true,
  CAST(coalesce(cur_version + 1, 1) AS BIGINT)
FROM corrections_detect WHERE cur_id IS NULL OR loyalty_tier <> cur_tier
""")

sql("json_pinned_schema", "SELECT * FROM bronze_reservations")


sql("calendar_date_range", "SELECT min(date) AS min_date, max(date) AS max_date FROM calendar")
sql("json_rescued_count", """
SELECT count(*) AS records_read,
  count(*) FILTER (WHERE booking_channel IS NOT NULL OR created_at IS NOT NULL) AS records_rescued
FROM bronze_reservations
""")
sql("stream_replay_reset", "SELECT * FROM fact_stays")
sql("stream_late_pos", "SELECT * FROM fact_stays")
sql("stream_scd2_history", "SELECT * FROM scd2_hist")
# of the re-sent reservations some lines are cut off, and some have a text as their hotel
sql("stream_evolving_reservations", """
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS booking_channel, CAST(NULL AS VARCHAR) AS created_at), CAST(NULL AS VARCHAR) AS _rescued, 0 AS schema_version
FROM reservations_first
UNION ALL BY NAME
SELECT * REPLACE (CASE WHEN res_id % 75 = 0 THEN NULL ELSE hotel_id END AS hotel_id),
  CASE WHEN res_id % 75 = 0 THEN '{"hotel_id":"n/a"}' END AS _rescued, 1 AS schema_version
FROM reservations_resent WHERE res_id % 50 <> 0
UNION ALL BY NAME
SELECT CAST(json_object('_line', '{"res_id":' || CAST(res_id AS VARCHAR)) AS VARCHAR) AS _rescued, 1 AS schema_version
FROM reservations_resent WHERE res_id % 50 = 0
""")
sql("merge_upsert_reservations", f"""
SELECT * EXCLUDE (resent) FROM (
 SELECT res_id, guest_id, hotel_id, room_number,
   {canon('room_type', ['Standard', 'Deluxe', 'Suite', 'Presidential'], 'Standard')} AS room_type,
   {date_multi('check_in_date')} AS check_in_date,
   {date_multi('check_out_date', ('%Y-%m-%d', '%d/%m/%Y', '%m-%d-%Y', '%m/%d/%Y'))} AS check_out_date,
   CASE WHEN total_price > 0 AND total_price < 10000 THEN total_price END AS total_price,
   {canon('booking_channel', ['Website', 'Phone', 'OTA'], 'Unknown', [('WALK', 'Walk-in')])} AS booking_channel,
   {ts_multi('created_at')} AS created_at, resent
 FROM (SELECT *, false AS resent FROM reservations_first UNION ALL SELECT *, true FROM reservations_resent))
WHERE check_out_date > check_in_date
QUALIFY row_number() OVER (PARTITION BY res_id ORDER BY resent DESC, created_at DESC NULLS LAST, total_price DESC NULLS LAST) = 1
""")
sql("table_overwrite_scan", "SELECT * FROM res_clean")
sql("table_partitioned_calendar", "SELECT * FROM calendar")
sql("compacted_calendar", "SELECT * FROM calendar")
sql("table_append_counts", """
SELECT 'pos' AS "table", count(*) AS rows FROM pos_clean
UNION ALL SELECT 'missing', CAST(NULL AS BIGINT)
""")
sql("stream_saved_reservations", """
SELECT * FROM res_parsed
WHERE check_in_date IS NOT NULL AND check_out_date IS NOT NULL AND check_out_date > check_in_date
""")
sql("persisted_reuse", """
SELECT 'slots' AS report, CAST(count(*) AS VARCHAR) AS value FROM calendar
UNION ALL SELECT 'first', CAST(min(date) AS VARCHAR) FROM calendar
""")
sql("kpi_weekend_comparison", f"""
SELECT {r2('weekend_adr')} AS weekend_adr, {r2('weekday_adr')} AS weekday_adr, {r2('weekend_occ')} AS weekend_occ,
  {r2('weekday_occ')} AS weekday_occ, round(prem + sign(prem) * 1e-9, 1) AS premium_pct,
  abs(prem - 100) < 10 AS premium_validated
FROM (SELECT *, CASE WHEN coalesce(weekday_adr, 1) > 0
                THEN (coalesce(weekend_adr, 0) / coalesce(weekday_adr, 1) - 1) * 100 ELSE 0.0 END AS prem
  FROM (SELECT avg(adr) FILTER (WHERE is_weekend) AS weekend_adr, avg(adr) FILTER (WHERE NOT is_weekend) AS weekday_adr,
    avg(occupancy_rate) FILTER (WHERE is_weekend) AS weekend_occ,
    avg(occupancy_rate) FILTER (WHERE NOT is_weekend) AS weekday_occ FROM kpi_weekend))
""")
# approximate values are compared by whether they keep their stated errors
sql("rollup_months", f"""
SELECT coalesce(s.month, t.month) AS month, coalesce(s.hotel_id, t.hotel_id) AS hotel_id, stays, exact_guests, turnovers, turnover_median,
  CASE WHEN stays IS NOT NULL THEN true END AS guests_near, CASE WHEN stays IS NOT NULL THEN true END AS median_near
FROM (SELECT CAST(date_trunc('month', check_in_date) AS DATE) AS month, hotel_id, count(*) AS stays, count(DISTINCT guest_id) AS exact_guests
      FROM fact_stays GROUP BY 1, 2) s
FULL JOIN (SELECT CAST(date_trunc('month', check_out_date) AS DATE) AS month, hotel_id, count(*) AS turnovers,
             {r2('quantile_disc(turnover_time_minutes, 0.5)')} AS turnover_median
           FROM turnover GROUP BY 1, 2) t ON s.month = t.month AND s.hotel_id = t.hotel_id
""")

cte("name_reach", """
SELECT dedup_key, name, name AS other FROM guests_clean
UNION
SELECT r.dedup_key, r.name, o.name FROM name_reach r JOIN guests_clean o ON o.dedup_key = r.dedup_key
  AND levenshtein(lower(r.other), lower(o.name)) * 10 <= greatest(length(r.other), length(o.name)) * 3
""")
sql("guest_identities", """
SELECT guest_id, dedup_key, name, first_value(guest_id) OVER (PARTITION BY dedup_key, root ORDER BY updated_at DESC NULLS LAST, guest_id DESC) AS identity_guest_id
FROM guests_clean JOIN (SELECT dedup_key, name, min(other) AS root FROM name_reach GROUP BY dedup_key, name) USING (dedup_key, name)
""")
