"""Hotel-shaped bronze views derived from the driver's parquet tables.

The raw hotel feeds are newline-delimited JSON with text dates in several
formats, mixed-case codes, sentinels, out-of-range values and duplicates. To
test every operator on data that grows with the given tables, each bronze
entity is a deterministic projection of one driver table, with the defects
chosen by fixed residues of the table key (no random generator):

=====================  =========  ==============================================
view                   from       key
=====================  =========  ==============================================
bronze_guests          customer   guest_id = c_custkey
guest_change_log       orders     guest_id = o_custkey, one row per order
bronze_inventory       part       hotel_id = p_partkey % 5 + 1
bronze_reservations    orders     res_id = o_orderkey (+ corrected copies)
bronze_pos             lineitem   txn_id = l_orderkey * 10 + l_linenumber
bronze_housekeeping    events     log_id = event_id
=====================  =========  ==============================================

All views are narrow projections (plus one union for duplicates), so they are
free: Catalyst prunes the parquet columns each consumer needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import filters

# Fixed parameters of the derivation (shared with the SQL oracle).
STAY_YEAR_START = "2024-01-01"
STAY_DAYS = 366              # check-ins spread over the leap year 2024
ROOMS_PER_HOTEL = 40         # three in four reservations use room numbers 0..39, the others one by their guest
HOTELS = 5
UNKNOWN_HOTELS = 900         # ids from here on are in no inventory
ORPHAN_GUEST_OFFSET = 1_000_000
ORPHAN_RES_OFFSET = 2_000_000_000_000
COPY_RES_OFFSET = 1_000_000_000_000
COPY_TXN_OFFSET = 1_000_000_000_000_000

ISO_TS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _idiv(a: Column, b: int) -> Column:
    """Integer division of a non-negative long (SQL ``div``)."""
    return (a / b).cast("long")


def _day(offset: Column) -> Column:
    return F.date_add(F.lit(STAY_YEAR_START).cast("date"), offset.cast("int"))


def _ts(day: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, day.cast("timestamp_ntz"))


def _date_text(d: Column, selector: Column, rules: list[tuple[int, str]], default: str) -> Column:
    expr = None
    for value, fmt in rules:
        branch = F.date_format(d, fmt)
        expr = F.when(selector == value, branch) if expr is None else expr.when(selector == value, branch)
    return expr.otherwise(F.date_format(d, default))


def bronze_guests(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    base = F.concat(F.lit("guest"), k.cast("string"), F.lit("@inn.example"))
    email = (F.when(k % 25 == 0, F.lit(None).cast("string"))
             .when(k % 30 == 0, F.lit("invalid-email"))
             .when(k % 20 == 0, F.concat(F.lit("guest"), (k - 1).cast("string"), F.lit("+alt@inn.example")))
             .when(k % 45 == 44, F.concat(F.lit("guest"), (k - 1).cast("string"), F.lit("@inn.example")))
             .when((k % 60).between(32, 34), F.concat(F.lit("guest"), (k - k % 60 + 31).cast("string"), F.lit("@inn.example")))
             .when(k % 9 == 0, F.concat(F.lit(" "), F.upper(base), F.lit(" ")))
             .otherwise(base))
    name = (F.when(k % 40 == 1, F.lit(None).cast("string"))
            .when(k % 60 == 33, F.concat(F.col("c_name"), F.lit(" Junior")))  # like the next one only
            .when(k % 60 == 34, F.concat(F.col("c_name"), F.lit(" Jr.")))
            .when(k % 10 == 3, F.concat(F.lit("  "), F.col("c_name"), F.lit("   ")))
            .when(k % 10 == 7, F.regexp_replace(F.col("c_name"), "#", "   #"))
            .when(k % 10 == 9, F.lower(F.col("c_name")))
            .otherwise(F.col("c_name")))
    tier = (F.when(k % 8 == 0, F.lit(None).cast("string"))
            .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("gold"))
            .when(F.col("c_mktsegment") == "BUILDING", F.lit("SILVER"))
            .when(F.col("c_mktsegment") == "FURNITURE", F.lit("Bronze"))
            .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("Platinum"))
            .otherwise(F.lit("diamond")))
    country = (F.when(k % 20 == 5, F.lit(None).cast("string"))
               .when(k % 2 == 0, F.concat(F.lit(" n"), F.col("c_nationkey").cast("string"), F.lit(" ")))
               .otherwise(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))))
    reg_day = F.date_add(F.lit("2018-01-01").cast("date"), (k * 53 % 2000).cast("int"))
    reg = F.when(k % 12 == 11, F.lit(None).cast("string")).otherwise(
        _date_text(reg_day, k % 10, [(6, "dd/MM/yyyy"), (7, "dd/MM/yyyy"), (8, "MM/dd/yyyy")], "yyyy-MM-dd"))
    upd_ts = _ts(F.lit("2023-01-01").cast("date"), k * 7919 % 31536000)
    upd = (F.when(k % 11 == 10, F.lit("invalid-timestamp"))
           .when(k % 10 == 7, F.date_format(upd_ts, "dd/MM/yyyy HH:mm"))
           .when(k % 10 == 8, F.date_format(upd_ts, "yyyy-MM-dd HH:mm:ss"))
           .otherwise(F.date_format(upd_ts, ISO_TS)))
    return c.select(k.alias("guest_id"), name.alias("name"), email.alias("email"),
                    tier.alias("loyalty_tier"), country.alias("country"),
                    reg.alias("registration_date"), upd.alias("updated_at"))


def guest_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tier history: every order is a profile update of its customer, moved
    forward 28 years so the history overlaps the 2024 stays."""
    o = _read(spark, sf_dir, "orders")
    p = F.col("o_orderpriority")
    tier = (F.when(p == "1-URGENT", "Platinum").when(p == "2-HIGH", "Gold")
            .when(p == "3-MEDIUM", "Silver").otherwise("Bronze"))
    return o.select(F.col("o_custkey").alias("guest_id"), tier.alias("loyalty_tier"),
                    F.timestamp_add("YEAR", F.lit(28), F.col("o_orderdate")).alias("updated_at"), F.col("o_orderkey").alias("change_seq"))


def bronze_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    t = F.col("p_type")
    room_type = (F.when(t == "LARGE", "suite").when(t == "PROMO", "Deluxe")
                 .when(t == "SMALL", "STANDARD").when(t == "MEDIUM", "deluxe")
                 .when(t == "STANDARD", "Presidential").otherwise(t))
    room = (F.when(k % 97 == 13, F.lit("9999"))
            .when(k % 89 == 7, F.lit(None).cast("string"))
            .otherwise(_idiv(k, 5).cast("string")))
    return p.select(
        F.when(k % 83 == 5, F.lit(None).cast("long")).otherwise(k % HOTELS + 1).alias("hotel_id"),
        room.alias("room_number"),
        room_type.alias("room_type"),
        (F.col("p_size") % 10 + 1).cast("long").alias("floor"),
        (F.col("p_size") % 3 == 0).alias("is_smoking"),
        F.date_format(F.date_add(F.lit("2015-01-01").cast("date"), (k * 7 % 3000).cast("int")),
                      "yyyy-MM-dd").alias("last_renovated"),
        (F.col("p_size") % 4 + 1).cast("long").alias("max_occupancy"),
    )


def _reservation_columns(o: DataFrame, corrected: bool) -> DataFrame:
    """The days and the time of a reservation are computed once and then formatted: written out in every
    branch of the texts they make a generated method that is too long for the JVM to compile."""
    k = F.col("o_orderkey")
    ci = _day(k * 37 % STAY_DAYS)
    n = k % 7 + 1
    co = (F.when(k % 31 == 4, ci)
          .when(k % 37 == 6, F.date_sub(ci, 2))
          .otherwise(F.date_add(ci, n.cast("int"))))
    price = _idiv(_idiv(F.floor(F.col("o_totalprice")).cast("long"), 40), 420) * 420
    p = F.col("o_orderpriority")
    channel = (F.when(k % 11 == 6, F.lit("fax"))
               .when(k % 9 == 4, F.lit("walk in desk"))
               .when(p == "1-URGENT", F.lit("website"))
               .when(p == "2-HIGH", F.lit("PHONE"))
               .when(p == "3-MEDIUM", F.lit("ota"))
               .when(p == "4-NOT SPECIFIED", F.lit("Walk-In"))
               .otherwise(F.lit(None).cast("string")))
    rt_sel = _idiv(k, 3) % 6
    room_type = (F.when(rt_sel == 0, "standard").when(rt_sel == 1, "DELUXE").when(rt_sel == 2, "Suite")
                 .when(rt_sel == 3, "presidential").when(rt_sel == 4, F.lit(None).cast("string"))
                 .otherwise("Penthouse"))
    room = (F.when(k % 20 == 3, F.lit("9999"))
            .when(k % 13 == 5, F.lit(None).cast("string"))
            .when(k % 4 == 0, (ROOMS_PER_HOTEL + _idiv(F.col("o_custkey"), 5)).cast("string"))
            .otherwise((_idiv(k, 5) % ROOMS_PER_HOTEL).cast("string")))
    hotel = F.when(k % 211 == 17, UNKNOWN_HOTELS + k % HOTELS).otherwise(k % HOTELS + 1).alias("hotel_id")
    created = _ts(F.date_sub(ci, (k % 60).cast("int")), k * 13 % 86400)
    o = o.select("*", filters.computed_once(ci.alias("_in"), co.alias("_out"), created.alias("_created")))
    ci, co, created = F.col("_in"), F.col("_out"), F.col("_created")
    if corrected:
        # A corrected re-send of the same reservation: clean formats, one day later.
        return o.select(
            k.alias("res_id"), F.col("o_custkey").alias("guest_id"), hotel,
            room.alias("room_number"), room_type.alias("room_type"),
            F.date_format(ci, "yyyy-MM-dd").alias("check_in_date"),
            F.date_format(F.date_add(ci, n.cast("int")), "yyyy-MM-dd").alias("check_out_date"),
            price.cast("double").alias("total_price"), channel.alias("booking_channel"),
            F.date_format(F.timestamp_add("DAY", F.lit(1), created), ISO_TS).alias("created_at"))
    ci_text = (F.when(k % 17 == 2, F.lit(None).cast("string"))
               .when(k % 41 == 40, F.lit("TBD"))
               .otherwise(_date_text(ci, k % 10, [(6, "dd/MM/yyyy"), (7, "dd/MM/yyyy"), (8, "MM/dd/yyyy")],
                                     "yyyy-MM-dd")))
    co_text = F.when(k % 23 == 8, F.lit(None).cast("string")).otherwise(
        _date_text(co, _idiv(k, 10) % 10,
                   [(6, "dd/MM/yyyy"), (7, "MM-dd-yyyy"), (8, "MM/dd/yyyy")], "yyyy-MM-dd"))
    total = (F.when(k % 19 == 3, F.lit(None).cast("double"))
             .when(k % 50 == 11, -price.cast("double"))
             .otherwise(price.cast("double")))
    created_text = (F.when(k % 8 == 7, F.lit("invalid-timestamp"))
                    .when(k % 8 == 5, F.date_format(created, "dd/MM/yyyy HH:mm"))
                    .when(k % 8 == 6, F.date_format(created, "yyyy-MM-dd HH:mm:ss"))
                    .otherwise(F.date_format(created, ISO_TS)))
    guest = F.when(k % 20 == 7, F.col("o_custkey") + ORPHAN_GUEST_OFFSET).otherwise(F.col("o_custkey"))
    return o.select(
        k.alias("res_id"), guest.alias("guest_id"), hotel,
        room.alias("room_number"), room_type.alias("room_type"),
        ci_text.alias("check_in_date"), co_text.alias("check_out_date"),
        total.alias("total_price"), channel.alias("booking_channel"), created_text.alias("created_at"))


def bronze_reservations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservations, plus corrected re-sends (same res_id) of every 25th and
    content copies under a new res_id of every 101st."""
    o = _read(spark, sf_dir, "orders")
    base = _reservation_columns(o, corrected=False)
    resend = _reservation_columns(o.filter(F.col("o_orderkey") % 25 == 0), corrected=True)
    copies = (_reservation_columns(o.filter(F.col("o_orderkey") % 101 == 0), corrected=False)
              .withColumn("res_id", F.col("res_id") + COPY_RES_OFFSET))
    return base.unionByName(resend).unionByName(copies)


def reservation_drops(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The reservations as two deliveries: first the originals and content
    copies, later the corrected re-sends (for incremental loads)."""
    o = _read(spark, sf_dir, "orders")
    first = _reservation_columns(o, corrected=False).unionByName(
        _reservation_columns(o.filter(F.col("o_orderkey") % 101 == 0), corrected=False)
        .withColumn("res_id", F.col("res_id") + COPY_RES_OFFSET))
    second = _reservation_columns(o.filter(F.col("o_orderkey") % 25 == 0), corrected=True)
    return first, second


def bronze_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-of-sale charges; each falls on a day of its reservation's stay or
    on the check-out day (late)."""
    li = _read(spark, sf_dir, "lineitem")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    txn = ok * 10 + ln
    res = (F.when((ok + ln) % 7 == 0, F.lit(None).cast("long"))
           .when(txn % 23 == 5, ok + ORPHAN_RES_OFFSET)
           .otherwise(ok))
    rf = F.col("l_returnflag")
    category = (F.when(ln == 7, F.lit(None).cast("string")).when(ln == 4, F.lit("Service"))
                .when(ln == 5, F.lit("minibar")).when(rf == "A", F.lit("food"))
                .when(rf == "N", F.lit("DRINK")).otherwise(F.lit("Spa")))
    amt = _idiv(F.floor(F.col("l_extendedprice")).cast("long"), 10).cast("double")
    amount = (F.when(txn % 13 == 1, F.lit(None).cast("double"))
              .when(txn % 29 == 2, -amt).otherwise(amt))
    day = _day(ok * 37 % STAY_DAYS + (ln * 3 + F.col("l_partkey")) % (ok % 7 + 2))
    ts = _ts(day, (F.col("l_partkey") % 24) * 3600 + (F.col("l_suppkey") % 60) * 60)
    ts_text = (F.when(txn % 9 == 8, F.lit("invalid-timestamp"))
               .when(txn % 9 == 7, F.date_format(ts, "dd/MM/yyyy HH:mm"))
               .when(txn % 9 == 6, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
               .otherwise(F.date_format(ts, ISO_TS)))
    base = li.select(txn.alias("txn_id"), res.alias("res_id"),
                     F.concat(F.lit("item-"), F.col("l_partkey").cast("string")).alias("item_name"),
                     category.alias("category"), amount.alias("amount"), ts_text.alias("timestamp"))
    copies = base.filter(F.col("txn_id") % 53 == 0).withColumn("txn_id", F.col("txn_id") + COPY_TXN_OFFSET)
    return base.unionByName(copies)


def bronze_housekeeping(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    k, u, t = F.col("event_id"), F.col("user_id"), F.col("event_type")
    status = (F.when(k % 12 == 0, F.lit(None).cast("string"))
              .when(t == "view", F.lit("clean")).when(t == "click", F.lit("CLEAN"))
              .when(t == "purchase", F.lit("Dirty")).when(t == "signup", F.lit("maintenance"))
              .otherwise(F.lit("Out-Of-Order")))
    ts = F.col("ts")
    ts_text = (F.when(k % 10 == 9, F.lit("invalid-timestamp"))
               .when(k % 10 == 7, F.date_format(ts, "dd/MM/yyyy HH:mm"))
               .when(k % 10 == 8, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
               .otherwise(F.date_format(ts, ISO_TS)))
    return e.select(k.alias("log_id"), (u % HOTELS + 1).alias("hotel_id"),
                    (_idiv(u, 5) % ROOMS_PER_HOTEL).cast("string").alias("room_number"),
                    (u % 17).alias("staff_id"), status.alias("status"), ts_text.alias("timestamp"))


VIEWS = {
    "bronze_guests": bronze_guests,
    "guest_change_log": guest_change_log,
    "bronze_inventory": bronze_inventory,
    "bronze_reservations": bronze_reservations,
    "bronze_pos": bronze_pos,
    "bronze_housekeeping": bronze_housekeeping,
}


class Bronze:
    """Lazy accessor: ``Bronze(spark, sf_dir).reservations`` etc."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @property
    def guests(self) -> DataFrame:
        return bronze_guests(self.spark, self.sf_dir)

    @property
    def guest_changes(self) -> DataFrame:
        return guest_change_log(self.spark, self.sf_dir)

    @property
    def inventory(self) -> DataFrame:
        return bronze_inventory(self.spark, self.sf_dir)

    @property
    def reservations(self) -> DataFrame:
        return bronze_reservations(self.spark, self.sf_dir)

    @property
    def pos(self) -> DataFrame:
        return bronze_pos(self.spark, self.sf_dir)

    @property
    def housekeeping(self) -> DataFrame:
        return bronze_housekeeping(self.spark, self.sf_dir)
