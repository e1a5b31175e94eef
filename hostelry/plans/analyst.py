"""Analyses and documented analyst queries (catalogue P13-P15, A09-A17, B01-B06,
O04, G03, J04, J05, J16, J17)."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import dedup, identity, joins, nights, scd2
from . import gold, silver

WEEKEND_PREMIUM_EXPECTED = 100.0   # fixed value: prices double at weekends
WEEKEND_PREMIUM_TOLERANCE = 10.0   # fixed value: accepted distance in points
NAME_DISTANCE_TENTHS = 3           # our threshold for "same person" in P15, of the longer name's length


# ----------------------------------------------------------------- P13 late POS
def late_checkout_pos(pos_clean: DataFrame, stays: DataFrame) -> DataFrame:
    """J12 + C28: POS rows linked to a validated stay, flagged when posted on
    or after the check-out date."""
    j = (pos_clean.filter(F.col("res_id").isNotNull())
         .join(stays.select("res_id", "guest_id", "check_out_date"), "res_id", "inner"))
    return j.select("txn_id", "res_id", "guest_id", "check_out_date",
                    F.to_date("timestamp").alias("pos_date"), "timestamp", "category", "amount",
                    C.is_late_checkout("timestamp", "check_out_date").alias("is_late_checkout"))


def late_checkout_summary(late: DataFrame) -> DataFrame:
    """Counts and share of late POS in one aggregation."""
    return late.agg(F.count(F.lit(1)).alias("total_pos_with_res"),
                    F.count_if("is_late_checkout").alias("late_checkout_count")).select(
        "total_pos_with_res", "late_checkout_count",
        C.safe_percent("late_checkout_count", "total_pos_with_res").alias("late_checkout_pct"))


def link_late_pos(late: DataFrame, stays: DataFrame) -> DataFrame:
    """Each late POS row is linked to the guest's latest stay that began
    on or before the POS date; ``same_stay`` when that is its own stay."""
    facts = late.filter(F.col("is_late_checkout")).select("txn_id", "res_id", "guest_id", "pos_date")
    linked = joins.last_before(facts, stays.select("guest_id", "check_in_date", "res_id"), "guest_id",
                               "pos_date", "check_in_date", "res_id", "linked_res_id")
    return linked.withColumn(
        "link_status", F.when(F.col("linked_res_id") == F.col("res_id"), "same_stay").otherwise("later_stay"))


# ------------------------------------------------------------ P14 weekend pricing
def weekend_pricing(stays: DataFrame) -> DataFrame:
    """Price statistics by the weekend flag of the check-in day."""
    return (stays.withColumn("is_weekend", C.is_weekend("check_in_date")).groupBy("is_weekend")
            .agg(F.count(F.lit(1)).alias("reservation_count"), F.avg("total_price").alias("avg_price"),
                 F.min("total_price").alias("min_price"), F.max("total_price").alias("max_price")))


def weekend_premium(stays: DataFrame) -> DataFrame:
    """(weekend avg / weekday avg - 1) * 100 in one aggregation, with the
    self-check against the expected premium (computed in Spark, not the driver)."""
    we = C.is_weekend("check_in_date")
    a = stays.agg(F.avg(F.when(we, F.col("total_price"))).alias("weekend_avg_price"),
                  F.avg(F.when(~we, F.col("total_price"))).alias("weekday_avg_price"))
    prem = (F.col("weekend_avg_price") / F.col("weekday_avg_price") - 1) * 100
    return a.select("weekend_avg_price", "weekday_avg_price", F.round(prem, 2).alias("premium_pct"),
                    (F.abs(prem - WEEKEND_PREMIUM_EXPECTED) < WEEKEND_PREMIUM_TOLERANCE)
                    .alias("premium_validated"))


# ---------------------------------------------------------- P15 fuzzy guest match
def fuzzy_guest_match(cleaned_guests: DataFrame, tenths: int = NAME_DISTANCE_TENTHS) -> DataFrame:
    """Guests that share an e-mail base are compared by name with the
    survivor of their group (W01 winner), not pairwise: one comparison per
    guest, so a huge group costs linear work. ``is_same_person`` when the
    case-insensitive Levenshtein distance is within ``tenths`` of the longer name's length. Guests who
    differ from the survivor may be alike: see ``fuzzy_name_links``."""
    order = [F.col("updated_at").desc_nulls_last(), F.col("guest_id").desc()]
    survivors = dedup.latest_per_key(cleaned_guests, ["dedup_key"], order).select(
        "dedup_key", F.col("guest_id").alias("survivor_guest_id"), F.col("name").alias("survivor_name"))
    j = cleaned_guests.join(survivors, "dedup_key", "inner").filter(
        F.col("guest_id") != F.col("survivor_guest_id"))
    dist = F.levenshtein(F.lower("name"), F.lower("survivor_name"))
    return j.select("guest_id", "survivor_guest_id", "dedup_key", "name", "survivor_name",
                    dist.alias("name_distance"), (dist * 10 <= F.greatest(F.length("name"), F.length("survivor_name")) * tenths).alias("is_same_person"))


def fuzzy_name_links(cleaned_guests: DataFrame, tenths: int = NAME_DISTANCE_TENTHS) -> DataFrame:
    """P15, all pairs of a group: every two names of one e-mail base within the
    distance of ``fuzzy_guest_match`` that two different guests bear, a name that
    several guests share being linked with itself. With ``fuzzy_name_members``
    these are all pairs of guests, without a row for each.

    Exact segment join instead of all pairs: the longer name is cut into one
    segment more than edits are allowed, so the shorter one holds a segment
    unchanged, shifted no further than the edits left and right of it permit.
    Only names that share such a segment are compared. Groups of one guest are
    left out before names are cut."""
    names = cleaned_guests.groupBy("dedup_key", "name").agg(F.min("guest_id").alias("first"), F.max("guest_id").alias("last"))
    names = names.withColumn("low", F.lower("name")).withColumn("size", F.length("name")).withColumn("chars", F.length("low"))
    shape = F.struct("size", "chars")
    groups = names.groupBy("dedup_key").agg(F.collect_set(shape).alias("shapes"), F.count(F.lit(1)).alias("n"),
                                            F.min("first").alias("lo"), F.max("last").alias("hi"))
    # names of one group differ in few lengths, so that the set of them stays small
    several = names.join(groups.filter("n > 1 AND lo < hi").select("dedup_key", "shapes"), "dedup_key")

    def cut(df: DataFrame) -> DataFrame:
        """One row for each segment of a name of ``size`` and ``chars``."""
        df = df.withColumn("edits", F.expr(f"CAST(size * {tenths} DIV 10 AS INT)"))
        df = df.withColumn("part", F.explode(F.sequence(F.lit(0), "edits")))
        return df.withColumn("start", F.expr("CAST(part * chars DIV (edits + 1) AS INT)")).withColumn(
            "width", F.expr("CAST((part + 1) * chars DIV (edits + 1) AS INT) - start"))
    key = ["dedup_key", "size", "chars", "part", "piece"]
    longer = cut(several).select(*key[:-1], F.expr("substring(low, start + 1, width)").alias("piece"), "name", "low", "first", "last", "edits")
    shorter = several.select("dedup_key", F.col("name").alias("name_2"), F.col("low").alias("low_2"), F.col("first").alias("first_2"),
                             F.col("last").alias("last_2"), F.col("size").alias("size_2"), F.col("chars").alias("chars_2"),
                             F.explode("shapes").alias("shape")).select("*", "shape.*").drop("shape")
    shorter = shorter.filter(f"size >= size_2 AND abs(chars - chars_2) * 10 <= size * {tenths}")
    shorter = cut(shorter).withColumn("from", F.expr("greatest(0, start - CAST((edits + chars - chars_2) DIV 2 AS INT))")).withColumn(
        "to", F.expr("least(chars_2 - width, start + CAST((edits - chars + chars_2) DIV 2 AS INT))"))
    shorter = shorter.filter("`from` <= `to`").withColumn("at", F.explode(F.sequence("from", "to")))
    shorter = shorter.select(*key[:-1], F.expr("substring(low_2, at + 1, width)").alias("piece"), "name_2", "low_2", "first_2", "last_2", "size_2")
    pairs = longer.join(shorter, key).filter("size > size_2 OR name > name_2").filter("least(first, first_2) < greatest(last, last_2)")
    links = pairs.withColumn("name_distance", F.levenshtein("low", "low_2")).filter("name_distance <= edits").select(
        "dedup_key", F.least("name", "name_2").alias("name"), F.greatest("name", "name_2").alias("other_name"), "name_distance").distinct()
    shared = names.filter("first < last AND name IS NOT NULL")
    return links.unionByName(shared.select("dedup_key", "name", F.col("name").alias("other_name"), F.lit(0).alias("name_distance")))


def fuzzy_name_members(cleaned_guests: DataFrame) -> DataFrame:
    """The guests behind the names of ``fuzzy_name_links``, for every
    e-mail base that several guests share."""
    groups = cleaned_guests.groupBy("dedup_key").agg(F.min("guest_id").alias("lo"), F.max("guest_id").alias("hi")).filter("lo < hi")
    return cleaned_guests.select("dedup_key", "name", "guest_id").distinct().join(groups.select("dedup_key"), "dedup_key", "left_semi")


def guest_identities(cleaned_guests: DataFrame, tenths: int = NAME_DISTANCE_TENTHS) -> DataFrame:
    """One survivor for all guests of an e-mail base whose names are linked, directly or
    by way of others (A like B, B like C). The survivor is chosen as in W01: the latest update, then the highest id.
    Names without a link are identities of their own."""
    links = fuzzy_name_links(cleaned_guests, tenths).filter("name <> other_name")
    roots = identity.components(links, "dedup_key", "name", "other_name")
    g = cleaned_guests.select("guest_id", "dedup_key", "name", "updated_at")
    g = g.join(roots.withColumnRenamed("node", "name"), ["dedup_key", "name"], "left").withColumn("root", F.coalesce("root", "name"))
    order = [F.col("updated_at").desc_nulls_last(), F.col("guest_id").desc()]
    survivors = dedup.latest_per_key(g, ["dedup_key", "root"], order).select(
        F.col("dedup_key").alias("_group"), F.col("root").alias("_root"), F.col("guest_id").alias("identity_guest_id"))
    same = F.col("dedup_key").eqNullSafe(F.col("_group")) & F.col("root").eqNullSafe(F.col("_root"))
    return g.join(survivors, same).select("guest_id", "dedup_key", "name", "identity_guest_id")


# ------------------------------------------------------------------- summaries
def stays_averages(stays: DataFrame) -> DataFrame:
    """A09 + A16 (Q10): totals and four averages over the stays in one pass."""
    return stays.agg(
        F.count(F.lit(1)).alias("total_stays"),
        F.count_if(F.col("pos_item_count") > 0).alias("stays_with_pos"),
        F.count_if(F.col("pos_item_count") == 0).alias("stays_without_pos"),
        F.avg("total_price").alias("avg_room_price"),
        F.avg("stay_length_nights").alias("avg_stay_nights"),
        F.avg("total_pos_amount").alias("avg_pos_amount"),
        F.avg("total_folio_amount").alias("avg_folio_amount"),
    ).withColumn("pos_share_pct", C.safe_percent("stays_with_pos", "total_stays"))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """A10: count per category, largest first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(col))


def distinct_counts(stays: DataFrame, calendar: DataFrame) -> DataFrame:
    """Distinct guests and hotels, stays and booked slots, as (metric, value)."""
    from .quality import as_metrics
    s = stays.agg(F.countDistinct("guest_id").alias("distinct_guests"),
                  F.countDistinct("hotel_id").alias("distinct_hotels"), F.count(F.lit(1)).alias("stays"))
    c = calendar.agg(F.count(F.lit(1)).alias("booked_room_nights"),
                     F.count_if("is_overbooked").alias("overbooked_room_nights"))
    return as_metrics(s).unionByName(as_metrics(c))


def date_range(stays: DataFrame) -> DataFrame:
    """First and last check-in and check-out."""
    return stays.agg(F.min("check_in_date").alias("first_check_in"), F.max("check_in_date").alias("last_check_in"),
                     F.min("check_out_date").alias("first_check_out"),
                     F.max("check_out_date").alias("last_check_out"))


def calendar_range(calendar: DataFrame) -> DataFrame:
    """First and last night of the daily calendar."""
    return calendar.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def kpi_weekend_comparison(weekend_kpi: DataFrame) -> DataFrame:
    """A14 over the KPI rows: mean ADR and occupancy of weekend and weekday
    nights, the premium, and whether it is within the tolerance of the expected
    one. Means are taken in DECIMAL(18,2) arithmetic, as in ``kpi_averages``."""
    we = F.col("is_weekend")

    def mean(cond, col, name):
        return F.avg(F.when(cond, F.col(col).cast("decimal(18,2)"))).cast("double").alias(name)
    a = weekend_kpi.agg(mean(we, "adr", "weekend_adr"), mean(~we, "adr", "weekday_adr"),
                        mean(we, "occupancy_rate", "weekend_occ"), mean(~we, "occupancy_rate", "weekday_occ"))
    # no weekday rows count as an ADR of 1, no weekend rows as 0; an ADR of 0 gives no premium
    weekend, weekday = F.coalesce("weekend_adr", F.lit(0.0)), F.coalesce("weekday_adr", F.lit(1.0))
    prem = F.when(weekday > 0, (weekend / weekday - 1) * 100).otherwise(F.lit(0.0))
    return a.select(*[F.round(c, 2).alias(c) for c in a.columns], F.round(prem, 1).alias("premium_pct"),
                    (F.abs(prem - WEEKEND_PREMIUM_EXPECTED) < WEEKEND_PREMIUM_TOLERANCE).alias("premium_validated"))


def kpi_averages(measures: DataFrame, rooms: DataFrame, turnover: DataFrame) -> DataFrame:
    """The mean of each KPI column as (metric, value). The stay KPIs are columns of one
    join of the night measures and the rooms, so all their means are one aggregation.
    KPIs are rounded to cents, so their mean is taken in DECIMAL(18,2) arithmetic (exact), then rounded."""
    def mean(col, name):
        return F.round(F.avg(col.cast("decimal(18,2)")), 2).cast("double").alias(name)
    revenue, sold = F.col("total_room_revenue"), F.col("rooms_sold")
    j = measures.join(rooms, list(gold.KEYS), "full_outer")

    def of_sales(ratio):
        return F.when(sold.isNotNull(), ratio)
    a = j.agg(
        mean(F.when(F.col("total_available_rooms").isNotNull(), C.safe_ratio(F.coalesce(revenue, F.lit(0.0)), "total_available_rooms")), "avg_revpar"),
        mean(of_sales(C.safe_ratio(revenue, sold)), "avg_adr"),
        mean(of_sales(C.safe_percent("guests_with_ancillary_spend", sold)), "avg_attachment_rate"),
        mean(of_sales(C.safe_ratio("total_ancillary_revenue", sold)), "avg_ancillary_per_guest"))
    t = turnover.agg(mean(F.col("avg_turnover_time_minutes"), "avg_turnover_minutes"))

    def unpivot(row):
        return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in row.columns])))
    return unpivot(a).unionByName(unpivot(t))


def multi_version_guests(history: DataFrame) -> DataFrame:
    """J13 + A17: all rows of guests having more than one version row."""
    multi = history.groupBy("guest_id").agg(F.count(F.lit(1)).alias("version_count")).filter(
        F.col("version_count") > 1)
    return history.join(multi.select("guest_id"), "guest_id", "left_semi")


def top_revpar_days(revpar: DataFrame, n: int = 10) -> DataFrame:
    """The n best (date, hotel) by RevPAR; the limit is the report."""
    return revpar.orderBy(F.col("revpar").desc(), F.col("date"), F.col("hotel_id")).limit(n)


# ------------------------------------------------------------------ spec-only
def orphan_stays(stays_all: DataFrame, dim: DataFrame, raw_inventory: DataFrame) -> DataFrame:
    """Stays whose guest or hotel is unknown, one row per reason."""
    cols = ["res_id", "guest_id", "hotel_id"]
    g = joins.orphans(stays_all.select(*cols), dim, ["guest_id"]).withColumn("orphan_reason", F.lit("guest"))
    h = joins.orphans(stays_all.select(*cols), raw_inventory.select("hotel_id").distinct(), ["hotel_id"]).withColumn(
        "orphan_reason", F.lit("hotel"))
    return g.unionByName(h)


def stays_with_known_room(res_clean: DataFrame, inventory_clean: DataFrame) -> DataFrame:
    """Reservations whose (hotel, room) exists in the cleaned inventory."""
    return joins.keep_known(res_clean.filter(F.col("room_number").isNotNull()), inventory_clean,
                            ["hotel_id", "room_number"])


def stays_with_tier_asof(stays: DataFrame, history: DataFrame) -> DataFrame:
    """The loyalty tier valid at check-in (validity interval of the SCD2 history)."""
    facts = stays.select("res_id", "guest_id", "check_in_date")
    out = scd2.asof_version(facts, history, "guest_id", "check_in_date", ["loyalty_tier", "version"])
    return out.withColumnRenamed("loyalty_tier", "tier_at_check_in").withColumnRenamed(
        "version", "version_at_check_in")


def full_availability_calendar(inventory_clean: DataFrame, res_clean: DataFrame) -> DataFrame:
    """Every inventory room on every date from the first to the last night of the
    reservations with a room, free or booked. The two dates come from the reservations by one
    aggregation before their nights are made; without any there are no dates."""
    with_rooms = res_clean.filter(F.col("room_number").isNotNull())
    first, last = with_rooms.agg(F.min("check_in_date"), F.date_sub(F.max("check_out_date"), 1)).first()
    return nights.availability_calendar(inventory_clean, silver.fact_room_availability_daily(res_clean), first, last)


# ------------------------------------------------------------- B01-B06 via SQL
def analyst_sql(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Run one documented statement over its input, bound by name for this call only."""
    return spark.sql(ANALYST_SQL[name], **{analyst_input(name): df})


def analyst_input(name: str) -> str:
    """Name of the table that a documented statement reads."""
    return next(table for _, table, _, _ in Formatter().parse(ANALYST_SQL[name]) if table)


# Output column names are fixed values: the documented ones.
ANALYST_SQL = {
    "analyst_current_tiers": """
        SELECT guest_id, name, email, loyalty_tier FROM {dim_guests} WHERE is_current
        ORDER BY loyalty_tier DESC, guest_id""",
    "analyst_hotel_revenue": """
        SELECT hotel_id, COUNT(DISTINCT res_id) AS total_reservations,
               ROUND(SUM(total_folio_amount), 2) AS total_revenue,
               ROUND(AVG(total_folio_amount), 2) AS avg_revenue_per_stay
        FROM {fact_stays} GROUP BY hotel_id ORDER BY total_revenue DESC""",
    "analyst_revpar_by_date": """
        SELECT date, CAST(ROUND(AVG(CAST(revpar AS DECIMAL(18,2))), 2) AS DOUBLE) AS avg_revpar_all_hotels
        FROM {kpi_revpar} GROUP BY date ORDER BY date""",
    "analyst_hotels_by_revpar": """
        SELECT hotel_id, CAST(ROUND(AVG(CAST(revpar AS DECIMAL(18,2))), 2) AS DOUBLE) AS avg_revpar
        FROM {kpi_revpar} GROUP BY hotel_id ORDER BY avg_revpar DESC""",
    "analyst_turnover_by_date": """
        SELECT date, CAST(ROUND(AVG(CAST(avg_turnover_time_minutes AS DECIMAL(18,2))), 0) AS DOUBLE)
               AS avg_minutes
        FROM {kpi_turnover} GROUP BY date ORDER BY date""",
    "analyst_low_attachment_hotels": """
        SELECT hotel_id, CAST(ROUND(AVG(CAST(attachment_rate_percentage AS DECIMAL(18,2))), 1) AS DOUBLE) AS attach_rate
        FROM {kpi_ancillary} GROUP BY hotel_id
        HAVING attach_rate < 60
        ORDER BY attach_rate""",
}
