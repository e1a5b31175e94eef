"""Data-quality report (catalogue Q01-Q13). Each metric is one aggregation;
only report rows ever reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as C

REVPAR_RANGE = (0.0, 1000.0)   # fixed value: plausible RevPAR band


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


STEP_SCHEMA = "entity string, records_read long, records_kept long, records_dropped long"


class StepCounts:
    """Q01: records read, kept and dropped by each step, counted while its table is written:
    the counts ride on the write as named metrics, so no input is read for them. (A stage that
    Spark runs again after a lost executor may be counted again.)"""

    def __init__(self, spark: SparkSession):
        self.spark, self.rows = spark, []

    def write(self, entity: str, read: DataFrame, step, path: str, partition_by: str | None = None) -> DataFrame:
        """Writes ``step(read)`` to ``path`` and returns the stored table."""
        before, after = Observation(f"{entity} read"), Observation(f"{entity} kept")
        rows = F.count(F.lit(1)).alias("rows")
        out = step(read.observe(before, rows)).observe(after, rows)
        if partition_by:
            out.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)
        else:
            out.write.mode("overwrite").parquet(path)
        n, kept = before.get["rows"], after.get["rows"]
        self.rows.append((entity, n, kept, n - kept))
        return self.spark.read.parquet(path)

    def report(self) -> DataFrame:
        """One row for each step (the rows of the report are all that the driver holds)."""
        return self.spark.createDataFrame(self.rows, STEP_SCHEMA)


def metrics(*parts: DataFrame) -> DataFrame:
    """Stack one-row (metric, value) frames into one report."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def as_metrics(row: DataFrame) -> DataFrame:
    """The columns of a one-row aggregate as (metric, value) rows."""
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value"))
                                         for c in row.columns])))


def duplicate_reservations(parsed_valid: DataFrame, deduped: DataFrame) -> DataFrame:
    """Q03: duplicates by id (resolved by W02) and content duplicates under new
    ids (same row apart from res_id and created_at), as (metric, value)."""
    content_cols = [c for c in deduped.columns if c not in ("res_id", "created_at")]
    content = deduped.groupBy(*content_cols).agg(F.count(F.lit(1)).alias("n"))
    after = content.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_after_dedup"),
                        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("content_duplicates"))
    before = parsed_valid.agg(F.count(F.lit(1)).alias("rows_before_dedup"))
    return as_metrics(before).unionByName(as_metrics(after))


def overbooked_slots(calendar: DataFrame) -> DataFrame:
    """Q04: (hotel, room, date) slots with more than one booking."""
    return calendar.agg(F.count_if("is_overbooked").alias("overbooked_slots"),
                        F.count(F.lit(1)).alias("booked_slots"))


def null_critical(bronze_res: DataFrame) -> DataFrame:
    """Q06: NULLs in the critical reservation fields, one row."""
    cols = ["res_id", "guest_id", "hotel_id", "room_number", "check_in_date", "check_out_date", "total_price",
            "created_at"]
    return bronze_res.agg(F.count(F.lit(1)).alias("rows"),
                          *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def fk_violations(orphans: DataFrame, unknown_rooms: DataFrame) -> DataFrame:
    """Q07: foreign-key violations by kind; a kind without any reports 0."""
    found = orphans.select(F.col("orphan_reason").alias("kind"), F.lit(1).alias("n")).unionByName(
        unknown_rooms.select(F.lit("room").alias("kind"), F.lit(1).alias("n")))
    kinds = orphans.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, ("guest", "hotel", "room")))).alias("kind"), F.lit(0).alias("n"))
    return found.unionByName(kinds).groupBy("kind").agg(F.sum("n").alias("violations"))


def metric_out_of_range(revpar: DataFrame, lo: float = REVPAR_RANGE[0], hi: float = REVPAR_RANGE[1]) -> DataFrame:
    """Q08: KPI rows outside the plausible band."""
    return revpar.filter((F.col("revpar") < lo) | (F.col("revpar") > hi)).select("date", "hotel_id", "revpar")


def dimension_totals(dim: DataFrame) -> DataFrame:
    """Q09: rows, guests, current and historical rows."""
    return dim.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct("guest_id").alias("unique_guests"),
                   F.count_if("is_current").alias("current_rows"),
                   F.count_if(~F.col("is_current")).alias("historical_rows"))


def latest_load(stays: DataFrame) -> DataFrame:
    """Q12: latest record creation time in the stays fact."""
    return stays.agg(F.max("created_at").alias("latest_created_at"), F.count(F.lit(1)).alias("rows"))


def table_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """Q11: row count per saved table; a missing table is reported with NULL."""
    rows = []
    for n in names:
        if spark.catalog.tableExists(n):
            rows.append(spark.table(n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows"))
        else:
            rows.append(spark.range(1).select(F.lit(n).alias("table"), F.lit(None).cast("long").alias("rows")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


# Fixed classification patterns for the dirty-input profile (Q13).
DATE_SHAPES = (("^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"),
               ("^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "nn/nn/yyyy"),
               ("^[0-9]{2}-[0-9]{2}-[0-9]{4}$", "MM-dd-yyyy"))


def _shape(col: str) -> F.Column:
    c = F.col(col)
    expr = F.when(c.isNull(), F.lit("null"))
    for pattern, label in DATE_SHAPES:
        expr = expr.when(c.rlike(pattern), F.lit(label))
    return expr.otherwise(F.lit("other"))


def dirty_profile(bronze_res: DataFrame) -> DataFrame:
    """Q13: share of each raw shape per field: date formats, sentinels, code
    case variants and price sign, as (field, shape, n)."""
    room_type_canon = C.canonical_room_type("room_type")
    rt = (F.when(F.col("room_type").isNull(), "null")
          .when(F.col("room_type") == room_type_canon, "canonical")
          .when(F.upper("room_type") == F.upper(room_type_canon), "case_variant").otherwise("unknown_code"))
    price = (F.when(F.col("total_price").isNull(), "null").when(F.col("total_price") <= 0, "non_positive")
             .when(F.col("total_price") >= 10000, "too_high").otherwise("in_range"))
    room = (F.when(F.col("room_number").isNull(), "null")
            .when(F.col("room_number") == C.INVALID_ROOM_SENTINEL, "sentinel").otherwise("value"))
    created = (F.when(F.col("created_at").isNull(), "null")
               .when(C.parse_ts_multi("created_at").isNull(), "unparseable").otherwise("parseable"))
    shapes = F.array(
        F.struct(F.lit("check_in_date").alias("field"), _shape("check_in_date").alias("shape")),
        F.struct(F.lit("check_out_date").alias("field"), _shape("check_out_date").alias("shape")),
        F.struct(F.lit("room_type").alias("field"), rt.alias("shape")),
        F.struct(F.lit("total_price").alias("field"), price.alias("shape")),
        F.struct(F.lit("room_number").alias("field"), room.alias("shape")),
        F.struct(F.lit("created_at").alias("field"), created.alias("shape")))
    return (bronze_res.select(F.inline(shapes)).groupBy("field", "shape")
            .agg(F.count(F.lit(1)).alias("n")))
