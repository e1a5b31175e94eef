"""Distinct counts and medians at roll-up scale (A07, A11): states that are stored by day
and added up for any range of days, without the rows behind them.

* distinct guests: HyperLogLog sketches (relative error about 1.6 % at 2^12 registers);
* median folio amount: KLL quantile sketches (rank error below 1.7 % at k = 200);
* median turnover: exact, as a day's histogram of whole-second durations is bounded by
  the turnover cap and histograms add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gold

LOG_REGISTERS, KLL_K = 12, 200
#: Errors that the checks allow: three standard deviations of the count, and of the rank.
COUNT_ERROR, RANK_ERROR = 0.05, 0.025


def write_day_states(stays: DataFrame, checkouts: DataFrame, cleanings: DataFrame, path: str) -> None:
    """The states of each (day, hotel): of stays by check-in day under ``path/stays``, and
    turnover histograms by check-out day under ``path/turnover``."""
    stays.groupBy(F.col("check_in_date").alias("date"), "hotel_id").agg(
        F.count(F.lit(1)).alias("stays"), F.hll_sketch_agg("guest_id", F.lit(LOG_REGISTERS)).alias("guests"),
        F.kll_sketch_agg_double("total_folio_amount", F.lit(KLL_K)).alias("folio")).write.mode("overwrite").parquet(f"{path}/stays")
    gold.turnover_histogram(checkouts, cleanings).withColumnRenamed("check_out_date", "date").write.mode("overwrite").parquet(f"{path}/turnover")


def _month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_trunc("month", F.col("date")).cast("date"))


def months(spark: SparkSession, path: str) -> DataFrame:
    """(month, hotel_id, stays, guests, folio_median, turnovers, turnover_median) from the stored day states alone."""
    by = ["month", "hotel_id"]
    s = _month(spark.read.parquet(f"{path}/stays")).groupBy(*by).agg(
        F.sum("stays").alias("stays"), F.hll_sketch_estimate(F.hll_union_agg("guests")).alias("guests"),
        F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("folio"), F.lit(0.5)).alias("folio_median"))
    t = gold.turnover_stats(_month(spark.read.parquet(f"{path}/turnover")), by).select(
        *by, F.col("total_checkouts").alias("turnovers"), F.col("median_turnover_time_minutes").alias("turnover_median"))
    return s.join(t, by, "full_outer")


def months_checked(found: DataFrame, stays: DataFrame) -> DataFrame:
    """The same with the exact number of guests, and whether the sketches keep their errors: the
    estimate near the exact number, and half of the stays on either side of the median."""
    by = ["month", "hotel_id"]
    rows = _month(stays.select(F.col("check_in_date").alias("date"), "hotel_id", "guest_id", "total_folio_amount"))
    exact = rows.join(found.select(*by, "folio_median"), by).groupBy(*by).agg(
        F.countDistinct("guest_id").alias("exact_guests"), F.count("total_folio_amount").alias("n"),
        F.count_if(F.col("total_folio_amount") < F.col("folio_median")).alias("below"),
        F.count_if(F.col("total_folio_amount") <= F.col("folio_median")).alias("upto"))
    slack = F.greatest(F.lit(1.0), F.col("n") * RANK_ERROR)
    j = found.join(exact, by, "left")
    return j.select(*by, "stays", "exact_guests", "turnovers", "turnover_median",
                    (F.abs(F.col("guests") - F.col("exact_guests")) <= F.greatest(F.lit(1.0), F.col("exact_guests") * COUNT_ERROR)).alias("guests_near"),
                    ((F.col("below") <= F.col("n") / 2 + slack) & (F.col("upto") >= F.col("n") / 2 - slack)).alias("median_near"))
