"""End-to-end batch run: bronze JSON folders -> silver and gold tables.

    python -m hostelry.plans.pipeline BRONZE_DIR OUT_DIR

``BRONZE_DIR`` holds one folder of JSON-lines files per entity
(``guests``, ``hotel_inventory``, ``reservations``, ``pos_transactions``,
``housekeeping_logs``). Tables are written as Parquet folders under
``OUT_DIR/silver`` and ``OUT_DIR/gold``; the quality report goes to
``OUT_DIR/quality``. Silver tables are written first and read back, so each
gold table starts from stored silver data rather than re-running the
cleaning (this also cuts the lineage a lost executor would replay).
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from ..session import build_session
from ..sources.landing import LandedBronze
from ..sources.tables import compact_clustered
from . import gold, quality, silver


def run_batch(spark: SparkSession, bronze_dir: str, out_dir: str) -> dict[str, str]:
    b = LandedBronze(spark, bronze_dir)
    out = out_dir.rstrip("/")
    paths: dict[str, str] = {}
    steps = quality.StepCounts(spark)

    def path(layer: str, name: str) -> str:
        paths[name] = f"{out}/{layer}/{name}"
        return paths[name]

    def save(layer: str, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(path(layer, name))
        return spark.read.parquet(paths[name])

    # silver: each table is counted while it is written
    dim = steps.write("guests", b.guests, silver.dim_guests_batch, path("silver", "dim_guests"))
    res = steps.write("reservations", b.reservations, silver.clean_reservations, path("silver", "clean_reservations"))
    stays = steps.write("fact_stays_unified", res,
                        lambda d: silver.fact_stays_unified(d, silver.clean_pos(b.pos), dim, b.inventory),
                        path("silver", "fact_stays_unified"), "check_in_date")
    save("silver", "fact_room_availability_written", silver.fact_room_availability_daily(res))
    compact_clustered(spark, paths.pop("fact_room_availability_written"), path("silver", "fact_room_availability_daily"), ["date", "hotel_id"])
    cal = spark.read.parquet(paths["fact_room_availability_daily"])

    # gold: the nights are made once, and five KPIs read the stored measures
    measures = save("gold", "nightly_measures", gold.nightly_measures(stays))
    rooms = save("gold", "rooms_by_day", gold.rooms_by_day(cal))
    save("gold", "kpi_revpar", gold.kpi_revpar(measures, rooms))
    save("gold", "kpi_adr", gold.kpi_adr(measures))
    save("gold", "kpi_ancillary_attachment_rate", gold.kpi_ancillary(measures))
    save("gold", "kpi_housekeeping_turnover_time", gold.kpi_housekeeping_turnover(
        silver.checkout_events(b.reservations), silver.clean_housekeeping(b.housekeeping)))
    save("gold", "kpi_weekend_vs_weekday_revenue", gold.kpi_weekend_vs_weekday(measures, rooms))
    save("gold", "kpi_executive_dashboard", gold.kpi_dashboard(measures, rooms))

    save("quality", "step_counts", steps.report())
    save("quality", "overbooked_slots", quality.overbooked_slots(cal))
    save("quality", "dimension_totals", quality.dimension_totals(dim))
    return paths


def main(argv: list[str]) -> None:
    if len(argv) != 2:
        raise SystemExit(__doc__)
    spark = build_session()
    for name, path in run_batch(spark, argv[0], argv[1]).items():
        print(name, path)


if __name__ == "__main__":
    main(sys.argv[1:])
