"""Landed bronze: the raw entity folders as JSON-lines files (the layout the
pipelines read in production), written once from the driver-table views."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from . import driver_views, json_io

# entity folder -> (view function, declared schema)
ENTITIES = {
    "guests": (driver_views.bronze_guests, schemas.GUESTS),
    "guest_changes": (driver_views.guest_change_log, schemas.GUEST_CHANGES),
    "hotel_inventory": (driver_views.bronze_inventory, schemas.INVENTORY),
    "reservations": (driver_views.bronze_reservations, schemas.RESERVATIONS),
    "pos_transactions": (driver_views.bronze_pos, schemas.POS),
    "housekeeping_logs": (driver_views.bronze_housekeeping, schemas.HOUSEKEEPING),
}
MARKER = "reservations"


def land_bronze(spark: SparkSession, sf_dir: str, out_dir: str, records_per_file: int = 50_000) -> str:
    """Write every bronze entity as JSON-lines files of bounded size."""
    for name, (view, _) in ENTITIES.items():
        json_io.chunked_json_sink(view(spark, sf_dir), f"{out_dir.rstrip('/')}/{name}", records_per_file)
    return out_dir


def is_landed(path: str) -> bool:
    return os.path.isdir(os.path.join(path, MARKER))


class LandedBronze:
    """Same accessors as ``driver_views.Bronze``, reading the landed files
    with their declared schemas (S01)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _scan(self, name: str) -> DataFrame:
        return json_io.json_scan(self.spark, f"{self.path}/{name}", ENTITIES[name][1])

    guests = property(lambda self: self._scan("guests"))
    guest_changes = property(lambda self: self._scan("guest_changes"))
    inventory = property(lambda self: self._scan("hotel_inventory"))
    reservations = property(lambda self: self._scan("reservations"))
    pos = property(lambda self: self._scan("pos_transactions"))
    housekeeping = property(lambda self: self._scan("housekeeping_logs"))
