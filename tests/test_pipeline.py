"""End-to-end batch run over landed bronze JSON equals the registered queries."""
import tempfile

from hostelry.plans.pipeline import run_batch
from hostelry.plans.queries import QUERIES
from hostelry.sources.landing import land_bronze
from conftest import SF001


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_batch_run_matches_queries(spark):
    work = tempfile.mkdtemp(prefix="pipe-", dir="/tmp")
    landed = land_bronze(spark, SF001, work + "/bronze", 500)
    paths = run_batch(spark, landed, work + "/out")
    for name in ("kpi_revpar", "kpi_adr", "kpi_executive_dashboard", "kpi_housekeeping_turnover_time"):
        assert _same(spark.read.parquet(paths[name]), QUERIES[name](spark, SF001)), name
    stays = spark.read.parquet(paths["fact_stays_unified"])
    assert _same(stays, QUERIES["fact_stays_unified"](spark, SF001))
