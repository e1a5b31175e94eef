"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import pytest

import __spark_entry__ as E
from sqloracle.compare import compare, duck
from conftest import SF001
from hostelry.plans.queries import QUERIES

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLE, f"{name} has no oracle SQL"
    res = compare(E.queries()[name](spark, SF001), con, ORACLE[name])
    assert res["ok"], res


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "hotel_id", "total_room_revenue", "rooms_sold", "adr"]
    assert df.count() > 0
