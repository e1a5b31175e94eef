"""Hotel orphans, which the derived views never hold."""
from hostelry.plans import analyst, quality


def test_unknown_hotels_are_reported(spark):
    stays = spark.createDataFrame([(1, 1, 1), (2, 1, 9), (3, 7, 9), (4, 7, 1), (5, 1, 9)], "res_id long, guest_id long, hotel_id long")
    found = analyst.orphan_stays(stays, spark.createDataFrame([(1,)], "guest_id long"), spark.createDataFrame([(1,), (1,)], "hotel_id long"))
    assert sorted((r.res_id, r.orphan_reason) for r in found.collect()) == [(2, "hotel"), (3, "guest"), (3, "hotel"), (4, "guest"), (5, "hotel")]
    kinds = quality.fk_violations(found, stays.limit(0).select("res_id"))
    assert {r.kind: r.violations for r in kinds.collect()} == {"guest": 2, "hotel": 3, "room": 0}
