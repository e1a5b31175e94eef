"""Incremental loads: drops in any order equal one batch; a replayed batch or a lost checkpoint changes nothing."""
import datetime as dt
import itertools
import tempfile

import pytest
from pyspark.sql import functions as F

from hostelry import schemas
from hostelry.plans import silver
from hostelry.plans.queries import Bronze
from hostelry.sources import json_io
from hostelry.sources.batches import once_per_file, read_batches
from hostelry.streaming import incremental
from conftest import SF001


def folder(name):
    return tempfile.mkdtemp(prefix=f"{name}-", dir="/tmp")


def rows(df):
    return sorted(map(repr, df.collect()))


def drain(spark, src, schema, fn, ckpt, files=None):
    incremental.run_available_now(incremental.foreach_batch_sink(incremental.json_stream(spark, src, schema, files), fn, ckpt))


def test_replayed_batch_is_idempotent(spark):
    b, path = Bronze(spark, SF001), folder("dim")
    fn = incremental.guests_batch_fn(path)
    fn(b.guests, 0, "s")
    first = rows(incremental.guests_dimension(spark, path))
    fn(b.guests, 0, "s")            # replay of batch 0
    assert rows(incremental.guests_dimension(spark, path)) == first
    upd = incremental.profile_updates(b.guests)
    fn(upd, 1, "s")
    second = rows(incremental.guests_dimension(spark, path))
    fn(upd, 1, "s")                 # replay of batch 1
    assert rows(incremental.guests_dimension(spark, path)) == second != first
    v1 = incremental.guests_dimension(spark, path)
    assert v1.filter(F.col("version") == 2).count() > 0
    assert v1.groupBy("guest_id").agg(F.count_if("is_current").alias("c")).filter(F.col("c") != 1).count() == 0
    written = read_batches(spark, path, v1.schema).filter("batch = 1").select("guest_id").distinct()
    touched = silver.latest_guests(silver.clean_guests(upd)).select("guest_id")
    assert written.exceptAll(touched).count() == 0  # only touched guests are written again


def test_guest_files_read_again_after_a_lost_checkpoint(spark):
    """Bronze in January and Gold in March, read again one file a micro-batch: two versions as before."""
    base = folder("again")
    one = ("A", "a@x.y", "N1", "2020-01-01")
    for tier, at in (("bronze", "2024-01-05T00:00:00Z"), ("gold", "2024-03-05T00:00:00Z")):
        df = spark.createDataFrame([(1, one[0], one[1], tier, one[2], one[3], at)], schemas.GUESTS)
        json_io.chunked_json_sink(df.coalesce(1), f"{base}/src", 10, mode="append")
        drain(spark, f"{base}/src", schemas.GUESTS, incremental.guests_batch_fn(f"{base}/dim"), f"{base}/c1", files=1)
    before = rows(incremental.guests_dimension(spark, f"{base}/dim"))
    assert len(before) == 2
    drain(spark, f"{base}/src", schemas.GUESTS, incremental.guests_batch_fn(f"{base}/dim"), f"{base}/c2", files=1)
    assert rows(incremental.guests_dimension(spark, f"{base}/dim")) == before


def test_stream_reads_only_new_files(spark):
    base = folder("stream")
    g = Bronze(spark, SF001).guests
    seen, streams = [], set()

    def fn(df, batch_id, stream):
        seen.append(df.count())
        streams.add(stream)
    for half in (0, 1):
        json_io.chunked_json_sink(g.filter(F.col("guest_id") % 2 == half), f"{base}/src", 100, mode="append")
        drain(spark, f"{base}/src", schemas.GUESTS, fn, f"{base}/ckpt")
    assert sum(seen) == g.count() and len(streams) == 1 and None not in streams
    drain(spark, f"{base}/src", schemas.GUESTS, fn, f"{base}/other")
    assert len(streams) == 2


def change_drops(spark):
    """Changes of four guests with equal times, missing times and runs of one tier, in three parts."""
    tiers = ["Bronze", "Silver", "Silver", "Gold", "Bronze", "Bronze", "Platinum", "Gold", "Gold", "Silver"]
    day = dt.datetime(2024, 1, 1)
    data = [(g, tiers[(i * (g + 3)) % 10], None if i == 9 and g == 2 else day + dt.timedelta(days=i * 7 // (g + 1)), g * 100 + i)
            for g in range(4) for i in range(10)]
    whole = spark.createDataFrame(data, schemas.GUEST_CHANGES)
    return whole, [whole.filter(F.col("change_seq") * 7 % 3 == k) for k in range(3)]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_changes_in_any_order_give_the_whole_history(spark, order):
    whole, parts = change_drops(spark)
    path = folder("history")
    fn = incremental.history_batch_fn(path)
    for n, k in enumerate(order):
        fn(parts[k], n, "s")
        if n == 1:
            fn(parts[k], n, "s")        # replayed
    want = rows(silver.scd2_history(whole))
    assert rows(incremental.guest_history(spark, path)) == want
    fn(parts[1], 0, "t")                # a lost checkpoint: read again in another order
    fn(parts[0].unionAll(parts[2]), 1, "t")
    assert rows(incremental.guest_history(spark, path)) == want


def test_late_change_touches_only_what_follows(spark):
    path = folder("late")
    fn = incremental.history_batch_fn(path)
    day = dt.datetime(2024, 1, 1)
    early = [(1, t, day + dt.timedelta(days=d), d) for d, t in ((0, "Bronze"), (10, "Silver"), (20, "Gold"), (30, "Gold"))]
    fn(spark.createDataFrame(early + [(2, "Gold", day, 99)], schemas.GUEST_CHANGES), 0, "s")
    fn(spark.createDataFrame([(1, "Platinum", day + dt.timedelta(days=15), 15)], schemas.GUEST_CHANGES), 1, "s")
    written = read_batches(spark, path, incremental.HISTORY_SCHEMA).filter("batch = 1")
    assert sorted(r.change_seq for r in written.collect()) == [10, 15, 20, 30]  # neither guest 2 nor the first version
    got = {r.valid_from.day: (r.version, r.valid_to and r.valid_to.day) for r in incremental.guest_history(spark, path).filter("guest_id = 1").collect()}
    assert got == {1: (1, 11), 11: (2, 16), 16: (3, 21), 21: (4, 31), 31: (4, None)}


def test_changes_read_again_leave_nothing(spark):
    whole, _ = change_drops(spark)
    path = folder("history")
    fn = incremental.history_batch_fn(path)
    fn(whole.filter("change_seq <> 105"), 0, "s")
    fn(whole, 0, "t")               # a lost checkpoint, and one change that came since
    fn(whole, 0, "u")
    again = read_batches(spark, path, incremental.HISTORY_SCHEMA)
    assert again.filter("stream = 't'").select("guest_id").distinct().collect() == [(1,)]
    assert again.filter("stream = 'u'").count() == 0
    assert rows(incremental.guest_history(spark, path)) == rows(silver.scd2_history(whole))


def test_totals_follow_late_charges(spark):
    """Charges before, after and without their reservation, equal charges in one file, files read again."""
    base = folder("pos")
    res = spark.createDataFrame([(i, 1, 1, "7", "suite", "2024-01-01", "2024-01-03", 100.0 * i, "ota", f"2023-12-0{i}T00:00:00Z") for i in (1, 2, 3)], schemas.RESERVATIONS)
    guests, hotels = spark.createDataFrame([(1,)], "guest_id long"), spark.createDataFrame([(1,)], "hotel_id long")

    def charge(txn, res_id, amount):
        return (txn, res_id, "tea", "food", amount, "2024-01-02T10:00:00Z")

    def add(*charges):
        json_io.chunked_json_sink(spark.createDataFrame(list(charges), schemas.POS).coalesce(1), f"{base}/src", 100, mode="append")
        drain(spark, f"{base}/src", schemas.POS, incremental.pos_batch_fn(f"{base}/t"), f"{base}/c1")

    def folio():
        return {r.res_id: (r.pos_item_count, r.total_pos_amount, r.total_folio_amount) for r in incremental.stays(spark, f"{base}/t", guests, hotels).collect()}
    assert folio() == {}
    add(charge(1, 1, 5.0), charge(1, 1, 5.0), charge(2, None, 9.0))  # equal charges are two; one has no reservation
    incremental.reservations_batch_fn(f"{base}/t")(res, 0, "r")
    assert folio() == {1: (2, 10.0, 110.0), 2: (0, 0.0, 200.0), 3: (0, 0.0, 300.0)}
    add(charge(3, 1, 1.0), charge(4, 3, 2.0))
    want = {1: (3, 11.0, 111.0), 2: (0, 0.0, 200.0), 3: (1, 2.0, 302.0)}
    assert folio() == want
    drain(spark, f"{base}/src", schemas.POS, incremental.pos_batch_fn(f"{base}/t"), f"{base}/c2", files=1)  # all files again
    assert folio() == want
    incremental.reservations_batch_fn(f"{base}/t")(res.withColumn("created_at", F.lit("2023-11-01T00:00:00Z")).withColumn("total_price", F.lit(1.0)), 1, "r")
    assert folio() == want  # an older correction that comes late does not win


def test_rows_of_files_read_again_count_once_without_a_shuffle_of_rows(spark):
    """Files read by several batches and streams, equal rows in a file, ids that are not in order of time."""
    read = {"a": [("t", 1), ("s", 10), ("s", 9)], "b": [("t", 0)], "c": [("s", 9), ("r", 12)]}
    df = spark.createDataFrame([(f, s, b, v) for f, by in read.items() for s, b in by for v in (1, 1, 2)], "_file string, stream string, batch long, v int")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for sizes that are not known before the run
    try:
        got = once_per_file(df)
        assert sorted(map(tuple, got.collect())) == [(f, s, b, v) for f, s, b in (("a", "s", 9), ("b", "t", 0), ("c", "r", 12)) for v in (1, 1, 2)]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_schema_grows_with_the_feed(spark):
    base = folder("evolve")
    fn = incremental.evolving_batch_fn(f"{base}/t", schemas._schema(("id", schemas._L), ("name", schemas._S)))

    def add(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{base}/src")
        stream = incremental.text_stream(spark, f"{base}/src", 1)
        incremental.run_available_now(incremental.foreach_batch_sink(stream, fn, f"{base}/c"))
    add('{"id": 1, "name": "a"}')
    add('{"id": 2, "vip": true}', '{"id": "x"}', "broken {")
    add('{"id": 3, "name": "c", "vip": "no", "age": 7}')
    add('{"id": 4}')
    df = incremental.evolved_rows(spark, f"{base}/t")
    assert df.columns == ["id", "name", "vip", "age", "_rescued", "schema_version"]
    got = {tuple(r) for r in df.collect()}
    assert got == {(1, "a", None, None, None, 0), (2, None, "true", None, None, 1), (None, None, None, None, '{"id":"x"}', 1),
                   (None, None, None, None, '{"_line":"broken {"}', 1), (3, "c", "no", "7", None, 2), (4, None, None, None, None, 2)}
    assert incremental.schema_version(spark, f"{base}/t")[0] == 2
    lines = spark.range(1100).select(F.format_string('{"k%d": 1}', "id").alias("value"))
    with pytest.raises(ValueError):
        json_io.unknown_keys(lines, schemas._schema(("id", schemas._L)))


def test_a_failing_batch_fails_the_stream(spark):
    base = folder("fail")
    json_io.chunked_json_sink(Bronze(spark, SF001).guests, f"{base}/src", 100)

    def fn(df, batch_id, stream):
        raise RuntimeError("no")
    with pytest.raises(Exception, match="no"):
        drain(spark, f"{base}/src", schemas.GUESTS, fn, f"{base}/c")


def test_rescue_and_evolution(spark):
    base = tempfile.mkdtemp(prefix="json-", dir="/tmp")
    lines = spark.createDataFrame([('{"guest_id": 1, "name": "A", "vip": "yes"}',), ('{"guest_id": "x"}',),
                                   ("not json",)], "value string")
    lines.write.mode("overwrite").text(base + "/g")
    narrow = schemas._schema(("guest_id", schemas._L), ("name", schemas._S))
    got = {r["_rescued"] for r in json_io.rescue_malformed(json_io.read_lines(spark, base + "/g"), narrow).collect()}
    assert got == {'{"vip":"yes"}', '{"guest_id":"x"}', '{"_line":"not json"}'}
    assert json_io.evolve_schema(json_io.read_lines(spark, base + "/g"), narrow).fieldNames() == ["guest_id", "name", "vip"]


def test_pin_schema_reused(spark):
    base = tempfile.mkdtemp(prefix="pin-", dir="/tmp")
    spark.createDataFrame([('{"a": 1}',)], "value string").write.text(base + "/d")
    s1 = json_io.pin_schema(spark, base + "/d", base + "/schema")
    spark.createDataFrame([('{"a": 1, "b": 2}',)], "value string").write.mode("append").text(base + "/d")
    s2 = json_io.pin_schema(spark, base + "/d", base + "/schema")
    assert s1 == s2 and s2.fieldNames() == ["a"]
