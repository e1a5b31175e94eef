"""Catalog tables and sinks."""
import tempfile


from hostelry import schemas
from hostelry.plans import quality, silver
from hostelry.plans.queries import Bronze
from hostelry.sources import json_io, tables
from hostelry.streaming import incremental
from conftest import SF001


def test_table_lifecycle(spark):
    b = Bronze(spark, SF001)
    res = silver.clean_reservations(b.reservations)
    name = "hx_test_res"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not tables.table_exists(spark, name)
    tables.overwrite_table(res, name)
    assert tables.table_exists(spark, name)
    n = tables.table_scan(spark, name).count()
    tables.append_table(res.limit(5), name)
    assert tables.table_scan(spark, name).count() == n + 5
    tables.overwrite_partitioned(res, name + "_p", "check_in_date")
    assert tables.table_scan(spark, name + "_p").count() == n
    rep = {r["table"]: r["rows"] for r in quality.table_counts(spark, [name, "hx_missing"]).collect()}
    assert rep == {name: n + 5, "hx_missing": None}


def test_compaction_clusters_by_two_keys_at_once(spark):
    """A filter on either column alone skips most files and row groups, which plain sorting gives for the first only."""
    import glob

    import pyarrow.parquet as pq
    base = tempfile.mkdtemp(prefix="compact-", dir="/tmp")
    df = spark.range(60_000).selectExpr("CAST(id * 7919 % 1009 AS BIGINT) AS a", "date_add(DATE'2024-01-01', CAST(id * 104729 % 367 AS INT)) AS d",
                                        "CASE WHEN id % 50 = 0 THEN NULL ELSE concat('room', lpad(CAST(id * 31 % 500 AS STRING), 3, '0')) END AS r", "id")
    df.repartition(150).write.parquet(base + "/small")
    size = tables.stored_bytes(spark.read.parquet(base + "/small"))

    def read_share(path, col, value):
        """Share of the row groups whose statistics may hold the value."""
        hit = every = 0
        for f in glob.glob(path + "/*.parquet"):
            m = pq.ParquetFile(f).metadata
            at = m.schema.to_arrow_schema().get_field_index(col)
            for g in range(m.num_row_groups):
                st = m.row_group(g).column(at).statistics
                every += 1
                hit += st is None or not st.has_min_max or st.min <= value <= st.max
        return hit / every
    import datetime as dt
    tables.compact_clustered(spark, base + "/small", base + "/curve", ["a", "d"], size // 64)
    assert 50 <= len(glob.glob(base + "/curve/*.parquet")) <= 80 < len(glob.glob(base + "/small/*.parquet"))  # files by bytes
    assert read_share(base + "/curve", "a", 200) <= 0.3 and read_share(base + "/curve", "d", dt.date(2024, 4, 20)) <= 0.3
    tables.write_sorted(df, base + "/sorted", ["a", "d"], 64)
    assert read_share(base + "/sorted", "a", 200) <= 0.1 and read_share(base + "/sorted", "d", dt.date(2024, 7, 1)) == 1
    tables.compact_clustered(spark, base + "/small", base + "/text", ["r", "d"], size // 64)
    assert read_share(base + "/text", "d", dt.date(2024, 4, 20)) <= 0.3 and read_share(base + "/text", "r", "room120") <= 0.3
    for kind in ("curve", "text"):
        back = spark.read.parquet(f"{base}/{kind}")
        assert back.exceptAll(df).count() == 0 and back.count() == df.count()
    df.limit(0).write.parquet(base + "/none")
    tables.compact_clustered(spark, base + "/none", base + "/none_curve", ["a", "d"])
    assert spark.read.parquet(base + "/none_curve").count() == 0


def test_compacted_files_are_bounded_by_rows(spark, monkeypatch):
    """Rows that store well make few bytes, but the task that sorts a file holds them at full size."""
    import glob

    import pyarrow.parquet as pq
    base = tempfile.mkdtemp(prefix="rows-", dir="/tmp")
    df = spark.range(4000).selectExpr("id % 7 as a", "date_add(date'2024-01-01', cast(id % 90 as int)) as d")
    df.write.parquet(base + "/in")
    monkeypatch.setattr(tables, "FILE_ROWS", 500, raising=False)
    tables.compact_clustered(spark, base + "/in", base + "/out", ["a", "d"])
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(base + "/out/*.parquet")]
    assert len(sizes) == 8 and max(sizes) <= 1000 and sum(sizes) == 4000


def test_kept_tables_are_given_back(spark):
    from hostelry.plans.queries import QUERIES
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    QUERIES["persisted_reuse"](spark, SF001)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_stream_to_table(spark):
    base = tempfile.mkdtemp(prefix="s2t-", dir="/tmp")
    g = Bronze(spark, SF001).guests
    json_io.chunked_json_sink(g, base + "/src", 50)
    spark.sql("DROP TABLE IF EXISTS hx_stream_guests")
    cleaned = silver.clean_guests(incremental.json_stream(spark, base + "/src", schemas.GUESTS))
    q = incremental.stream_to_table(cleaned.dropDuplicates(["guest_id"]), "hx_stream_guests", base + "/ckpt")
    incremental.run_available_now(q)
    assert spark.table("hx_stream_guests").count() == g.count()
