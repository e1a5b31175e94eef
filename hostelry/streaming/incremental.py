"""Incremental loads with Structured Streaming (catalogue S02, S13-S15, T01-T04,
P02, P04).

A file stream picks up only JSON files its checkpoint has not seen. Each
micro-batch leaves one folder, named after (stream id, batch id) (``sources.batches``):
Spark replays a failed batch with the same ids and files, which overwrites that folder. The
present state is an aggregation over the keyed rows of all folders. Nothing of what a batch did not
touch is read again or rewritten, and files that come late, twice or in another order
give the same state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import scd2
from ..plans import silver
from ..sources import json_io, tables
from ..sources.batches import FILE, once_per_file, read_batches, write_batch

BatchFn = Callable[[DataFrame, int, str], None]


def json_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental JSON-lines file source with a declared schema, and the file of each row."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path).select("*", F.col("_metadata.file_path").alias(FILE))


def foreach_batch_sink(stream: DataFrame, fn: BatchFn, checkpoint: str) -> "StreamingQuery":
    """S13 + S14: run ``fn(batch, batch id, stream id)`` on each non-empty
    micro-batch, draining every pending file and then stopping
    (``availableNow``). The stream id lives in the checkpoint: a restart keeps
    it, a new or deleted checkpoint makes another."""
    def guarded(df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():          # S13 empty-batch guard
            return
        fn(df, batch_id, df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))
    return (stream.writeStream.foreachBatch(guarded).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_available_now(query: "StreamingQuery") -> None:
    """Block until the drained stream stops; surface its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def stream_to_table(stream: DataFrame, name: str, checkpoint: str) -> "StreamingQuery":
    """Append a cleaned stream straight to a table."""
    return (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .toTable(name))


# ----------------------------------------------------------------- T01 / P02
DIM_SCHEMA = schemas._schema(
    ("guest_sk", T.StringType()), ("guest_id", T.LongType()), ("name", T.StringType()), ("email", T.StringType()),
    ("loyalty_tier", T.StringType()), ("country", T.StringType()), ("registration_date", T.DateType()), ("valid_from", T.TimestampType()),
    ("valid_to", T.TimestampType()), ("is_current", T.BooleanType()), ("version", T.LongType()))
NTH = T.StructField("nth", T.LongType())  # number of the write, over all streams


def _newest(rows: DataFrame, key: str) -> DataFrame:
    """The rows of each key's newest write."""
    last = rows.groupBy(F.col(key).alias("_key")).agg(F.max("nth").alias("_nth"))
    return rows.join(last, (F.col(key) == F.col("_key")) & (F.col("nth") == F.col("_nth")), "left_semi")


def guests_dimension(spark: SparkSession, path: str) -> DataFrame:
    """The SCD2 dimension that ``guests_batch_fn`` keeps at ``path``."""
    rows = read_batches(spark, path, T.StructType([*DIM_SCHEMA.fields, NTH]))
    return _newest(rows, "guest_id").select(*scd2.DIM_COLUMNS)


def guests_batch_fn(path: str, type1_cols=(), reject_out_of_order: bool = False,
                    processing_time: Column | None = None) -> BatchFn:
    """foreachBatch body for the SCD2 guest dimension (P02 / T01): only the
    rows of the batch's guests are read and written."""
    def fn(batch: DataFrame, batch_id: int, stream: str) -> None:
        latest = silver.latest_guests(silver.clean_guests(batch))
        others = read_batches(batch.sparkSession, path, T.StructType([*DIM_SCHEMA.fields, NTH]), but=(stream, batch_id))
        nth = (others.agg(F.max("nth")).first()[0] or 0) + 1
        known = _newest(others.join(latest.select("guest_id"), "guest_id", "left_semi"), "guest_id").select(*scd2.DIM_COLUMNS)
        new = scd2.scd2_apply_batch(known, latest, type1_cols=type1_cols, reject_out_of_order=reject_out_of_order,
                                    processing_time=processing_time)
        write_batch(new.withColumn("nth", F.lit(nth).cast("long")), path, stream, batch_id)
    return fn


# ------------------------------------------------ T01 / T04: changes at any time
HISTORY_SCHEMA = schemas._schema(("guest_id", T.LongType()), ("updated_at", T.TimestampNTZType()), ("loyalty_tier", T.StringType()),
                                 ("change_seq", T.LongType()), ("valid_to", T.TimestampNTZType()), ("version", T.LongType()))


def _change_rows(rows: DataFrame) -> DataFrame:
    """One row for each change out of all that were written for it. A change that comes
    between others never lowers a later version and only shortens the interval it
    falls into, so the newest write has the highest version and the earliest end."""
    return rows.groupBy("guest_id", "updated_at", "loyalty_tier", "change_seq").agg(
        F.min("valid_to").alias("valid_to"), F.max("version").alias("version"))


def guest_history(spark: SparkSession, path: str) -> DataFrame:
    """The versions that ``history_batch_fn`` keeps at ``path``, as ``silver.scd2_history`` gives them."""
    return silver.history_columns(_change_rows(read_batches(spark, path, HISTORY_SCHEMA)))


def history_batch_fn(path: str) -> BatchFn:
    """foreachBatch body for a history of tier changes that come in any order (T01, T04): of
    the batch's guests, the intervals its changes fall into are split and what follows is numbered anew.
    Changes that the history has, as when files are read again, change nothing and go first. The others and
    the history of their guests are used several times, so they are kept while the batch is written."""
    def fn(batch: DataFrame, batch_id: int, stream: str) -> None:
        others = read_batches(batch.sparkSession, path, HISTORY_SCHEMA, but=(stream, batch_id))
        seen = others.select(F.col("guest_id").alias("_guest"), F.col("change_seq").alias("_seq"))
        same = (F.col("guest_id") == F.col("_guest")) & F.col("change_seq").eqNullSafe(F.col("_seq"))
        new = tables.persist_reuse(batch.filter("guest_id is not null").join(seen, same, "left_anti"))
        known = tables.persist_reuse(_change_rows(others.join(new.select("guest_id").distinct(), "guest_id", "left_semi")))
        try:
            rows = scd2.scd2_merge_changes(known, new)
            write_batch(rows.select(*HISTORY_SCHEMA.fieldNames()), path, stream, batch_id)
        finally:
            known.unpersist()
            new.unpersist()
    return fn


# ----------------------------------------------------------------- T02 / P04 / T04
RESERVATION_SCHEMA = schemas._schema(
    ("res_id", T.LongType()), ("guest_id", T.LongType()), ("hotel_id", T.LongType()), ("room_number", T.StringType()),
    ("room_type", T.StringType()), ("check_in_date", T.DateType()), ("check_out_date", T.DateType()), ("total_price", T.DoubleType()),
    ("booking_channel", T.StringType()), ("created_at", T.TimestampType()))
POS_SCHEMA = schemas._schema(("txn_id", T.LongType()), ("res_id", T.LongType()), ("item_name", T.StringType()), ("category", T.StringType()),
                             ("amount", T.DoubleType()), ("timestamp", T.TimestampType()), (FILE, T.StringType()))
TOTALS_SCHEMA = schemas._schema(("res_id", T.LongType()), ("total_pos_amount", T.DoubleType()), ("pos_item_count", T.LongType()))


def reservations_batch_fn(base: str) -> BatchFn:
    """foreachBatch body of the reservation stream (P04 / T02): the batch's cleaned rows."""
    def fn(batch: DataFrame, batch_id: int, stream: str) -> None:
        write_batch(silver.clean_reservations(batch).select(*RESERVATION_SCHEMA.fieldNames()), f"{base}/reservations", stream, batch_id)
    return fn


def pos_batch_fn(base: str) -> BatchFn:
    """foreachBatch body of the POS stream (T02 / T04): the batch's charges are kept, and the
    totals of the reservations they belong to, however old these are, are taken again from all
    their charges. Charges of a file count once, so files that are read again change nothing."""
    def fn(batch: DataFrame, batch_id: int, stream: str) -> None:
        spark = batch.sparkSession
        write_batch(silver.clean_pos(batch, also=[FILE]).select(*POS_SCHEMA.fieldNames()), f"{base}/pos", stream, batch_id)
        every = read_batches(spark, f"{base}/pos", POS_SCHEMA)
        touched = every.filter((F.col("stream") == stream) & (F.col("batch") == batch_id)).select("res_id").distinct()
        rows = once_per_file(every).join(touched, "res_id", "left_semi")
        write_batch(silver.pos_by_reservation(rows).select(*TOTALS_SCHEMA.fieldNames()), f"{base}/totals", stream, batch_id)
    return fn


def stays(spark: SparkSession, base: str, dim_guests: DataFrame, raw_inventory: DataFrame) -> DataFrame:
    """The folio fact of what both streams have brought: of each reservation the row created
    last (late corrections win by their time, T04) with the totals over the most charges."""
    res = silver.latest_reservations(read_batches(spark, f"{base}/reservations", RESERVATION_SCHEMA).drop("stream", "batch"))
    best = F.max(F.struct("pos_item_count", "total_pos_amount")).alias("t")
    totals = read_batches(spark, f"{base}/totals", TOTALS_SCHEMA).groupBy("res_id").agg(best).select("res_id", "t.*")
    return silver.known_stays(silver.fact_stays(res, totals), dim_guests, raw_inventory)


# ------------------------------------------------ S03-S05 on S02: schema evolution and rescue
def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S02 without a schema: the raw lines of the files."""
    r = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else spark.readStream
    return r.text(path)


def evolving_batch_fn(path: str, pinned: T.StructType) -> BatchFn:
    """foreachBatch body that lets a feed's schema grow (S03-S05). The first batch pins ``pinned`` as
    version 0. Keys that a batch has and the newest version lacks make a further version
    with these as text columns at the end, kept beside the data; the batch's lines are then read with it. What
    does not fit (broken lines, values of another type) is kept in ``_rescued``."""
    def fn(batch: DataFrame, batch_id: int, stream: str) -> None:
        spark = batch.sparkSession
        lines = batch.select("value")
        version, schema = schema_version(spark, path)
        if schema is None:
            version, schema = 0, pinned
            json_io.store_schema(spark, schema, f"{path}/schema/version=0")
        grown = json_io.evolve_schema(lines, schema)
        if len(grown.fields) > len(schema.fields):
            version, schema = version + 1, grown
            json_io.store_schema(spark, schema, f"{path}/schema/version={version}")
        rows = json_io.rescue_malformed(lines, schema).withColumn("schema_version", F.lit(version))
        write_batch(rows, f"{path}/rows", stream, batch_id)
    return fn


def schema_version(spark: SparkSession, path: str) -> tuple[int, T.StructType | None]:
    """Number and schema of the newest version; (-1, None) before the first. A version that a
    replayed batch finds has its keys already, so it makes no other."""
    found = json_io.stored_schemas(spark, f"{path}/schema")
    return (-1, None) if not found else max(found.items())


def evolved_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows under the newest schema; a column is null in rows from before it was known."""
    _, schema = schema_version(spark, path)
    extra = [T.StructField(json_io.RESCUED, T.StringType()), T.StructField("schema_version", T.IntegerType())]
    return read_batches(spark, f"{path}/rows", T.StructType([*schema.fields, *extra])).drop("stream", "batch")


def profile_updates(guests: DataFrame, every: int = 7, at: str = "2024-06-01T00:00:00Z") -> DataFrame:
    """A later drop of guest files: every ``every``-th guest changes tier
    (Gold, or Silver for current Gold members) at ``at``. Derived from the
    given guests so it grows with them."""
    tier = F.upper(F.coalesce(F.col("loyalty_tier"), F.lit("")))
    return (guests.filter(F.col("guest_id") % every == 0)
            .withColumn("loyalty_tier", F.when(tier == "GOLD", F.lit("Silver")).otherwise(F.lit("Gold")))
            .withColumn("updated_at", F.lit(at)))


def profile_corrections(guests: DataFrame) -> DataFrame:
    """A later drop mixing three kinds of rows: tier changes (every 7th guest),
    name corrections with the tier unchanged (every 11th), and stale tier
    changes dated before the guest's registration in the system (every 13th)."""
    k = F.col("guest_id")
    tier = F.upper(F.coalesce(F.col("loyalty_tier"), F.lit("")))
    changes = profile_updates(guests)
    names = (guests.filter((k % 11 == 0) & (k % 7 != 0))
             .withColumn("name", F.upper(F.coalesce(F.col("name"), F.lit("unknown"))))
             .withColumn("updated_at", F.lit("2024-06-01T00:00:00Z")))
    stale = (guests.filter((k % 13 == 0) & (k % 7 != 0) & (k % 11 != 0))
             .withColumn("loyalty_tier", F.when(tier == "PLATINUM", F.lit("Bronze")).otherwise(F.lit("Platinum")))
             .withColumn("updated_at", F.lit("2020-01-01T00:00:00Z")))
    return changes.unionByName(names).unionByName(stale)
