"""Named queries over the driver tables: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the hotel-shaped bronze views (``sources.driver_views``),
so its work grows with the given tables. The README maps catalogue IDs to
query names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import driver_views, landing
from ..operators import filters
from ..operators import joins as joins_mod
from . import gold, silver


def Bronze(spark: SparkSession, sf: str):
    """Bronze entities: landed JSON files when ``sf`` is a landing folder,
    else the views over the driver tables."""
    if landing.is_landed(sf):
        return landing.LandedBronze(spark, sf)
    return driver_views.Bronze(spark, sf)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ------------------------------------------------------------- shared silver steps
def _res(b: Bronze) -> DataFrame:
    return silver.clean_reservations(b.reservations)


def _pos(b: Bronze) -> DataFrame:
    return silver.clean_pos(b.pos)


def _dim(b: Bronze) -> DataFrame:
    return silver.dim_guests_batch(b.guests)


def _guest_ids(b: Bronze) -> DataFrame:
    """Ids in the guest dimension, without building its versions."""
    return silver.latest_guests(silver.clean_guests(b.guests)).select("guest_id").distinct()


def _stays(b: Bronze) -> DataFrame:
    return silver.fact_stays_unified(_res(b), _pos(b), _guest_ids(b), b.inventory)


def _calendar(b: Bronze) -> DataFrame:
    return silver.fact_room_availability_daily(_res(b))


# ------------------------------------------------------------------------- silver
@query
def guests_cleaned(spark, sf):
    return silver.clean_guests(Bronze(spark, sf).guests)


@query
def guests_latest(spark, sf):
    return silver.latest_guests(silver.clean_guests(Bronze(spark, sf).guests))


@query
def dim_guests_batch(spark, sf):
    return _dim(Bronze(spark, sf))


@query
def scd2_history(spark, sf):
    return silver.scd2_history(Bronze(spark, sf).guest_changes)


@query
def scd2_history_collapsed(spark, sf):
    return silver.scd2_history(Bronze(spark, sf).guest_changes, collapse=True)


@query
def clean_reservations(spark, sf):
    return _res(Bronze(spark, sf))


@query
def clean_pos(spark, sf):
    return _pos(Bronze(spark, sf))


@query
def clean_inventory(spark, sf):
    return silver.clean_inventory(Bronze(spark, sf).inventory)


@query
def clean_housekeeping(spark, sf):
    return silver.clean_housekeeping(Bronze(spark, sf).housekeeping)


@query
def checkout_events(spark, sf):
    return silver.checkout_events(Bronze(spark, sf).reservations)


@query
def pos_by_reservation(spark, sf):
    return silver.pos_by_reservation(_pos(Bronze(spark, sf)))


@query
def fact_stays_unified(spark, sf):
    return _stays(Bronze(spark, sf))


@query
def fact_room_availability_daily(spark, sf):
    return _calendar(Bronze(spark, sf))


@query
def fact_room_availability_raw(spark, sf):
    return silver.fact_room_availability_raw(Bronze(spark, sf).reservations)


# --------------------------------------------------------------------------- gold
@query
def kpi_revpar(spark, sf):
    b = Bronze(spark, sf)
    return gold.kpi_revpar(gold.nightly_measures(_stays(b)), gold.rooms_by_day(_calendar(b)))


@query
def kpi_adr(spark, sf):
    return gold.kpi_adr(gold.nightly_measures(_stays(Bronze(spark, sf))))


@query
def kpi_ancillary_attachment_rate(spark, sf):
    return gold.kpi_ancillary(gold.nightly_measures(_stays(Bronze(spark, sf))))


@query
def kpi_housekeeping_turnover_time(spark, sf):
    b = Bronze(spark, sf)
    return gold.kpi_housekeeping_turnover(silver.checkout_events(b.reservations),
                                          silver.clean_housekeeping(b.housekeeping))


@query
def kpi_weekend_vs_weekday_revenue(spark, sf):
    b = Bronze(spark, sf)
    return gold.kpi_weekend_vs_weekday(gold.nightly_measures(_stays(b)), gold.rooms_by_day(_calendar(b)))


@query
def kpi_executive_dashboard(spark, sf):
    b = Bronze(spark, sf)
    return gold.kpi_dashboard(gold.nightly_measures(_stays(b)), gold.rooms_by_day(_calendar(b)))


@query
def kpi_revpar_inventory_capacity(spark, sf):
    """D08 option: RevPAR and occupancy against inventory rooms."""
    b = Bronze(spark, sf)
    return gold.kpi_revpar_inventory(gold.nightly_measures(_stays(b)),
                                     gold.inventory_capacity(silver.clean_inventory(b.inventory)))


@query
def kpi_turnover_first_clean(spark, sf):
    """D10 option: one turnover per check-out (its first cleaning)."""
    b = Bronze(spark, sf)
    return gold.kpi_housekeeping_turnover(silver.checkout_events(b.reservations),
                                          silver.clean_housekeeping(b.housekeeping), first_clean_only=True)


@query
def kpi_ancillary_per_guest(spark, sf):
    """D11 option: attachment over distinct guests, POS spread over nights."""
    return gold.kpi_ancillary_per_guest(_stays(Bronze(spark, sf)))


@query
def kpi_revpar_validated(spark, sf):
    """D15 option: the calendar built from validated stays only, so RevPAR's
    revenue and capacity come from the same population."""
    b = Bronze(spark, sf)
    stays = _stays(b)
    res = joins_mod.keep_known(_res(b), stays, ["res_id"])
    return gold.kpi_revpar(gold.nightly_measures(stays), gold.rooms_by_day(silver.fact_room_availability_daily(res)))


@query
def fact_stays_survivor_map(spark, sf):
    """D05 option: reservations of guests merged away by dedup are re-pointed
    to the surviving guest before the orphan filter."""
    b = Bronze(spark, sf)
    res = silver.remap_guests(_res(b), silver.survivor_map(silver.clean_guests(b.guests)))
    return silver.fact_stays_unified(res, _pos(b), _guest_ids(b), b.inventory)


@query
def ancillary_by_category(spark, sf):
    b = Bronze(spark, sf)
    return gold.ancillary_by_category(_stays(b), _pos(b))


# ------------------------------------------------------------ analyses
from . import analyst, quality  # noqa: E402
from ..functions import clean as C  # noqa: E402


def _late(b: Bronze) -> DataFrame:
    return analyst.late_checkout_pos(_pos(b), _stays(b))


@query
def late_checkout_pos(spark, sf):
    return _late(Bronze(spark, sf))


@query
def late_checkout_analysis(spark, sf):
    return analyst.late_checkout_summary(_late(Bronze(spark, sf)))


@query
def late_pos_linked(spark, sf):
    b = Bronze(spark, sf)
    return analyst.link_late_pos(_late(b), _stays(b))


@query
def weekend_pricing_analysis(spark, sf):
    return analyst.weekend_pricing(_stays(Bronze(spark, sf)))


@query
def weekend_premium(spark, sf):
    return analyst.weekend_premium(_stays(Bronze(spark, sf)))


@query
def fuzzy_guest_match(spark, sf):
    return analyst.fuzzy_guest_match(silver.clean_guests(Bronze(spark, sf).guests))


@query
def fuzzy_name_links(spark, sf):
    return analyst.fuzzy_name_links(silver.clean_guests(Bronze(spark, sf).guests))


@query
def fuzzy_name_members(spark, sf):
    return analyst.fuzzy_name_members(silver.clean_guests(Bronze(spark, sf).guests))


@query
def guest_identities(spark, sf):
    return analyst.guest_identities(silver.clean_guests(Bronze(spark, sf).guests))


# ------------------------------------------------------------- summaries
@query
def stays_summary(spark, sf):
    return analyst.stays_averages(_stays(Bronze(spark, sf)))


@query
def tier_distribution(spark, sf):
    return analyst.distribution(filters.flag_filter(_dim(Bronze(spark, sf)), "is_current"), "loyalty_tier")


@query
def channel_distribution(spark, sf):
    return analyst.distribution(_stays(Bronze(spark, sf)), "booking_channel")


@query
def room_type_distribution(spark, sf):
    return analyst.distribution(_calendar(Bronze(spark, sf)), "room_type")


@query
def distinct_counts(spark, sf):
    b = Bronze(spark, sf)
    return analyst.distinct_counts(_stays(b), _calendar(b))


@query
def stay_date_range(spark, sf):
    return analyst.date_range(_stays(Bronze(spark, sf)))


@query
def calendar_date_range(spark, sf):
    return analyst.calendar_range(_calendar(Bronze(spark, sf)))


@query
def kpi_weekend_comparison(spark, sf):
    b = Bronze(spark, sf)
    return analyst.kpi_weekend_comparison(
        gold.kpi_weekend_vs_weekday(gold.nightly_measures(_stays(b)), gold.rooms_by_day(_calendar(b))))


def _kpis(b: Bronze):
    m = gold.nightly_measures(_stays(b))
    rooms = gold.rooms_by_day(_calendar(b))
    return (gold.kpi_revpar(m, rooms), gold.kpi_adr(m), gold.kpi_ancillary(m),
            gold.kpi_housekeeping_turnover(silver.checkout_events(b.reservations),
                                           silver.clean_housekeeping(b.housekeeping)))


@query
def kpi_averages(spark, sf):
    b = Bronze(spark, sf)
    return analyst.kpi_averages(gold.nightly_measures(_stays(b)), gold.rooms_by_day(_calendar(b)), _kpis(b)[3])


@query
def guests_multi_version(spark, sf):
    return analyst.multi_version_guests(silver.scd2_history(Bronze(spark, sf).guest_changes))


@query
def top_revpar_days(spark, sf):
    return analyst.top_revpar_days(_kpis(Bronze(spark, sf))[0])


@query
def reservations_one_per_content(spark, sf):
    """D02 option: copies of a reservation under new ids go."""
    return silver.clean_reservations(Bronze(spark, sf).reservations, silver.RESERVATION_CONTENT)


@query
def pos_one_per_content(spark, sf):
    """D02 option: copies of a charge under new ids go."""
    return silver.clean_pos(Bronze(spark, sf).pos, silver.POS_CONTENT)


@query
def reservations_one_per_id(spark, sf):
    """dropDuplicates on res_id, keeping columns equal across copies."""
    from ..operators import dedup
    r = silver.parse_reservations(Bronze(spark, sf).reservations).select("res_id", "hotel_id", "guest_id")
    return dedup.drop_duplicates_key(r, ["res_id"])


# ------------------------------------------------------------------ spec-only ops
@query
def availability_calendar(spark, sf):
    b = Bronze(spark, sf)
    return analyst.full_availability_calendar(silver.clean_inventory(b.inventory), _res(b))


@query
def orphan_stays(spark, sf):
    b = Bronze(spark, sf)
    stays_all = silver.fact_stays(_res(b), silver.pos_by_reservation(_pos(b)))
    return analyst.orphan_stays(stays_all, _guest_ids(b), b.inventory)


@query
def stays_with_known_room(spark, sf):
    b = Bronze(spark, sf)
    return analyst.stays_with_known_room(_res(b), silver.clean_inventory(b.inventory))


@query
def stays_with_tier_asof(spark, sf):
    b = Bronze(spark, sf)
    return analyst.stays_with_tier_asof(_stays(b), silver.scd2_history(b.guest_changes))


# --------------------------------------------------------------- quality (Q01-Q13)
@query
def dq_step_counts(spark, sf):
    """Q01: counted while the silver tables are written."""
    b, out, steps = Bronze(spark, sf), _scratch(spark, "silver"), quality.StepCounts(spark)
    guests = steps.write("guests", b.guests, lambda d: silver.latest_guests(silver.clean_guests(d)), f"{out}/guests")
    res = steps.write("reservations", b.reservations, silver.clean_reservations, f"{out}/reservations")
    pos = steps.write("pos_transactions", b.pos, silver.clean_pos, f"{out}/pos")
    steps.write("hotel_inventory", b.inventory, silver.clean_inventory, f"{out}/inventory")
    steps.write("housekeeping_logs", b.housekeeping, silver.clean_housekeeping, f"{out}/housekeeping")
    steps.write("fact_stays_unified", res, lambda d: silver.fact_stays_unified(d, pos, guests, b.inventory), f"{out}/stays")
    return steps.report()


@query
def dq_duplicate_reservations(spark, sf):
    b = Bronze(spark, sf)
    return quality.duplicate_reservations(silver.parse_reservations(b.reservations), _res(b))


@query
def dq_overbooked_slots(spark, sf):
    return quality.overbooked_slots(_calendar(Bronze(spark, sf)))


@query
def dq_null_critical(spark, sf):
    return quality.null_critical(Bronze(spark, sf).reservations)


@query
def dq_fk_violations(spark, sf):
    b = Bronze(spark, sf)
    stays_all = silver.fact_stays(_res(b), silver.pos_by_reservation(_pos(b)))
    from ..operators import joins
    rooms = joins.orphans(_res(b).filter(F.col("room_number").isNotNull()),
                          silver.clean_inventory(b.inventory), ["hotel_id", "room_number"])
    return quality.fk_violations(analyst.orphan_stays(stays_all, _guest_ids(b), b.inventory), rooms)


@query
def dq_metric_range(spark, sf):
    return quality.metric_out_of_range(_kpis(Bronze(spark, sf))[0], 0.0, 1000.0)


@query
def dq_dimension_totals(spark, sf):
    return quality.dimension_totals(silver.scd2_history(Bronze(spark, sf).guest_changes))


@query
def dq_latest_load(spark, sf):
    return quality.latest_load(_stays(Bronze(spark, sf)))


@query
def dq_dirty_profile(spark, sf):
    return quality.dirty_profile(Bronze(spark, sf).reservations)


# ------------------------------------------------------ documented SQL
def _analyst_sql(name):
    def run(spark, sf):
        inputs = {"dim_guests": _dim, "fact_stays": _stays, "kpi_revpar": lambda b: _kpis(b)[0],
                  "kpi_ancillary": lambda b: _kpis(b)[2], "kpi_turnover": lambda b: _kpis(b)[3]}
        return analyst.analyst_sql(spark, name, inputs[analyst.analyst_input(name)](Bronze(spark, sf)))
    run.__name__ = name
    return run


for _n in analyst.ANALYST_SQL:
    QUERIES[_n] = _analyst_sql(_n)


# ------------------------------------------------ sources, sinks and streaming
import uuid  # noqa: E402

from .. import schemas  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources import json_io  # noqa: E402
from ..streaming import incremental  # noqa: E402

RESERVATIONS_NARROW = schemas._schema(*[(f.name, f.dataType) for f in schemas.RESERVATIONS.fields
                                        if f.name not in ("booking_channel", "created_at")])


#: Records of a landed JSON file, as in the source's generator.
LANDED_RECORDS = 50_000


def _scratch(spark, what: str) -> str:
    return scratch_path(spark, "hostelry", f"{what}-{uuid.uuid4().hex[:12]}")


def _reservations_json(spark, sf) -> str:
    path = _scratch(spark, "bronze-reservations")
    json_io.chunked_json_sink(Bronze(spark, sf).reservations, path, LANDED_RECORDS)   # S16
    return path


@query
def json_roundtrip_reservations(spark, sf):
    """S16 then S01: bronze reservations as JSON-lines files and back."""
    return json_io.json_scan(spark, _reservations_json(spark, sf), schemas.RESERVATIONS)


@query
def json_rescued_fields(spark, sf):
    """S05 + Q02: read with a schema lacking two fields; what does not fit is
    rescued, reported as the sorted list of rescued keys per row."""
    lines = json_io.read_lines(spark, _reservations_json(spark, sf))
    r = json_io.rescue_malformed(lines, RESERVATIONS_NARROW)
    keys = F.array_join(F.array_sort(F.map_keys(F.from_json(json_io.RESCUED, "map<string,string>"))), ",")
    return r.select("res_id", keys.alias("rescued_keys"))


@query
def json_rescued_count(spark, sf):
    """Q02: rows read and rows with rescued content."""
    lines = json_io.read_lines(spark, _reservations_json(spark, sf))
    r = json_io.rescue_malformed(lines, RESERVATIONS_NARROW)
    return r.agg(F.count(F.lit(1)).alias("records_read"), F.count(json_io.RESCUED).alias("records_rescued"))


@query
def json_pinned_schema(spark, sf):
    """Infer the schema of the landed files once, store it beside them,
    and read with the stored schema."""
    path = _reservations_json(spark, sf)
    schema = json_io.pin_schema(spark, path, path + "_schema")
    return json_io.json_scan(spark, path, schema)


@query
def json_evolved_schema(spark, sf):
    """The same narrow schema widened by the keys found in the files."""
    path = _reservations_json(spark, sf)
    evolved = json_io.evolve_schema(json_io.read_lines(spark, path), RESERVATIONS_NARROW)
    return json_io.json_scan(spark, path, evolved)


def _drops(spark, src: str, parts, fn, ckpt: str | None = None, files: int | None = None) -> None:
    """Append each part as JSON files and drain the stream with one checkpoint: each
    run sees only the new files, ``files`` of them in a micro-batch."""
    ckpt = ckpt or _scratch(spark, "ckpt")
    for part in parts:
        json_io.chunked_json_sink(part, src, LANDED_RECORDS, mode="append")
        stream = incremental.json_stream(spark, src, _schema_of(part), files)
        incremental.run_available_now(incremental.foreach_batch_sink(stream, fn, ckpt))


def _schema_of(df: DataFrame):
    names = set(df.columns)
    for sch in [*schemas.BY_ENTITY.values(), schemas.GUEST_CHANGES]:
        if set(sch.fieldNames()) == names:
            return sch
    raise ValueError("no declared schema for these columns")


@query
def stream_fact_stays(spark, sf):
    """T02/P04 (+T04): charges arrive, then reservations in two file drops, the second with
    corrected re-sends, which win by their time."""
    from ..sources.driver_views import reservation_drops
    b, base = Bronze(spark, sf), _scratch(spark, "fact-stays")
    _drops(spark, _scratch(spark, "stream-pos"), [b.pos], incremental.pos_batch_fn(base))
    _drops(spark, _scratch(spark, "stream-reservations"), reservation_drops(spark, sf), incremental.reservations_batch_fn(base))
    return incremental.stays(spark, base, _guest_ids(b), b.inventory)


@query
def stream_late_pos(spark, sf):
    """Half of the charges come after the reservations they belong to; the folio
    totals of these follow, as in the batch run."""
    from ..sources.driver_views import reservation_drops
    b, base = Bronze(spark, sf), _scratch(spark, "late-pos")
    first, second = reservation_drops(spark, sf)
    late = F.pmod(F.floor(F.col("txn_id") / 10) + F.col("txn_id"), F.lit(2)) == 1
    pos_src, pos_ckpt = _scratch(spark, "late-pos-charges"), _scratch(spark, "ckpt")
    res_src, res_ckpt = _scratch(spark, "late-pos-reservations"), _scratch(spark, "ckpt")
    pos_fn, res_fn = incremental.pos_batch_fn(base), incremental.reservations_batch_fn(base)
    _drops(spark, pos_src, [b.pos.filter(~late)], pos_fn, pos_ckpt)
    _drops(spark, res_src, [second], res_fn, res_ckpt)       # corrections before what they correct
    _drops(spark, pos_src, [b.pos.filter(late)], pos_fn, pos_ckpt)
    _drops(spark, res_src, [first], res_fn, res_ckpt)
    return incremental.stays(spark, base, _guest_ids(b), b.inventory)


def _guest_stream(spark, sf, second, **options) -> DataFrame:
    """The guest dimension after the guests and a second drop of them."""
    guests, path = Bronze(spark, sf).guests, _scratch(spark, "dim-guests")
    _drops(spark, _scratch(spark, "stream-guests"), [guests, second(guests)], incremental.guests_batch_fn(path, **options))
    return incremental.guests_dimension(spark, path)


@query
def stream_dim_guests_type1(spark, sf):
    """D07 options on T01: name/email/country corrections overwrite the
    current row (type 1), and updates older than the current version are
    rejected."""
    return _guest_stream(spark, sf, incremental.profile_corrections, type1_cols=("name", "email", "country"), reject_out_of_order=True)


@query
def stream_dim_guests_processing_time(spark, sf):
    """D06 option on T01: expired rows end at the time of processing, here a fixed one."""
    return _guest_stream(spark, sf, incremental.profile_updates, processing_time=F.lit("2026-01-01 12:00:00"))


@query
def stream_dim_guests(spark, sf):
    """Guests arrive, then a drop of profile updates; each batch is
    folded into the SCD2 dimension (J09-J11 detect, S12 expire, insert)."""
    return _guest_stream(spark, sf, incremental.profile_updates)


@query
def stream_scd2_history(spark, sf):
    """The change log comes in three drops out of order, the last two into the middle of
    the history; then the checkpoint is lost and all files are read again."""
    changes, path = Bronze(spark, sf).guest_changes, _scratch(spark, "history")
    src, fn = _scratch(spark, "stream-changes"), incremental.history_batch_fn(path)
    third = F.pmod(F.xxhash64("change_seq"), F.lit(3))
    _drops(spark, src, [changes.filter(third == k) for k in (2, 0, 1)], fn)
    _drops(spark, src, [changes.filter("1 = 0")], fn)
    return incremental.guest_history(spark, path)


@query
def stream_replay_reset(spark, sf):
    """Both streams stop, their checkpoints are lost, and new ones apply all
    files again together with those that came since: nothing is lost or doubled."""
    from ..sources.driver_views import reservation_drops
    b, base = Bronze(spark, sf), _scratch(spark, "replay")
    src, pos_src = _scratch(spark, "replay-reservations"), _scratch(spark, "replay-pos")
    pos = [b.pos.filter("txn_id % 3 = 0"), b.pos.filter("txn_id % 3 <> 0")]
    for part, charges in zip(reservation_drops(spark, sf), pos, strict=True):
        _drops(spark, src, [part], incremental.reservations_batch_fn(base))
        _drops(spark, pos_src, [charges], incremental.pos_batch_fn(base))
    return incremental.stays(spark, base, _guest_ids(b), b.inventory)


@query
def stream_evolving_reservations(spark, sf):
    """S03-S05 on S02: the first drop lacks two columns; the second has them, lines cut off in
    the middle and texts in place of numbers. Neither columns nor lines are lost."""
    from ..sources.driver_views import reservation_drops
    path, src, ckpt = _scratch(spark, "evolving"), _scratch(spark, "stream-lines"), _scratch(spark, "ckpt")
    first, second = reservation_drops(spark, sf)
    json_io.chunked_json_sink(first.select(*RESERVATIONS_NARROW.fieldNames()), src, LANDED_RECORDS, mode="append")
    fn = incremental.evolving_batch_fn(path, RESERVATIONS_NARROW)
    incremental.run_available_now(incremental.foreach_batch_sink(incremental.text_stream(spark, src), fn, ckpt))
    def as_json(hotel):
        return F.to_json(F.struct(*[hotel.alias(c) if c == "hotel_id" else c for c in second.columns]))
    whole = F.when(F.col("res_id") % 75 == 0, as_json(F.lit("n/a"))).otherwise(as_json(F.col("hotel_id")))
    line = F.when(F.col("res_id") % 50 == 0, F.concat(F.lit("{\"res_id\":"), F.col("res_id").cast("string"))).otherwise(whole)
    second.select(line.alias("value")).write.mode("append").text(src)
    incremental.run_available_now(incremental.foreach_batch_sink(incremental.text_stream(spark, src), fn, ckpt))
    return incremental.evolved_rows(spark, path)


@query
def merge_upsert_reservations(spark, sf):
    """The corrected re-sends merged into the reservations by res_id."""
    from ..sources.driver_views import reservation_drops
    first, second = reservation_drops(spark, sf)
    return tables.merge_upsert(silver.clean_reservations(first), silver.clean_reservations(second), ["res_id"], check_unique=True)


# --------------------------------------------------------- saved tables
from ..sources import tables  # noqa: E402


def _table(what: str) -> str:
    return f"hx_{what}_{uuid.uuid4().hex[:12]}"


@query
def table_overwrite_scan(spark, sf):
    """Reservations saved twice over each other, then read."""
    name, res = _table("res"), _res(Bronze(spark, sf))
    tables.overwrite_table(res.select("res_id"), name)
    if tables.table_exists(spark, name):
        tables.overwrite_table(res, name)
    return tables.table_scan(spark, name)


@query
def table_partitioned_calendar(spark, sf):
    """The daily calendar saved with a folder per date, then read."""
    name = _table("calendar")
    tables.overwrite_partitioned(_calendar(Bronze(spark, sf)), name, "date")
    return tables.table_scan(spark, name)


@query
def table_append_counts(spark, sf):
    """S10 + Q11: charges with and without a reservation appended to one table;
    the row counts of it and of a table that does not exist."""
    name, pos = _table("pos"), _pos(Bronze(spark, sf))
    tables.append_table(pos.filter("res_id is not null"), name)
    tables.append_table(pos.filter("res_id is null"), name)
    counts = quality.table_counts(spark, [name, _table("missing")])
    return counts.select(F.when(F.col("table") == name, "pos").otherwise("missing").alias("table"), "rows")


@query
def stream_saved_reservations(spark, sf):
    """A cleaned file stream appended to a table, which is then read."""
    name, src = _table("stream"), _reservations_json(spark, sf)
    cleaned = silver.parse_reservations(incremental.json_stream(spark, src, schemas.RESERVATIONS))
    incremental.run_available_now(incremental.stream_to_table(cleaned, name, _scratch(spark, "ckpt")))
    return tables.table_scan(spark, name)


@query
def compacted_calendar(spark, sf):
    """The stored calendar rewritten clustered by hotel and date at once, then read."""
    source, path = _scratch(spark, "calendar"), _scratch(spark, "compacted")
    _calendar(Bronze(spark, sf)).write.parquet(source)
    tables.compact_clustered(spark, source, path, ["hotel_id", "date"])
    return spark.read.parquet(path)


@query
def persisted_reuse(spark, sf):
    """One kept calendar serves both the slot counts and the date range, and is given
    back when both are there (a row each)."""
    kept = tables.persist_reuse(_calendar(Bronze(spark, sf)))
    try:
        slots, first = quality.overbooked_slots(kept).first()["booked_slots"], analyst.calendar_range(kept).first()["min_date"]
    finally:
        kept.unpersist()
    return spark.createDataFrame([("slots", str(slots)), ("first", None if first is None else str(first))], "report string, value string")


# ------------------------------------------------------------- roll-ups
from . import rollup  # noqa: E402


@query
def rollup_months(spark, sf):
    """Months out of stored day states; approximate values are checked against exact ones."""
    b, path = Bronze(spark, sf), _scratch(spark, "day-states")
    stays = tables.persist_reuse(_stays(b))
    try:
        rollup.write_day_states(stays, silver.checkout_events(b.reservations), silver.clean_housekeeping(b.housekeeping), path)
        checked = _scratch(spark, "months")
        rollup.months_checked(rollup.months(spark, path), stays).write.parquet(checked)
    finally:
        stays.unpersist()
    return spark.read.parquet(checked)
