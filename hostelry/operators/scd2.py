"""Slowly changing dimension, type 2 (catalogue W04-W07, J09-J11, S12, J16).

Three entry points:

* ``scd2_from_history`` builds versions from a change log in one pass of
  windows over the key (batch form).
* ``scd2_merge_changes`` puts changes into an existing history, wherever in time they
  belong, and returns the rows that are new or changed by that.
* ``scd2_apply_batch`` folds one micro-batch into an existing dimension, taking what comes as the
  newest, and returns the new dimension as one DataFrame, so expiry and insertion
  are written together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import surrogate_key
from . import ordered

DIM_COLUMNS = ("guest_sk", "guest_id", "name", "email", "loyalty_tier", "country",
               "registration_date", "valid_from", "valid_to", "is_current", "version")


def scd2_from_history(df: DataFrame, key: str = "guest_id", ts: str = "updated_at",
                      tracked: str = "loyalty_tier", tie: Sequence[str] = (),
                      collapse: bool = False) -> DataFrame:
    """Versions from a change log (W04 previous value, W05 change flag,
    W06 running version, W07 next value as end).

    Row mode (``collapse=False``) keeps every input row: ``valid_to`` is the
    next row's timestamp even when the tracked value did not change, so rows of
    one run share a version. ``collapse=True`` keeps the first row of each run
    with the run's end, making (key, version) unique; runs are folded by a
    (key, version) aggregation, which combines map-side.
    The ordered scan is a prefix scan (``ordered.change_versions``), so one key
    with a huge history does not become one task.
    Adds ``valid_from``, ``valid_to``, ``is_current``, ``version`` and ``guest_sk``.
    """
    order = [(ts, True), *[(t, True) for t in tie]]
    v = ordered.change_versions(df, key, order, tracked, ts)
    out = v.withColumns({"valid_from": F.col(ts), "valid_to": F.col("_next_ts")}).drop("_prev", "_chg", "_next_ts")
    if collapse:
        ordkey = ordered.order_struct(order)
        cols = [c for c in out.columns if c not in (key, "version", "valid_to")]
        out = (out.groupBy(key, "version")
               .agg(F.min_by(F.struct(*cols), ordkey).alias("_f"), F.max_by("valid_to", ordkey).alias("valid_to"))
               .select(key, "version", *[F.col(f"_f.{c}").alias(c) for c in cols], "valid_to"))
    return out.withColumns({"is_current": F.col("valid_to").isNull(), "guest_sk": surrogate_key(key, "version")})


def scd2_merge_changes(history: DataFrame, changes: DataFrame, key: str = "guest_id", ts: str = "updated_at",
                       tracked: str = "loyalty_tier", seq: str = "change_seq") -> DataFrame:
    """Changes at any time put into a history: the interval that a change falls into is
    split and the versions from there on are numbered anew.

    ``history`` has the columns of ``changes`` (key, ts, tracked, seq) and ``version``, one row
    for each (key, seq), as this function returned them; rows of ``changes``
    that it has already make no difference. Returns the rows to store: of each
    key in ``changes``, the row before its earliest change (whose end moves) and all rows after it,
    with ``valid_to`` and ``version``. Rows before that are not read into
    the scan, and other keys are not read at all beyond a semi join.
    """
    cols = [key, ts, tracked, seq]
    new = changes.select(*cols).dropDuplicates([key, seq])
    at = ordered.order_struct([(ts, True), (seq, True)])
    starts = new.groupBy(F.col(key).alias("_key")).agg(F.min(at).alias("_start"))
    touched = history.select(*cols, "version", at.alias("_at")).join(starts, F.col(key) == F.col("_key"))
    before = touched.filter(F.col("_at") < F.col("_start")).groupBy("_key").agg(
        F.max("_at").alias("_from"), F.max_by("version", "_at").alias("_base"))
    rest = touched.drop("_start").join(before, "_key", "left").filter(F.col("_from").isNull() | (F.col("_at") >= F.col("_from")))
    every = rest.select(*cols).unionByName(new).dropDuplicates([key, seq])
    scanned = ordered.change_versions(every, key, [(ts, True), (seq, True)], tracked, ts)
    out = scanned.join(before.select("_key", "_base"), F.col(key) == F.col("_key"), "left")
    return out.select(*cols, F.col("_next_ts").alias("valid_to"), (F.col("version") + F.coalesce("_base", F.lit(1)) - 1).alias("version"))


def scd2_apply_batch(dim: DataFrame | None, batch: DataFrame, key: str = "guest_id",
                     tracked: str = "loyalty_tier", ts: str = "updated_at",
                     type1_cols: Sequence[str] = (), reject_out_of_order: bool = False,
                     processing_time: Column | None = None) -> DataFrame:
    """New dimension = old dimension with changed keys expired + new versions
    + new keys (P02 with J09-J11 and S12 in one plan).

    ``batch`` holds one cleaned row per key. A key is *changed* when it has a
    current row whose tracked value differs; it is *new* when it has no current
    row. The expired row's ``valid_to`` is the new version's ``valid_from``.
    Options (D07): ``type1_cols`` are overwritten in place on the current row
    when the tracked value did not change; ``reject_out_of_order`` ignores
    incoming rows older than the current version. Option (D06): the expired row
    ends at ``processing_time`` instead, the new version still begins at its own
    time; a replay gives the same rows if the time given is the same. Unchanged keys otherwise
    leave the dimension untouched, so applying a batch twice equals once.
    """
    payload = [c for c in DIM_COLUMNS if c not in
               ("guest_sk", "valid_from", "valid_to", "is_current", "version", key, tracked)]
    if dim is None:
        return (batch.withColumn("version", F.lit(1).cast("long"))
                .withColumn("valid_from", F.col(ts))
                .withColumn("valid_to", F.lit(None).cast(batch.schema[ts].dataType))
                .withColumn("is_current", F.lit(True))
                .withColumn("guest_sk", surrogate_key(key, "version"))
                .select(*DIM_COLUMNS))
    current = dim.filter(F.col("is_current")).select(
        F.col(key).alias("_ck"), F.col(tracked).alias("_ctier"), F.col("version").alias("_cver"),
        F.col("valid_from").alias("_cfrom"))
    # what an older version says already came before (files read again after a lost checkpoint)
    past = dim.filter(~F.col("is_current")).select(F.col(key).alias("_pk"), F.col("valid_from").alias("_pfrom"), F.col(tracked).alias("_ptier"))
    batch = batch.join(past, (F.col(key) == F.col("_pk")) & (F.col(ts) == F.col("_pfrom")) & (F.col(tracked) == F.col("_ptier")), "left_anti")
    detect = batch.join(current, batch[key] == current["_ck"], "left")               # J09
    if reject_out_of_order:
        detect = detect.filter(F.col("_ck").isNull() | (F.col(ts) >= F.col("_cfrom")))
    changed = detect.filter(F.col("_ck").isNotNull() & (F.col(tracked) != F.col("_ctier")))  # J10
    new = detect.filter(F.col("_ck").isNull())                                       # J11
    vto_type = dim.schema["valid_to"].dataType
    inserts = (changed.withColumn("version", F.col("_cver") + 1)
               .unionByName(new.withColumn("version", F.lit(1).cast("long")))
               .withColumns({"valid_from": F.col(ts), "valid_to": F.lit(None).cast(vto_type),
                             "is_current": F.lit(True)})
               .withColumn("guest_sk", surrogate_key(key, "version"))
               .select(*DIM_COLUMNS))
    # one action per touched key: expire (tracked value changed) or type-1 overwrite
    t1 = list(type1_cols)
    actions = changed.select(F.col(key).alias("_ak"), (F.col(ts) if processing_time is None else processing_time).cast(vto_type).alias("_end"),
                             *[F.lit(None).cast(batch.schema[c].dataType).alias(f"_n_{c}") for c in t1])
    if t1:
        same = detect.filter(F.col("_ck").isNotNull() & (F.col(tracked) == F.col("_ctier")))
        actions = actions.unionByName(same.select(F.col(key).alias("_ak"), F.lit(None).cast(vto_type).alias("_end"),
                                                  *[F.col(c).alias(f"_n_{c}") for c in t1]))
    j = dim.join(actions, dim[key] == actions["_ak"], "left")                        # S12
    expire = F.col("is_current") & F.col("_end").isNotNull()
    type1 = F.col("is_current") & F.col("_ak").isNotNull() & F.col("_end").isNull()
    updated = j.withColumns({
        "valid_to": F.when(expire, F.col("_end")).otherwise(F.col("valid_to")),
        "is_current": F.col("is_current") & ~expire,
        **{c: F.when(type1, F.col(f"_n_{c}")).otherwise(F.col(c)) for c in t1},
    })
    return updated.select(*DIM_COLUMNS).unionByName(inserts)


def asof_version(facts: DataFrame, versions: DataFrame, key: str, at: str,
                 value_cols: Sequence[str], valid_from: str = "valid_from",
                 valid_to: str = "valid_to", order_tie: str = "version") -> DataFrame:
    """Attach the version valid at ``facts[at]`` (J16):
    ``valid_from <= at < coalesce(valid_to, +inf)``.

    Instead of a range join (all versions x all facts of a key), facts and
    versions are merged into one time-ordered stream per key and each fact
    takes the last version seen so far (``last(..., ignorenulls)``, a prefix
    scan by ``ordered.carry_last_nonnull``): linear in the input, no
    pairs, balanced under a hot key. Versions sort before facts at equal times and by
    ``order_tie`` among themselves, so zero-length versions lose to their
    successor exactly as the interval test says.
    """
    vcols = list(value_cols)
    fcols = list(facts.columns)
    vstruct = F.struct(F.col(valid_to).cast("timestamp").alias("vto"), *[F.col(c) for c in vcols])
    v = versions.select(
        *[F.col(key) if c == key else F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in fcols],
        F.col(valid_from).cast("timestamp").alias("_t"), F.lit(0).alias("_kind"),
        F.col(order_tie).cast("long").alias("_tie"), vstruct.alias("_v"))
    f = facts.select(*fcols, F.col(at).cast("timestamp").alias("_t"), F.lit(1).alias("_kind"),
                     F.lit(None).cast("long").alias("_tie"),
                     F.lit(None).cast(v.schema["_v"].dataType).alias("_v"))
    # Versions sort before facts at equal times; zero-length versions
    # (valid_to == valid_from) before their successor.
    stream = f.unionByName(v).withColumn("_vto", F.col("_v.vto"))
    order = [("_t", True), ("_kind", True), ("_vto", True), ("_tie", True)]
    carried = ordered.carry_last_nonnull(stream, key, order, "_v", "_lv").filter(F.col("_kind") == 1)
    ok = F.col("_lv").isNotNull() & (F.col("_lv.vto").isNull() | (F.col("_t") < F.col("_lv.vto")))
    return carried.select(*fcols, *[F.when(ok, F.col(f"_lv.{c}")).alias(c) for c in vcols])
