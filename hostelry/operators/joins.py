"""Join helpers (catalogue J02-J05, J08, J12, J15, J17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ordered

def keep_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key exists in ``known`` (J02, J03, J05, J15): a left-semi join,
    which never multiplies rows. The known keys are made distinct first, so of a small
    domain (e.g. hotel ids) a few values are left, whose measured size lets
    adaptive execution broadcast them instead of gathering a hotel's rows in one task; a
    large domain is joined by shuffle, and skewed keys are split."""
    return df.join(known.select(*keys).distinct(), list(keys), "left_semi")


def orphans(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is missing from ``known`` (J04): a left-anti join.
    A NULL key never matches, so it counts as an orphan."""
    return df.join(known.select(*keys), list(keys), "left_anti")


def same_day_interval_join(events: DataFrame, marks: DataFrame, keys: Sequence[str],
                           mark_ts: str, event_ts: str, max_minutes: float) -> DataFrame:
    """Pair each mark with the events of the same keys in
    ``mark_ts <= event_ts <= mark_ts + max_minutes`` (J08).

    A plain equi-join on ``keys`` compares every mark of a room with every
    event of that room. Because the window is bounded, each mark can only meet
    events on the calendar days its window touches; marks are expanded to
    those days (one or two) and the days join as an extra equi key, so the
    fan-out is bounded by the events of one room-day.
    """
    span = F.expr(f"INTERVAL {int(max_minutes * 60)} SECONDS")
    m = marks.withColumn("_day", F.explode(F.sequence(F.to_date(F.col(mark_ts)),
                                                      F.to_date(F.col(mark_ts) + span),
                                                      F.expr("INTERVAL 1 DAY"))))
    e = events.withColumn("_day", F.to_date(F.col(event_ts)))
    joined = m.join(e, [*keys, "_day"], "inner")
    return joined.filter((F.col(event_ts) >= F.col(mark_ts)) &
                         (F.col(event_ts) <= F.col(mark_ts) + span)).drop("_day")


def last_before(facts: DataFrame, anchors: DataFrame, key: str, fact_at: str, anchor_at: str,
                anchor_id: str, out: str) -> DataFrame:
    """For each fact, the id of the latest anchor of the same key with
    ``anchor_at <= fact_at`` (ties: highest id) (J17).

    Union + ``last(ignorenulls)`` over one time-ordered stream per key
    (a prefix scan, so a hot key is split): linear, no pairs between facts
    and anchors.
    """
    fcols = list(facts.columns)
    a = anchors.select(
        *[F.col(key) if c == key else F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in fcols],
        F.col(anchor_at).cast("date").alias("_t"), F.lit(0).alias("_kind"),
        F.col(anchor_id).alias("_aid"))
    f = facts.select(*fcols, F.col(fact_at).cast("date").alias("_t"), F.lit(1).alias("_kind"),
                     F.lit(None).cast(anchors.schema[anchor_id].dataType).alias("_aid"))
    order = [("_t", True), ("_kind", True), ("_aid", True)]
    out_df = ordered.carry_last_nonnull(f.unionByName(a), key, order, "_aid", out)
    return out_df.filter(F.col("_kind") == 1).select(*fcols, out)
