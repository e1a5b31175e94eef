"""Ordered scans per key that stay balanced when one key holds most rows.

``lag``/``lead``/running sums over ``Window.partitionBy(key)`` put every row of
a key into one task: a guest with a third of all history rows would be one
task holding a third of the data. Here the rows are range-partitioned by key and
order, so a hot key is cut wherever a partition is full, whatever its times are (also
within one month, one day or one instant). This is the usual prefix scan:

1. rows go to range partitions and are written once to the shared folder with their
   partition's number (the boundaries are sampled, so they must not be found twice);
2. the window runs per (partition, key);
3. only keys that lie at a partition's edge can go on in the next one. Their partitions
   are summed up in one row each -- at most three times as many rows as
   partitions, whatever the data -- and carried over with a second window over those rows;
4. what is carried is joined back by broadcast, as its size is bounded by the partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

PART = "_part"


def window_order(order: Sequence[tuple[str, bool]]) -> list[Column]:
    """(column, nulls_last) pairs -> ascending window ordering."""
    return [F.col(c).asc_nulls_last() if nl else F.col(c).asc_nulls_first() for c, nl in order]


def order_struct(order: Sequence[tuple[str, bool]]) -> Column:
    """The same ordering as one comparable struct (for min_by / max_by)."""
    fields = []
    for i, (c, nl) in enumerate(order):
        flag = F.col(c).isNull() if nl else F.col(c).isNotNull()
        fields += [flag.alias(f"f{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*fields)


def ordered_parts(df: DataFrame, key: str, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """The rows with ``PART``, the number of their range partition by key and order.
    Rows of equal key and order share a partition."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, F.col(key), *window_order(order)).withColumn(PART, F.spark_partition_id())
    path = scratch_path(spark, "ordered", uuid.uuid4().hex)
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def edge_rows(parts: DataFrame, key: str) -> DataFrame:
    """Rows of the keys that may lie in several partitions: those that are first or last
    in more than one place. At most two keys a partition."""
    ends = parts.groupBy(PART).agg(F.min(F.struct(key)).alias("lo"), F.max(F.struct(key)).alias("hi"))
    keys = ends.select(F.explode(F.array("lo", "hi")).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("places"))
    keys = keys.filter("places > 1").select(F.col(f"k.{key}").alias("_edge"))
    return parts.join(F.broadcast(keys), F.col(key).eqNullSafe(F.col("_edge")), "left_semi")


def _carried_back(local: DataFrame, carried: DataFrame, key: str) -> DataFrame:
    """Left join of the carried values (a row for each edge key and partition) to the rows."""
    c = carried.withColumnsRenamed({key: "_ckey", PART: "_cpart"})
    return local.join(F.broadcast(c), F.col(key).eqNullSafe(F.col("_ckey")) & (F.col(PART) == F.col("_cpart")), "left").drop("_ckey", "_cpart")


def carry_last_nonnull(df: DataFrame, key: str, order: Sequence[tuple[str, bool]], value: str, out: str) -> DataFrame:
    """``out`` = last non-NULL ``value`` among the rows of the same key up to
    and including this one, in ``order`` (``last(value, ignorenulls)`` over an
    unbounded-preceding window), by a prefix scan over range partitions."""
    parts = ordered_parts(df, key, order)
    w = Window.partitionBy(PART, key).orderBy(*window_order(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parts.withColumn("_llast", F.last(value, ignorenulls=True).over(w))
    # max() skips NULL inputs: the latest non-NULL value of the partition
    last = F.max(F.when(F.col(value).isNotNull(), F.struct(order_struct(order).alias("o"), F.col(value).alias("v"))))
    summary = edge_rows(parts, key).groupBy(key, PART).agg(last.getField("v").alias("_part_last"))
    before = Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(key, PART, F.last("_part_last", ignorenulls=True).over(before).alias("_carry"))
    return (_carried_back(local, carried, key)
            .withColumn(out, F.coalesce(F.col("_llast"), F.col("_carry"))).drop("_llast", "_carry", PART))


def change_versions(df: DataFrame, key: str, order: Sequence[tuple[str, bool]], tracked: str, ts: str) -> DataFrame:
    """Per key in ``order``: ``_prev`` (previous ``tracked``), ``_chg`` (1 when
    it exists and differs), ``version`` (1 + running sum of ``_chg``) and
    ``_next_ts`` (next row's ``ts``), by a prefix scan over range partitions."""
    parts = ordered_parts(df, key, order)
    w = Window.partitionBy(PART, key).orderBy(*window_order(order))

    def differs(prev: str, now: str) -> Column:
        return F.when(F.col(prev).isNotNull() & (F.col(prev) != F.col(now)), 1).otherwise(0)

    def changes(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_lprev", F.lag(tracked).over(w)).withColumn("_lchg", differs("_lprev", tracked))
    local = changes(parts).withColumns({
        "_lnext": F.lead(ts).over(w), "_first": F.lag(F.lit(1)).over(w).isNull(), "_last": F.lead(F.lit(1)).over(w).isNull(),
        "_lcum": F.sum("_lchg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    ordkey = order_struct(order)
    summary = changes(edge_rows(parts, key)).groupBy(key, PART).agg(
        F.min_by(tracked, ordkey).alias("_first_val"), F.max_by(tracked, ordkey).alias("_last_val"),
        F.min_by(ts, ordkey).alias("_first_ts"), F.sum("_lchg").alias("_part_chg"))
    ws = Window.partitionBy(key).orderBy(PART)
    summary = summary.withColumn("_carry_val", F.lag("_last_val").over(ws)).withColumn("_b", differs("_carry_val", "_first_val"))
    carried = summary.select(
        key, PART, "_carry_val", "_b", F.lead("_first_ts").over(ws).alias("_next_first_ts"),
        F.sum(F.col("_part_chg") + F.col("_b")).over(ws.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    j = _carried_back(local, carried, key).fillna(0, ["_b", "_before"])
    return j.withColumns({
        "_prev": F.when(F.col("_first"), F.col("_carry_val")).otherwise(F.col("_lprev")),
        "_chg": F.when(F.col("_first"), F.col("_b")).otherwise(F.col("_lchg")),
        "version": (F.col("_before") + F.col("_b") + F.col("_lcum") + 1).cast("long"),
        "_next_ts": F.when(F.col("_last"), F.col("_next_first_ts")).otherwise(F.col("_lnext")),
    }).drop("_lprev", "_lnext", "_first", "_last", "_lchg", "_lcum", "_carry_val", "_b", "_before", "_next_first_ts", PART)
