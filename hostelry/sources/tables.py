"""Tables and upserts without a transactional table format (catalogue S06-S11,
S17, S18).

Plain Parquet has no MERGE: ``merge_upsert`` gives the merged rows as one DataFrame,
which the caller writes to a new place. Streams do not rewrite tables; see ``batches``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_scan(spark: SparkSession, name: str) -> DataFrame:
    """S06."""
    return spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    """First-run create vs later-run merge."""
    return spark.catalog.tableExists(name)


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace table and schema."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def overwrite_partitioned(df: DataFrame, name: str, col: str) -> None:
    """As S08, one folder per value of ``col`` (e.g. a date). Rows are
    clustered by the partition column first so each task writes few files; the
    rebalance hint lets AQE split a value that holds many rows over several tasks."""
    df.hint("rebalance", col).write.mode("overwrite").partitionBy(col).saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """S10."""
    df.write.mode("append").saveAsTable(name)


def assert_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """MERGE refuses a source with duplicate keys; so do we (one small action)."""
    dup = source.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"merge source has duplicate keys, e.g. {dup[0].asDict()}")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 check_unique: bool = False) -> DataFrame:
    """Matched target rows replaced by the source row (all columns),
    unmatched source rows inserted. One anti join + union: applying the same
    source twice gives the same result as once."""
    if check_unique:
        assert_unique_keys(source, keys)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def write_sorted(df: DataFrame, path: str, cols: Sequence[str], files: int) -> None:
    """Rows into ``files`` files in the order of ``cols``: scans on the first one prune files and row groups."""
    (df.repartitionByRange(files, *cols).sortWithinPartitions(*cols)
     .write.mode("overwrite").parquet(path))


#: Bits of a column's rank in the curve: 64 ranges of equally many rows.
CURVE_BITS = 6


def _ordinal(df: DataFrame, col: str) -> Column:
    """A number in the column's order (of a text its first seven bytes)."""
    kind, c = df.schema[col].dataType, F.col(col)
    if isinstance(kind, T.DateType):
        return F.datediff(c, F.lit("1970-01-01")).cast("double")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("double")
    return c.cast("double")


def curve_value(df: DataFrame, cols: Sequence[str]) -> Column:
    """Place of a row on the Z curve over the ranks of ``cols``: the bits of the ranks in turn, so rows
    that are near on the curve are near in every column. Ranks come from 63 quantiles of
    each column, which one aggregation brings to the driver; NULL has the lowest."""
    share = [i / (1 << CURVE_BITS) for i in range(1, 1 << CURVE_BITS)]
    cuts = df.agg(*[F.percentile_approx(_ordinal(df, c), share, 10_000).alias(c) for c in cols]).first()

    def rank_of(c: str) -> Column:
        x = _ordinal(df, c)
        reached = F.filter(F.array(*map(F.lit, cuts[c] or [0.0])), lambda cut: cut <= x)
        return F.when(x.isNull(), 0).otherwise(F.size(reached)).cast("long")
    curve = F.lit(0).cast("long")
    for j, c in enumerate(cols):
        rank = rank_of(c)
        for bit in range(CURVE_BITS):
            curve = curve + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1), bit * len(cols) + j)
    return curve


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that a stored table's scan reads."""
    files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("n")).distinct()
    return files.agg(F.sum("n")).first()[0] or 0


#: Rows of a compacted file at most: they are sorted in one task, in which they are far larger than stored.
FILE_ROWS = 2_000_000


def compact_clustered(spark: SparkSession, source: str, target: str, cols: Sequence[str], file_bytes: int = 128 << 20) -> None:
    """A stored table rewritten into files of about ``file_bytes``, clustered by all of
    ``cols`` at once (the OPTIMIZE/ZORDER idea): the content is unchanged, and a filter on any one of the
    columns skips most files and row groups. Small files of a feed become few. A file has
    ``FILE_ROWS`` rows at most, so the memory of the task that sorts it does not grow with the table."""
    df = spark.read.parquet(source)
    files = max(1, -(-stored_bytes(df) // file_bytes), -(-df.count() // FILE_ROWS))
    (df.withColumn("_curve", curve_value(df, cols)).repartitionByRange(files, "_curve", *cols).sortWithinPartitions("_curve", *cols)
     .drop("_curve").write.mode("overwrite").parquet(target))


def persist_reuse(df: DataFrame) -> DataFrame:
    """Keep a table used by several consumers; spills to disk instead of
    recomputing when memory is short. Call ``unpersist()`` when done."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
