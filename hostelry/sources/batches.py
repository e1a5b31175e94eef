"""What micro-batches leave behind: one folder for each (stream id, batch id).

A replayed batch has the same ids and overwrites its own folder, so each batch counts
once; no folder is ever changed by another batch. The present state is an aggregation over the keyed rows of
all folders, in which rows win by what they say themselves (a time, a number of known rows), so it does
not depend on the order in which batches came. A deleted checkpoint makes a new stream id: its
folders repeat rows of older ones, which the same aggregation takes once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .json_io import is_missing

FILE = "_file"  # column with the source file of a row


def write_batch(df: DataFrame, path: str, stream: str, batch_id: int) -> None:
    """The batch's own folder, whole or not at all; written again if the batch is replayed."""
    df.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType, but: tuple[str, int] | None = None) -> DataFrame:
    """Rows of all batches with their ``stream`` and ``batch``; none before the first. ``but``:
    (stream, batch) left out, so that a replayed batch does not see itself."""
    whole = T.StructType([*schema.fields, T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType())])
    try:
        df = spark.read.schema(whole).parquet(path)
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return spark.createDataFrame([], whole)
    if but is None:
        return df
    return df.filter((F.col("stream") != but[0]) | (F.col("batch") != but[1]))


def once_per_file(rows: DataFrame) -> DataFrame:
    """Rows that belong to no key of their own (equal ones are different rows): of a file that several
    batches have read, as after a lost checkpoint, the rows of one batch. Files never change, and a batch has all of a file.
    The batch of each file is broadcast, a row a file (the file stream lists these in the driver too), so that the rows
    themselves are not shuffled by the few values of their file."""
    seen = rows.groupBy(F.col(FILE).alias("_of"), "stream").agg(F.min("batch").alias("batch"))  # of few rows the smallest pair
    one = seen.groupBy("_of").agg(F.min(F.struct("stream", "batch")).alias("_by"))
    return rows.join(F.broadcast(one), (F.col(FILE) == F.col("_of")) & (F.struct("stream", "batch") == F.col("_by")), "left_semi")
