"""JSON-lines sources and sinks (catalogue S01, S03-S05, S16).

Raw entity folders hold newline-delimited JSON. Files are always read with a
declared schema: inference is an extra pass over all files and gives
different types from run to run; ``pin_schema`` infers once and stores it.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued"
CORRUPT = "_corrupt_record"
MAX_NEW_KEYS = 1_000


def json_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every JSON-lines file under ``path`` as one table."""
    return spark.read.schema(schema).option("multiLine", False).json(path)


def chunked_json_sink(df: DataFrame, path: str, max_records: int, mode: str = "overwrite") -> None:
    """Write JSON-lines files of at most ``max_records`` records each."""
    df.write.mode(mode).option("maxRecordsPerFile", max_records).json(path)


def is_missing(e: AnalysisException) -> bool:
    """Whether a read failed because there is nothing at the path yet; any other
    failure of the storage must not pass for an empty table."""
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def pin_schema(spark: SparkSession, sample_path: str, schema_path: str) -> T.StructType:
    """Infer the schema once and reuse the stored copy afterwards.

    The schema is kept as a one-line JSON text file beside the data, written
    and read through Spark so it lives on the same shared storage.
    """
    try:
        text = spark.read.text(schema_path).first()
    except AnalysisException as e:
        if not is_missing(e):
            raise
        text = None  # first run: nothing stored yet
    if text is not None:
        return T.StructType.fromJson(json.loads(text[0]))
    schema = spark.read.json(sample_path).schema
    store_schema(spark, schema, schema_path)
    return schema


def store_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """A schema as a one-line JSON text file on the shared storage."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def stored_schemas(spark: SparkSession, path: str) -> dict[int, T.StructType]:
    """The schemas stored as ``path/version=<n>`` by their numbers."""
    try:
        rows = spark.read.text(path).select("value", F.col("version").cast("int")).collect()
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return {}
    return {r.version: T.StructType.fromJson(json.loads(r.value)) for r in rows}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines of the JSON files (input for rescue and evolution)."""
    return spark.read.text(path)


def unknown_keys(lines: DataFrame, schema: T.StructType) -> list[str]:
    """Top-level keys present in the data but absent from ``schema``.

    The result is the set of new column *names*. Keys that are data (an id as
    a key) would make columns without end, so more than ``MAX_NEW_KEYS`` are refused."""
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    keys = F.explode(F.array_except(F.map_keys(F.from_json("value", "map<string,string>")), known))
    found = [r[0] for r in lines.select(keys.alias("k")).distinct().limit(MAX_NEW_KEYS + 1).collect()]
    if len(found) > MAX_NEW_KEYS:
        raise ValueError(f"more than {MAX_NEW_KEYS} unknown keys: the source's keys are not columns")
    return sorted(found)


def evolve_schema(lines: DataFrame, schema: T.StructType) -> T.StructType:
    """Known schema widened by the new keys as nullable strings."""
    extra = [T.StructField(k, T.StringType(), True) for k in unknown_keys(lines, schema)]
    return T.StructType(schema.fields + extra)


def rescue_malformed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse lines with ``schema``, keeping what does not fit in ``_rescued``.

    ``_rescued`` is a JSON object of the unknown keys and of the known keys
    whose value did not parse as the declared type; a line that is not JSON
    at all is kept whole under the key ``_line``. NULL when nothing was lost.
    """
    parse_schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    parsed = F.from_json("value", parse_schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    raw = F.from_json("value", "map<string,string>")
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    df = lines.select("value", parsed.alias("p"), raw.alias("raw"))
    unknown = F.map_filter("raw", lambda k, v: ~F.array_contains(known, k))
    mismatched = F.map_from_entries(F.filter(F.array(*[
        F.when(F.col("raw")[f.name].isNotNull() & F.col(f"p.{f.name}").isNull(),
               F.struct(F.lit(f.name).alias("key"), F.col("raw")[f.name].alias("value")))
        for f in schema.fields]), lambda x: x.isNotNull()))
    lost = F.map_concat(unknown, mismatched)
    rescued = (F.when(F.col("raw").isNull() & (F.length(F.trim("value")) > 0),
                      F.to_json(F.create_map(F.lit("_line"), F.col("value"))))
               .when(F.size(lost) > 0, F.to_json(lost)))
    return df.select(*[F.col(f"p.{f.name}").alias(f.name) for f in schema.fields], rescued.alias(RESCUED))
