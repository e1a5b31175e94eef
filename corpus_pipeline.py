"""Corpus pipeline: raw documents to token ids.

Each stage applies one operator to all that its predecessor kept, is written as
Parquet in the shared folder and read back as the next one's documents. All but
the last return the columns of ``documents``. A very long text goes through
every stage whole. ORACLE_SQL is None: the quality
verdicts, the mixing rates and the ids are not expressible in SQL.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hostelry.llm import bpe, jaccard, mixing, quality, substrings
from hostelry.llm.common import documents, settled, ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship(spark)
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of smallest id,
    one of its rows if it is repeated. Documents without words stay. Rows with a
    null id, which link with nothing, stay once for each text."""
    ship(spark)
    found = settled(lambda: jaccard.jaccard_components(docs), "jaccard-groups-found")
    own = found.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    stay = docs.join(own, "doc_id")
    once = stay.filter("n = 1").select(docs.columns)
    repeated = stay.filter("n > 1").select(docs.columns).dropDuplicates(["doc_id", "text"])
    nameless = docs.filter("doc_id is null").dropDuplicates(["text"])
    return once.unionAll(repeated).unionAll(nameless)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated 50-word windows go; a text with none left goes too.
    n_chars follows the text."""
    ship(spark)
    left = substrings.without_repeats(docs)
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Rows of a repeated id share
    that id's copies evenly."""
    ship(spark)
    def mixed() -> DataFrame:
        copies = mixing.mix(docs).groupBy("doc_id").agg(F.sum("copies").alias("total"), F.count(F.lit(1)).alias("n")).filter("total > 0")
        return copies.withColumnRenamed("doc_id", "mixed_id")
    copies = settled(mixed, "mix-taken")
    taken = docs.join(copies, F.col("doc_id").eqNullSafe(F.col("mixed_id")))
    once = taken.filter("n = 1").withColumn("own", F.col("total"))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    repeated = taken.filter("n > 1").withColumn("own", F.floor(F.col("total") / F.col("n")) + (nth <= F.col("total") % F.col("n")).cast("long"))
    every = once.unionAll(repeated).filter("own > 0")
    return every.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("own")))).select(docs.columns)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): the ids, and the digest of what they decode to."""
    ship(spark)
    return bpe.bpe_encoded(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("bpe_encode", bpe_encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``."""
    docs = documents(ship(spark), sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settled(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
