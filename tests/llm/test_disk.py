"""What operators leave on the disk."""
# ruff: noqa: F811
import os
import time
from urllib.parse import urlparse

import pytest
from llm_fixtures import SF001, docs, lspark  # noqa: F401
from pyspark.sql import functions as F

from hostelry.llm.common import materialize, scratch, settled


def folders(spark):
    return set(os.listdir(urlparse(scratch(spark, "x")).path.rsplit("/", 1)[0]))


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(found.length()) if (n := found.apply(i).getName()).startswith("shuffle_")}


def test_materialize_leaves_no_shuffle_files(lspark):
    before = shuffle_files(lspark)
    materialize(lspark.range(5000).groupBy((F.col("id") % 97).alias("k")).count(), "shuffled")
    for _ in range(50):  # Spark removes them on its own thread
        if not shuffle_files(lspark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(lspark) - before


def test_settled_leaves_its_result_alone(lspark):
    before = folders(lspark)
    df = settled(lambda: settled(lambda: materialize(lspark.range(6), "a").filter("id > 1"), "b").filter("id > 3"), "c")
    assert [n[0] for n in folders(lspark) - before] == ["c"] and sorted(r.id for r in df.collect()) == [4, 5]


@pytest.mark.parametrize("stage, left", [("jaccard_join", "jaccard-groups-found"), ("substring_dedup", "substring-removals"), ("mix_sources", "mix-taken")])
def test_stages_leave_one_table(lspark, docs, stage, left):
    import corpus_pipeline
    before = folders(lspark)
    df = getattr(corpus_pipeline, stage)(lspark, docs, SF001)
    assert [n.rsplit("-", 1)[0] for n in folders(lspark) - before] == [left]
    assert df.count() > 0
