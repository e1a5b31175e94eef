"""One identity for linked rows (P15): connected components inside groups."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "identity", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame, group: str, a: str, b: str) -> DataFrame:
    """(group, node, root): of every node in the links (group, a, b), the least node that
    it reaches by links of its group.

    Each round a node takes the least root among its neighbours and itself, and then its
    root's root, so roots move by doubled steps along a chain. A node's neighbours are reduced to one
    minimum before they are shuffled. Every round is written to the shared folder; it ends
    when no root changes."""
    both = _stored(links.select(group, F.col(a).alias("node"), F.col(b).alias("other"))
                   .unionByName(links.select(group, F.col(b).alias("node"), F.col(a).alias("other"))).distinct())
    now = _stored(both.select(group, "node").distinct().withColumn("root", F.col("node")))
    while True:
        around = both.join(now.select(group, F.col("node").alias("other"), "root"), [group, "other"]).groupBy(group, "node").agg(
            F.min("root").alias("least"))
        near = now.join(around, [group, "node"]).select(group, "node", "root", F.least("root", "least").alias("to"))
        ahead = now.select(group, F.col("node").alias("to"), F.col("root").alias("further"))
        step = _stored(near.join(ahead, [group, "to"]).select(group, "node", F.least("to", "further").alias("new"), "root"))
        now = step.select(group, "node", F.col("new").alias("root"))
        if step.filter(F.col("new") != F.col("root")).isEmpty():
            return now
