"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostelry.llm.common import materialize


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b of long): root is
    the smallest node of its component.

    Alternates two steps until the edges no longer change. Large star: every
    larger neighbour of a node is linked to the smallest one around it. Small
    star: so is every smaller neighbour, and the node itself. Each step is one
    pre-aggregated minimum and one join; the number of rounds grows with the
    logarithm of the longest path. Every round ends in a table in the shared
    folder. An edge list of copies that share one node is a star already."""
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), name)
    state = None
    while True:
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                              F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        now = materialize(small.filter("a <> b").distinct(), name)
        found = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
