"""Mixing sources to target weights by entropy balancing (operator 8).

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and
share 150 % of all words; a target above twice its source's words is cut there
and the excess shared again by weight among the others, until none is above.

Rates: every document starts with one copy and may have up to two. Of all
rates that meet the token constraints (for each source: the words of its
documents times their rates make its target), the one nearest to a single copy
each in (Fermi-Dirac) entropy tilts exponentially: odds of rate to 2 - rate of
``exp(tilt * words / mean words)``, so rate = 2 / (1 + exp(-that)). The tilts
solve the convex dual, by Newton steps kept inside a shrinking bracket. Each
step sums values and slopes over the counts of documents by (source, words),
on the executors, in whole millionths, so that neither the order of a sum nor
its partition changes a result.

Rounding: the documents of a source with as many words share one rate. Going
from the most words to the fewest, each such group gets the whole number of
copies nearest to its rate, with what earlier groups gave too much or too
little taken into account, so a source ends within about its smallest document
of the target. Copies are dealt within the group by a hash of the key.

Edge cases: a null text has no words. Documents without words take none. A
null source is a source of its own. Null keys and repeated rows are documents
like others; equal rows are told apart only by position, so which of them gets
an extra copy does not show. Without any words every target is 0. The table of
sources (one row each) passes through the driver. A very long text weighs what its words
number and is never cut, so a source may miss its target by as much.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostelry.llm.common import materialize, only, text_chunks

#: The weights in turn, the share of all words taken, the most copies of a document.
WEIGHTS, SHARE, MAX_COPIES = (5.0, 2.0, 1.0), 1.5, 2
STEPS, TOLERANCE, TILT_BOUND = 60, 1e-6, 2.0 ** 40
#: Whole units of the distributed sums.
UNIT = 1_000_000
#: Parts into which a group of equal source and size is cut for ranking.
RANK_PARTS = 4096


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, size: words of the text)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in text_chunks(batches, text):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([len(x.split()) for x in raw], pa.int64())], ["key", "source", "size"])
    src = only(docs, key, source, text)
    return src.mapInArrow(run, f"key {src.schema[key].dataType.simpleString()}, source string, size long")


def target_words(totals: list[int], share: float = SHARE, weights: tuple[float, ...] = WEIGHTS, most: int = MAX_COPIES) -> list[float]:
    """Target of each source, from the sources' words in their order."""
    weight = [weights[i % len(weights)] for i in range(len(totals))]
    targets, free, left = [0.0] * len(totals), set(range(len(totals))), share * sum(totals)
    while free:
        unit = left / sum(weight[i] for i in sorted(free))
        above = [i for i in sorted(free) if unit * weight[i] > most * totals[i]]
        if not above:
            for i in free:
                targets[i] = unit * weight[i]
            break
        for i in above:
            targets[i] = float(most * totals[i])
            left -= targets[i]
            free.remove(i)
    return targets


def rate(size, mean, tilt):
    """Copies of a document, as a column expression; exact at either end."""
    x = F.col(tilt) * F.col(size) / F.col(mean)
    return F.when(x > 700, 2.0).when(x < -700, 0.0).otherwise(2.0 / (1.0 + F.exp(-x)))


def solve_tilts(groups: DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """``sources`` (sid, total, mean, target) with the tilt of each: safeguarded
    Newton steps on the dual, all sources at once. groups: (sid, size, n)."""
    spark = groups.sparkSession
    n = len(sources)
    total, target, mean = (sources[c].to_numpy(float) for c in ("total", "target", "mean"))
    tilt, low, high = np.zeros(n), np.full(n, -TILT_BOUND), np.full(n, TILT_BOUND)
    tilt[target >= MAX_COPIES * total] = np.inf
    tilt[target <= 0] = -np.inf
    open_ = np.isfinite(tilt) & (total > 0)
    for _ in range(STEPS):
        if not open_.any():
            break
        now = pd.DataFrame({"sid": sources["sid"][open_], "mean": mean[open_], "tilt": tilt[open_]})
        joined = groups.join(F.broadcast(spark.createDataFrame(now)), "sid")
        words = F.col("n") * F.col("size")
        r = rate("size", "mean", "tilt")
        sums = (joined.groupBy("sid").agg(
            F.sum(F.round(words * r * UNIT).cast("decimal(38,0)")).alias("value"),
            F.sum(F.round(words * r * (1 - r / 2) * F.col("size") / F.col("mean") * UNIT).cast("decimal(38,0)")).alias("slope"))
            .toPandas().set_index("sid"))
        for i in np.flatnonzero(open_):
            value, slope = (float(sums.at[sources["sid"][i], c]) / UNIT for c in ("value", "slope"))
            gap = value - target[i]
            if abs(gap) <= TOLERANCE * max(target[i], 1):
                open_[i] = False
                continue
            low[i], high[i] = (low[i], tilt[i]) if gap > 0 else (tilt[i], high[i])
            step = tilt[i] - gap / slope if slope > 0 else np.nan
            if not low[i] < step < high[i]:
                near = [x for x in (low[i], high[i]) if abs(x) < TILT_BOUND]
                step = sum(near) / 2 if len(near) == 2 else (2 * tilt[i] + (1 if gap < 0 else -1))
            tilt[i] = step
    return sources.assign(tilt=tilt)


def _round_groups(pdf: pd.DataFrame) -> pd.DataFrame:
    """Copies of the size groups of one source, most words first."""
    pdf = pdf.sort_values("size", ascending=False)
    owed, copies = 0.0, []
    for size, n, r in zip(pdf["size"], pdf["n"], pdf["rate"], strict=True):
        want = owed + size * n * r
        k = int(min(MAX_COPIES * n, max(0, round(want / size)))) if size else 0
        owed = want - k * size
        copies.append(k)
    return pdf.assign(copies=copies)[["sid", "size", "copies", "n"]]


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, size, source_size, target, rate, copies, taken) of every row."""
    spark = docs.sparkSession
    sized = materialize(sizes(docs, key, text, source), "mix-sizes")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("n")).toPandas()
    by_source = by_source.assign(null=by_source["source"].isna(), point=[str(x).encode() if x is not None else b"" for x in by_source["source"]])
    by_source = by_source.sort_values(["null", "point"]).reset_index(drop=True)  # UTF-8 sorts by code point
    if not len(by_source):
        return sized.select(F.col("key").alias(key), "source", "size", F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"),
                            F.lit(0.0).alias("rate"), F.lit(0).cast("long").alias("copies"), F.lit(0).cast("long").alias("taken"))
    by_source["sid"] = range(len(by_source))
    by_source["target"] = target_words([int(x) for x in by_source["total"]])
    by_source["mean"] = np.maximum(by_source["total"] / by_source["n"], 1e-9)
    names = spark.createDataFrame([(x["source"], int(x["sid"]), int(x["total"]), float(x["target"])) for x in by_source.to_dict("records")],
                                  "s_source string, sid int, source_size long, target double")
    numbered = (sized.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source"))
    part = F.pmod(F.xxhash64("key", "size"), F.lit(RANK_PARTS)).cast("int")
    numbered = numbered.withColumn("part", part)
    parts = materialize(numbered.groupBy("sid", "size", "part").agg(F.count(F.lit(1)).alias("m")), "mix-groups")
    groups = parts.groupBy("sid", "size").agg(F.sum("m").alias("n"))
    solved = solve_tilts(groups, by_source[["sid", "total", "mean", "target"]])
    tilts = spark.createDataFrame(solved[["sid", "mean", "tilt"]].astype({"sid": "int32"}))
    rated = groups.join(F.broadcast(tilts), "sid").withColumn("rate", rate("size", "mean", "tilt"))
    # a source has at most as many rows here as its documents have different sizes
    dealt = rated.groupBy("sid").applyInPandas(_round_groups, "sid int, size long, copies long, n long")
    dealt = materialize(dealt, "mix-copies")
    # each member of a group gets copies // n, and the first copies % n by hash one more; the
    # rank within the group is that within its part plus all members of earlier parts
    before = F.sum("m").over(Window.partitionBy("sid", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (parts.withColumn("before", F.coalesce(before, F.lit(0))).join(dealt, ["sid", "size"])
               .select("sid", "size", "part", "before", "copies", "n"))
    rank = F.row_number().over(Window.partitionBy("sid", "size", "part").orderBy(F.xxhash64("key"), "key"))
    out = numbered.withColumn("rank", rank).join(offsets, ["sid", "size", "part"]).join(F.broadcast(tilts), "sid")
    even, extra = F.floor(F.col("copies") / F.col("n")), F.col("copies") % F.col("n")
    own = (even + F.when(F.col("before") + F.col("rank") <= extra, 1).otherwise(0)).cast("long")
    return out.select(F.col("key").alias(key), "source", "size", "source_size", "target", rate("size", "mean", "tilt").alias("rate"),
                      own.alias("copies"), (own * F.col("size")).alias("taken"))
