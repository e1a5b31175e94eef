"""Quality rules by an isolation forest on rule statistics (operator 6).

Each document is measured once: words, characters in words, symbols, lines
equal to an earlier line, words inside repeated 3-word windows, capitals and
exclamation marks. A forest of random split trees is grown on a bounded sample
of labelled documents; the path that a document takes through a tree is short
where few documents of the sample are like it. Scores are the usual
``2 ** (-mean path / c(sample))``. The verdict's threshold is calibrated on all
labelled documents: of the thresholds that reject at most ``MAX_GOOD_LOSS`` of
the good ones, the one that rejects most of the bad ones. Rule failures
(``base_failed``) are rejected whatever their score.

The forest sees by how much each statistic lies outside the range that good
documents of the sample have (``TAIL`` cut off at either end), so that the
ordinary spread of good texts isolates none of them. A sample in which every
document has the same value cannot be split, so both good and bad labelled
documents are sampled, the bad ones as a small share: they place the splits
and stay rare.

Edge cases: null or empty text has no words and fails the base rules. Null
keys are measured and scored; they match no label. Repeated rows are each
measured. Labels for a document given several times count as bad if any is.
Without labels of both kinds nothing is calibrated and only the base rules reject.
A very long text is measured alone, whole; one huge word fails the base rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostelry.llm.common import hash_words, materialize, only, text_chunks

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Bounds on labelled rows that the forest is fitted on; one bad row is added to so many good ones.
SAMPLE_GOOD, SAMPLE_BAD, BAD_SHARE = 20_000, 400, 50
TREES, TREE_SAMPLE, SEED = 200, 256, 7
#: Share of good sample rows beyond either end of a statistic's usual range.
TAIL = 0.0005
#: Share of labelled good documents a threshold may reject, and steps of the score.
MAX_GOOD_LOSS = 0.001
SCORE_STEPS = 2_000

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_exclaim")
_WHITE = re.compile(rb"[\x09-\x0d\x20]")
_UPPER = re.compile(r"[A-Z]")
_NOT_ASCII = re.compile(r"[^\x00-\x7f]")


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    h = hash_words(words)
    _, ids = np.unique(h, return_inverse=True)
    ids = ids.astype(np.uint64)
    key = (ids[:-2] << np.uint64(42)) | (ids[1:-1] << np.uint64(21)) | ids[2:] if n < 1 << 21 else None
    if key is None:  # more words than 21 bits count: number the pairs first
        pair = ids[:-1] * np.uint64(n) + ids[1:]
        _, pair_ids = np.unique(pair, return_inverse=True)
        key = pair_ids[:-1].astype(np.uint64) * np.uint64(n) + ids[2:]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines (split at line feeds) that hold a word and equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def measure(raw: bytes) -> tuple[int, ...]:
    """``STATS`` of one text."""
    words = raw.split()
    joined = b"".join(words)
    text = joined.decode()
    ascii_only = len(text) == len(joined)
    capitals = sum(map(str.isupper, _NOT_ASCII.findall(text))) if not ascii_only else 0
    return (len(words), len(text), sum(joined.count(bytes([s])) for s in SYMBOLS), duplicate_lines(raw), repeat_words(words),
            len(_UPPER.findall(text)) + capitals, joined.count(b"!"))


def rule_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, one long for each of ``STATS``) of every row, in one pass over the texts."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in text_chunks(batches, text):
            got = np.array([measure(x) for x in raw], np.int64).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c) for c in got.T]], ["key", *STATS])
    src = only(docs, key, text)
    kind = src.schema[key].dataType.simpleString()
    return src.mapInArrow(run, f"key {kind}, " + ", ".join(f"{s} long" for s in STATS)).withColumnRenamed("key", key)


def ratios(stats: pd.DataFrame) -> np.ndarray:
    """Rule statistics as ratios, which do not depend on a text's length."""
    words = np.maximum(stats["n_words"].to_numpy(float), 1)
    chars = np.maximum(stats["word_chars"].to_numpy(float), 1)
    return np.column_stack([
        stats["word_chars"] / words, stats["n_symbols"] / words, stats["n_dup_lines"] / words,
        stats["n_repeat_words"] / words, stats["n_upper"] / chars, stats["n_exclaim"] / words])


def _expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path of an unsuccessful search in a binary tree of n values."""
    n = np.asarray(n, float)
    harmonic = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Random split trees; nodes of all trees lie in flat arrays."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, sample: int = TREE_SAMPLE, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.sample = min(sample, len(rows))
        self.depth_limit = max(1, int(np.ceil(np.log2(max(self.sample, 2)))))
        self.feature: list[int] = []
        self.split: list[float] = []
        self.left: list[int] = []
        self.path: list[float] = []  # of a leaf: its depth and what its rows would add
        self.roots = [self._grow(rows[rng.choice(len(rows), self.sample, replace=False)], 0, rng) for _ in range(trees)]
        for name, kind in (("feature", np.int32), ("split", float), ("left", np.int32), ("path", float)):
            setattr(self, name, np.array(getattr(self, name), kind))

    def _grow(self, rows: np.ndarray, depth: int, rng: np.random.Generator) -> int:
        node = len(self.feature)
        for part, value in ((self.feature, -1), (self.split, 0.0), (self.left, -1), (self.path, 0.0)):
            part.append(value)
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= self.depth_limit or len(rows) <= 1 or not len(usable):
            self.path[node] = depth + float(_expected_path(len(rows)))
            return node
        f = int(rng.choice(usable))
        cut = float(rng.uniform(low[f], high[f]))
        under = rows[:, f] <= cut
        self.feature[node], self.split[node] = f, cut
        left = self._grow(rows[under], depth + 1, rng)
        right = self._grow(rows[~under], depth + 1, rng)
        # the pair of children: left's place, and right's through path (unused by inner nodes)
        self.left[node], self.path[node] = left, right
        return node

    def paths(self, rows: np.ndarray) -> np.ndarray:
        """Mean path length of each row."""
        total = np.zeros(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            for _ in range(self.depth_limit):
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                under = rows[np.arange(len(rows)), np.maximum(f, 0)] <= self.split[at]
                at = np.where(inner, np.where(under, self.left[at], self.path[at].astype(np.int64)), at)
            total += self.path[at]
        return total / len(self.roots)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Near 1: isolated early; under 0.5: like the sample."""
        if not len(rows):
            return np.empty(0)
        return np.exp2(-self.paths(rows) / max(float(_expected_path(self.sample)), 1e-9))


class RuleForest:
    """A forest over distances outside the range of good documents."""

    def __init__(self, good: np.ndarray, bad: np.ndarray):
        self.low, self.high = np.quantile(good, [TAIL, 1 - TAIL], axis=0)
        self.forest = IsolationForest(np.concatenate([self.outside(good), self.outside(bad)]))

    def outside(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(rows - self.high, 0) + np.maximum(self.low - rows, 0)

    def scores(self, stats: pd.DataFrame) -> np.ndarray:
        return self.forest.scores(self.outside(ratios(stats)))


def base_failed():
    """The rule part of the verdict."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def fit_forest(labelled: DataFrame) -> RuleForest | None:
    """Forest of a bounded sample of labelled rows that pass the base rules: at
    most ``SAMPLE_GOOD`` good and ``SAMPLE_BAD`` bad ones, those of least hash."""
    def sample(quality: int, n: int) -> pd.DataFrame:
        rows = labelled.filter(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        return rows.select("doc_id", *STATS).toPandas()
    good, bad = sample(1, SAMPLE_GOOD), sample(0, SAMPLE_BAD)
    if not len(good):
        return None
    bad = bad.head(max(1, len(good) // BAD_SHARE))
    return RuleForest(ratios(good), ratios(bad))


def score(stats: DataFrame, forest: RuleForest) -> DataFrame:
    """``stats`` with a column ``score``."""
    columns = stats.columns

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(score=forest.scores(b))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema.fields)
    return stats.select(*columns).mapInPandas(run, f"{kinds}, score double")


def calibrate(scored: DataFrame, max_good_loss: float = MAX_GOOD_LOSS) -> float | None:
    """Threshold from all labelled rows, through counts of ``SCORE_STEPS`` score steps."""
    steps = (scored.groupBy(F.floor(F.col("score") * SCORE_STEPS).alias("step"))
             .agg(F.count(F.when(F.col("quality") == 1, 1)).alias("good"), F.count(F.when(F.col("quality") == 0, 1)).alias("bad"))
             .toPandas().sort_values("step", ascending=False))
    if not len(steps) or not steps["bad"].sum() or not steps["good"].sum():
        return None
    allowed = steps[steps["good"].cumsum() <= max_good_loss * steps["good"].sum()]
    useful = allowed[allowed["bad"] > 0]
    # the lowest step that still holds bad documents
    return float(useful["step"].min()) / SCORE_STEPS if len(useful) else None


def fit_rules(stats: DataFrame, labels: DataFrame) -> tuple[RuleForest | None, float | None]:
    """Forest and threshold from the statistics (doc_id, ``STATS``) of labelled rows."""
    known = only(labels, "doc_id", "quality").filter("doc_id is not null and quality is not null")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = materialize(stats.join(known, "doc_id").filter(~base_failed()), "labelled-statistics")
    forest = fit_forest(labelled)
    return forest, calibrate(score(labelled, forest)) if forest else None


def quality_rules(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ``STATS``, base_failed, score, kept) of every row."""
    stats = materialize(rule_statistics(docs, key, text).withColumnRenamed(key, "doc_id"), "rule-statistics")
    forest, threshold = fit_rules(stats, labels)
    scored = score(stats, forest) if forest else stats.withColumn("score", F.lit(0.0))
    odd = F.lit(False) if threshold is None else F.col("score") >= threshold
    return (scored.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~odd).withColumnRenamed("doc_id", key))


def good_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, unchanged. They are
    measured again where they are, which moves no text between executors."""
    forest, threshold = fit_rules(rule_statistics(docs, key, text).withColumnRenamed(key, "doc_id"), labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in text_chunks(batches, text):
            stats = pd.DataFrame(np.array([measure(x) for x in raw], np.int64).reshape(-1, len(STATS)), columns=list(STATS))
            failed = (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"])
            odd = forest.scores(stats) >= threshold if threshold is not None else np.zeros(len(stats), bool)
            yield part.filter(pa.array(~failed.to_numpy() & ~odd))
    return docs.mapInArrow(run, docs.schema)
