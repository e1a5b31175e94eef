"""Language identification by hierarchical discrimination (operator 9).

A text is described by hashed counts of its letters' 1- to 3-byte sequences
(lower case, runs of other characters as one space), each length scaled to unit
norm. One-versus-rest linear support vector machines predict the language
family; within a family one-versus-one machines separate the related languages
by votes, margins breaking ties. The machines are trained on a bounded,
documented sample of labelled rows; every text is then read whole.

The score is the logistic function of the deciding margin: the smaller of the
family's lead and the language's.

Edge cases: a null text, or one without a letter, is ``und`` with score 0.
Null or unlisted languages: null is not learned; a language outside
``FAMILIES`` is a family of its own. Without any training rows everything is
``und``. Null keys are predicted like others and never learned from. A very long text
is described whole, in memory in proportion to its bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostelry.llm.common import only, text_parts, texts

#: Families of closely related languages.
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no"),
    "romance": ("es", "fr", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg"),
}
#: Bound on training rows of each language (those of least hash), and of bytes of all their features on the driver.
SAMPLE = 400
#: Size of the table of hashed sequences, one part for each length.
BUCKETS = (256, 2048, 4096)
WIDTH = sum(BUCKETS)
EPOCHS, REGULAR = 200, 1e-4
_OTHER = re.compile(r"[\W\d_]+")
_WORD = re.compile(r"[^\W\d_]+")


def family(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def describe(text: str) -> np.ndarray | None:
    """Feature vector of a text; None without a letter."""
    if not any(c.isalpha() for m in _WORD.finditer(text) for c in m[0]):
        return None  # numeric characters such as fractions are no letters
    b = np.frombuffer(f" {_OTHER.sub(' ', text).strip().lower()} ".encode(), np.uint8).astype(np.uint32)
    two = (b[:-1] * 0x9E37 + b[1:] * 0x85EB) >> 3
    three = (b[:-2] * 0x9E3779B1 + b[1:-1] * 0x85EBCA77 + b[2:] * 0xC2B2AE3D) >> 15
    parts = [np.bincount(x & (size - 1), minlength=size).astype(np.float64) for x, size in zip((b, two, three), BUCKETS, strict=True)]
    return np.concatenate([p / np.linalg.norm(p) for p in parts]).astype(np.float32)


def train_svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (bias last) of a linear machine for y in {-1, 1}: subgradient
    descent on the squared hinge loss, with classes weighed alike."""
    x = np.column_stack([x, np.ones(len(x), x.dtype)])
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w, velocity = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    rate = 1.0 / (2 * 4 + REGULAR)  # rows have norm 2
    for _ in range(EPOCHS):
        ahead = w + np.float32(0.9) * velocity
        slack = np.maximum(0, 1 - y * (x @ ahead))
        step = np.float32(REGULAR) * ahead - 2 * (x.T @ (weight * slack * y))
        velocity = np.float32(0.9) * velocity - np.float32(rate) * step
        w = w + velocity
    return w


class Hierarchy:
    """Family machines, and one machine for each pair of languages of a family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        lang = np.array(langs)
        fam = np.array([family(v) for v in langs])
        self.families = sorted(set(fam.tolist()))
        self.members = {f: [v for v in self.langs if family(v) == f] for f in self.families}
        rows = []
        if len(self.families) > 1:
            rows += [train_svm(x, np.where(fam == f, 1.0, -1.0)) for f in self.families]
        self.pairs = []
        for f in self.families:
            own = self.members[f]
            for i, a in enumerate(own):
                for b in own[i + 1:]:
                    at = (lang == a) | (lang == b)
                    rows.append(train_svm(x[at], np.where(lang[at] == a, 1.0, -1.0)))
                    self.pairs.append((f, a, b))
        self.weights = np.array(rows, np.float32).reshape(-1, x.shape[1] + 1) if len(x) else np.zeros((0, WIDTH + 1), np.float32)

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        return [self._decide(m.tolist()) for m in margins]

    def _decide(self, margins: list[float]) -> tuple[str, float]:
        lead, chosen = 10.0, self.families[0]
        n = len(self.families) if len(self.families) > 1 else 0
        if n:
            ranked = sorted(zip(margins[:n], self.families, strict=True), key=lambda p: (-p[0], p[1]))
            chosen, lead = ranked[0][1], ranked[0][0] - ranked[1][0]
        own = self.members[chosen]
        votes, sums, least = dict.fromkeys(own, 0), dict.fromkeys(own, 0.0), dict.fromkeys(own, 10.0)
        for (f, a, b), m in zip(self.pairs, margins[n:], strict=True):
            if f == chosen:
                votes[a if m >= 0 else b] += 1
                sums[a] += m
                sums[b] -= m
                least[a], least[b] = min(least[a], m), min(least[b], -m)
        best = min(own, key=lambda v: (-votes[v], -sums[v], v))
        return best, 1.0 / (1.0 + float(np.exp(-min(max(lead, 0.0), least[best]))))


def held_out(key: str = "doc_id"):
    """Rows that are never learned from; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 4 == 2


def training_rows(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(lang, features) of at most ``SAMPLE`` rows of each language, those of
    least hash. The keys are chosen first, so that only chosen texts move."""
    src = only(docs, key, text, lang).toDF("key", "text", "lang")
    known = src.filter(~held_out("key") & F.col("key").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key"))
    # a filter on row_number() is applied within every part before rows are dealt out by language
    chosen = known.select("lang", "key").withColumn("r", rank).filter(F.col("r") <= SAMPLE).select("lang", "key").distinct()
    rows = known.join(F.broadcast(chosen), ["lang", "key"])  # at most SAMPLE keys a language
    rows = rows.withColumn("r", rank).filter(F.col("r") <= SAMPLE).select("lang", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batches):
            found = [(v, describe(t)) for v, t in zip(part.column(0).to_pylist(), texts(part).to_pylist(), strict=True)]
            found = [(v, x.astype(np.float16).tobytes()) for v, x in found if x is not None]
            yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in found], pa.string()), pa.array([x for _, x in found], pa.binary())], ["lang", "features"])
    return rows.mapInArrow(run, "lang string, features binary")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Hierarchy | None:
    """Train on the bounded sample; its features pass through the driver."""
    rows = training_rows(docs, key, text, lang).toPandas()
    if not len(rows):
        return None
    rows = rows.assign(features=[bytes(x) for x in rows["features"]]).sort_values(["lang", "features"])
    x = np.stack([np.frombuffer(v, np.float16) for v in rows["features"]]).astype(np.float32)
    return Hierarchy(x, rows["lang"].tolist())


def predict(docs: DataFrame, model: Hierarchy | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every row, from the text alone."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batches, text):
            col = texts(part, text).to_pylist()
            out: list[tuple[str, float]] = [("und", 0.0)] * len(col)
            for i in range(0, len(col) if model else 0, 512):
                found = [(j, x) for j, t in enumerate(col[i:i + 512], i) if (x := describe(t)) is not None]
                if found:
                    for (j, _), got in zip(found, model.predict(np.stack([x for _, x in found])), strict=True):
                        out[j] = got
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([v for v, _ in out], pa.string()), pa.array([v for _, v in out], pa.float64())],
                ["key", "lang_pred", "score"])
    src = only(docs, key, text)
    return src.mapInArrow(run, f"key {src.schema[key].dataType.simpleString()}, lang_pred string, score double").withColumnRenamed("key", key)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score): train on the rows that are not held
    out, predict all."""
    out = predict(docs, fit(docs, key, text, lang), key, text)
    return out.select(key, held_out(key).alias("held_out"), "lang_pred", "score")
