"""MinHash near-duplicates (operator 13).

A document's set is its distinct word 5-grams (lower case A-Z; the whole sequence
if it has fewer words). Two documents link when 100 * intersection >= 85 * union.

1. Documents with equal sets are one class; the smallest key stands for it.
2. Signature: the minima of ``ROWS * BANDS`` universal hashes over the set, a byte of each.
3. Banding: classes that agree in all ``ROWS`` bytes of a band share a bucket. Two sets
   at the threshold share none of the 40 buckets with a chance of 6 in 10^9, more similar
   ones with less; nothing else can lose a link.
4. Stars: in each bucket every class is compared with the one that has most company in
   all its buckets, such as the original of many edited copies: one comparison a member, no pairs.
5. What still is in different components inside a bucket meets in cells, pairs of blocks of at most
   ``BLOCK`` classes: first signatures against signatures, which names the members that have a candidate, then
   the full sets of these. A pair counts in the first band it shares only, and a cell gives
   links until its components are joined, so its rows are fewer than its members.
6. Candidates are pairs whose sizes allow a link and whose signatures agree in ``AGREE`` places (seven standard
   deviations under what is expected at the threshold); links are confirmed on the full sets.
7. Components by alternating large-star and small-star.

No limit is set on buckets, partners or candidates.

Edge cases: null, empty or blank text has an empty set, links with nothing and is its
own component. A row with a null key belongs to the class of its set; a set
that only such rows have is compared with no other and has a null component.
Repeated rows are members like others; a key that several texts share belongs to the
components of each. A very long text is hashed in parts of ``PART`` tokens. Extra
columns are ignored; without documents the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostelry.llm.common import hash_words, materialize, mix, ngram_hashes, only, text_chunks
from hostelry.llm.components import connected_components

N, PERCENT = 5, 85
#: Minima of a band, and bands.
ROWS, BANDS = 6, 40
#: Places in which the signatures of a candidate pair agree at least.
AGREE = 165
#: Classes of a block, about.
BLOCK = 512
#: Tokens hashed at once, and bytes of text.
PART, SLICE = 1 << 16, 1 << 20
#: Universal hashes x -> (a x + b) mod 2^64, of which the upper bits count; a is odd. Fixed by the seed.
_A, _B = np.random.default_rng(13).integers(0, 1 << 64, (2, ROWS * BANDS), np.uint64) | np.array([[1], [0]], np.uint64)


def tokens_of(raw: bytes) -> np.ndarray:
    """Sorted distinct token hashes of a text."""
    words = hash_words(raw.lower().split())
    if not len(words):
        return np.empty(0, np.uint64)
    if len(words) < N:
        return mix(ngram_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(ngram_hashes(words, N))


def identity(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes that stand for a set."""
    data = tokens.tobytes()
    return tuple(int(np.uint64(xxhash.xxh64_intdigest(data, seed)).astype(np.int64)) for seed in (1, 2))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``ROWS * BANDS`` bytes for each of the non-empty sets."""
    least = np.full((len(_A), len(sets)), np.iinfo(np.uint64).max, np.uint64)
    every = np.concatenate(sets)
    ends = np.cumsum([len(s) for s in sets])
    for start in range(0, len(every), PART):
        part = every[start:start + PART]
        first, last = np.searchsorted(ends, [start, start + len(part) - 1], "right")
        cuts = np.maximum(np.concatenate([[0], ends[first:last]]) - np.array([0] + [start] * (last - first)), 0)
        for i, (a, b) in enumerate(zip(_A, _B, strict=True)):
            own = np.minimum.reduceat(part * a + b, cuts)
            np.minimum(least[i, first:last + 1], own, out=least[i, first:last + 1])
    return np.ascontiguousarray((least >> np.uint64(32)).astype(np.uint8).T)


def set_rows(docs: DataFrame) -> DataFrame:
    """(key, fp, fp2, size, sig) of each row of (key, text)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in text_chunks(batches, limit=SLICE):
            sets = [tokens_of(r) for r in raw]
            named = [identity(s) for s in sets]
            different = {fp: s for fp, s in zip(named, sets, strict=True) if len(s)}
            sigs = dict(zip(different, signatures(list(different.values())) if different else [], strict=True))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([a for a, _ in named], pa.int64()), pa.array([b for _, b in named], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([sigs[fp].tobytes() if fp in sigs else None for fp in named], pa.binary())],
                ["key", "fp", "fp2", "size", "sig"])
    return docs.mapInArrow(run, "key long, fp long, fp2 long, size long, sig binary")


def token_sets(docs: DataFrame) -> DataFrame:
    """(fp, tokens: bytes of the sorted set) of rows of (key, text)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw in text_chunks(batches, limit=SLICE):
            sets = {identity(s)[0]: s.tobytes() for s in map(tokens_of, raw)}
            yield pa.RecordBatch.from_arrays([pa.array(sets.keys(), pa.int64()), pa.array(sets.values(), pa.binary())], ["fp", "tokens"])
    return docs.mapInArrow(run, "fp long, tokens binary")


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two full sets link."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def linked(pairs: DataFrame) -> DataFrame:
    """Those (a, b) of rows (a, b, tokens_a, tokens_b) whose full sets link."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                    for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return pairs.select("a", "b", "tokens_a", "tokens_b").mapInArrow(run, "a long, b long")


def agreeing(pairs: DataFrame) -> DataFrame:
    """Those (a, b) of rows (a, b, sig_a, sig_b) whose signatures agree enough."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_matrix(batch.column(i)) for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((x == y).sum(1) >= AGREE))
    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, ROWS * BANDS)


def _near(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(row, later or opposite rows whose signatures agree enough) of a cell: members of different
    components whose sizes allow a link, in the first band that they share."""
    root, size, side = (table.column(c).to_numpy() for c in ("root", "size", "side"))
    sig = _matrix(table.column("sig"))
    band, one = table.column("band")[0].as_py(), table.column("one")[0].as_py()
    across = np.flatnonzero(side == 1)
    for i in range(table.num_rows) if one else np.flatnonzero(side == 0):
        to = np.arange(i + 1, table.num_rows) if one else across
        to = to[(root[to] != root[i]) & (100 * np.minimum(size[to], size[i]) >= PERCENT * np.maximum(size[to], size[i]))]
        if len(to):
            same = sig[to] == sig[i]
            to, same = (x[same.sum(1) >= AGREE] for x in (to, same))
            to = to[same.reshape(-1, BANDS, ROWS).all(2).argmax(1) == band]
        if len(to):
            yield int(i), to


def near_members(members: DataFrame) -> DataFrame:
    """(cell, fp) of the members that have a candidate in their cell, once each. members: (cell:
    bucket and pair of blocks, band, one: both blocks are the same, side, fp, root, size, sig)."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        some = np.zeros(table.num_rows, bool)
        for i, to in _near(table):
            some[i] = some[to] = True
        return table.select(["cell", "fp"]).filter(pa.array(some))
    return members.groupBy("cell").applyInArrow(run, "cell long, fp long")


def cell_links(members: DataFrame) -> DataFrame:
    """(a, b) of the links between components inside each cell, by the full sets in ``tokens``;
    as many as it takes to join them, so fewer than the cell has members."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        fp, root = table.column("fp").to_numpy(), table.column("root").to_pylist()
        sets = [np.frombuffer(t.as_buffer(), np.uint64) for t in table.column("tokens").combine_chunks()] if table.num_rows else []
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x
        found = []
        for i, to in _near(table):
            for j in to:
                x, y = find(root[i]), find(root[j])
                if x != y and _linked(sets[i], sets[j]):
                    parent[max(x, y)] = min(x, y)
                    found.append((int(fp[i]), int(fp[j])))
        return pa.table({"a": pa.array([max(p) for p in found], pa.int64()), "b": pa.array([min(p) for p in found], pa.int64())})
    return members.groupBy("cell").applyInArrow(run, "a long, b long")


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) of classes (their fp): enough links for all components. docs: (key, text);
    classes: (fp, class_id: smallest key, size, sig, n: rows of that key) of non-empty sets."""
    def sets_of(some: DataFrame, name: str) -> DataFrame:
        """(fp, tokens) of the classes in column fp, each from one of its texts."""
        own = some.select("fp").distinct().join(classes, "fp").select("fp", F.col("class_id").alias("key"), "n")
        own = materialize(own, f"{name}-classes")
        texts = docs.join(own.select("key", "n").distinct(), "key")
        once = token_sets(texts.filter("n = 1").select("key", "text"))
        repeated = token_sets(texts.filter("n > 1").select("key", "text")).join(own, "fp", "left_semi").dropDuplicates(["fp"])
        return materialize(once.unionAll(repeated), name)

    def compared(pairs: DataFrame) -> DataFrame:
        """Links among pairs (a, b), by signatures and then by the full sets of what is left."""
        sigs = classes.select("fp", "sig")
        near = materialize(agreeing(pairs.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b")), "minhash-near")
        sets = sets_of(near.select(F.explode(F.array("a", "b")).alias("fp")), "minhash-star-sets")
        return materialize(linked(near.join(sets.toDF("a", "tokens_a"), "a").join(sets.toDF("b", "tokens_b"), "b")), "minhash-links")

    allowed = F.expr(f"100 * least(size, size_b) >= {PERCENT} * greatest(size, size_b)")
    bucket = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                         lambda i: F.struct(i.alias("band"), F.xxhash64(i, F.substring("sig", i * ROWS + 1, F.lit(ROWS))).alias("bucket")))
    entries = classes.select("fp", "size", F.explode(bucket).alias("e")).select("e.band", "e.bucket", "fp", "size")
    company = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("company")).filter("company > 1")
    shared = materialize(entries.join(company, "bucket"), "minhash-shared")
    # stars around the class with most company
    known = shared.groupBy("fp").agg(F.sum("company").alias("all"))
    lead = shared.join(known, "fp").groupBy("bucket").agg(F.max(F.struct("all", F.col("fp").alias("b"), F.col("size").alias("size_b"))).alias("lead"))
    stars = shared.join(lead.select("bucket", "lead.b", "lead.size_b"), "bucket").filter(F.col("fp") != F.col("b")).filter(allowed)
    stars = materialize(stars.select(F.greatest("fp", "b").alias("a"), F.least("fp", "b").alias("b")).distinct(), "minhash-stars")
    found = compared(stars)
    # buckets that still hold several components
    roots = materialize(connected_components(found), "minhash-roots")
    placed = shared.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("bucket")
    blocks = F.ceil(F.col("company") / BLOCK).cast("int")
    open_ = placed.join(mixed, "bucket").join(classes.select("fp", "sig"), "fp").withColumn("blocks", blocks)
    open_ = open_.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cells = open_.select("*", other).select(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "band", (F.col("own") == F.col("other")).alias("one"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "fp", "root", "size", "sig")
    cells = materialize(cells, "minhash-cells")
    asked = materialize(near_members(cells), "minhash-asked")
    sets = sets_of(asked, "minhash-sets")
    return found.unionAll(cell_links(cells.join(asked, ["cell", "fp"]).join(sets, "fp")))


def minhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, class_id, component_id, kept) of every row. class_id: the
    smallest key with the same set; kept: the key is its component's."""
    src = only(docs, key, text).toDF("key", "text").withColumn("key", F.col("key").cast("long"))
    rows = materialize(set_rows(src), "minhash-rows")
    classes = rows.filter("size > 0").groupBy("fp", "fp2").agg(F.min("key").alias("class_id"), F.first("size").alias("size"), F.first("sig").alias("sig"))
    times = rows.groupBy(F.col("key").alias("class_id")).agg(F.count(F.lit(1)).alias("n"))
    classes = materialize(classes.join(times, "class_id", "left"), "minhash-classes")
    found = links(src, classes.filter("class_id is not null").select("fp", "class_id", "size", "sig", "n"))
    roots = materialize(connected_components(found), "minhash-components").withColumnRenamed("node", "fp")
    rooted = classes.select("fp", "fp2", "class_id").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    component = rooted.groupBy("root").agg(F.min("class_id").alias("component"))
    named = rooted.join(component, "root").select("fp", "fp2", "class_id", "component")
    out = rows.select("key", "fp", "fp2", "size").join(named, ["fp", "fp2"], "left")
    some = F.col("size") > 0
    out = out.select(F.col("key").alias(key), F.col("size").alias("n_shingles"), F.when(some, F.col("class_id")).otherwise(F.col("key")).alias("class_id"),
                     F.when(some, F.col("component")).otherwise(F.col("key")).alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
