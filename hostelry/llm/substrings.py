"""Substring deduplication by prefix-partitioned window hashes, which stand in for suffix trees (operator 1).

A window is ``WINDOW`` consecutive words. A word goes if a window that covers it
has the same words as a window of a document with a smaller key; all windows are
judged on the input.

1. Documents with equal words are one class. All but those with its smallest
   key lose every word (with WINDOW words or more) and need no search.
2. Suffixes that can matter: the anchor of a window is the ``GRAM`` words of
   least hash in it. Equal windows have equal anchors, so only windows whose
   anchor occurs in another class are candidates, about one anchor in twenty
   words is compared, and all repeats are found. Runs of candidates are kept as
   stretches of word hashes.
3. The candidates' suffixes are dealt into groups by a prefix of their words, 8
   words long, and longer (``LADDER``) where a group would exceed
   ``GROUP_SUFFIXES``. What one batch holds several times is settled there and
   sent once, so a passage that a third of all documents share stays small.
4. In each group the suffixes are sorted by the hash of their first WINDOW words.
   No tree is built: equal hashes are the leaves that would hang below one node
   of depth WINDOW. Those whose key is above the node's smallest are repeats.
5. The repeats of a document, merged, are its maximal repeated spans.

Hashes are 64 bits wide; a class is known by SHA-256.

Edge cases: null, empty and blank texts have no words and lose none. Rows with a
null key keep all words and are nobody's repeat. Rows with equal keys are never
repeats of each other. A window that recurs only inside its own document stays. A very long
text is handled alone in its task, whole; one huge word is one word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostelry.llm.common import SUMMED_BYTES, hash_words, materialize, mix, ngram_hashes, only, partitions, settled, signed, text_chunks

WINDOW, GRAM = 50, 8
LADDER = (8, 16, 32, WINDOW)
#: Places are numbered through all texts of a key: text number times this, plus the word.
TEXT_STRIDE = 1 << 40
#: Suffixes (24 bytes each) that a group is meant to hold at most.
GROUP_SUFFIXES = 4_000_000


def class_of(words: list[bytes]) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words))).astype(np.int64))


def window_anchors(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Anchor (least gram hash) of each window of a document's word hashes."""
    low = ngram_hashes(hashes, gram)
    width, have = window - gram + 1, 1
    if len(low) < width:
        return np.empty(0, np.uint64)
    while have < width:  # minimum over runs of twice the length
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low


def row_facts(docs: DataFrame) -> DataFrame:
    """(key, class, sha: SHA-256 of the words joined by a space, n_words)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in text_chunks(batches, limit=SUMMED_BYTES):
            rows = []
            for x in raw:
                words = x.split()
                rows.append((class_of(words), hashlib.sha256(b" ".join(words)).digest(), len(words)))
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.binary(), pa.int64()))]],
                                             ["key", "class", "sha", "n_words"])
    return docs.mapInArrow(run, "key long, class long, sha binary, n_words long")


def anchors(docs: DataFrame, window: int) -> DataFrame:
    """(anchor, class) of documents with a key, repeated classes of a batch once."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw in text_chunks(batches, limit=SUMMED_BYTES):
            found: dict[int, np.ndarray] = {}
            for x in raw:
                words = x.split()
                if len(words) >= window and (c := class_of(words)) not in found:
                    found[c] = np.unique(window_anchors(hash_words(words), window))
            if found:
                classes = np.repeat(np.fromiter(found, np.int64, len(found)), [len(a) for a in found.values()])
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(list(found.values())))), pa.array(classes)], ["anchor", "class"])
    return docs.filter("key is not null").mapInArrow(run, "anchor long, class long")


def stretches(near: DataFrame, window: int) -> DataFrame:
    """(key, class, start, words: bytes of word hashes, n: windows) for each run
    of windows of (key, text, class, nth, shared) whose anchors are shared."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in text_chunks(batches, limit=SUMMED_BYTES):
            rows = []
            for key, x, c, nth, shared in zip(part.column(0).to_pylist(), raw, part.column(2).to_pylist(), part.column(3).to_pylist(), part.column(4), strict=True):
                words = x.split()
                if class_of(words) != c:  # another text under the same key
                    continue
                h = hash_words(words)
                here = np.isin(signed(window_anchors(h, window)), shared.values.to_numpy())
                edges = np.flatnonzero(np.diff(here.astype(np.int8), prepend=0, append=0))
                rows += [(key, c, nth * TEXT_STRIDE + a, h[a:b + window - 1].tobytes(), b - a) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))],
                                             ["key", "class", "start", "words", "n"])
    return near.select("key", "text", "class", "nth", "shared").mapInArrow(run, "key long, class long, start long, words binary, n long")


def prefix_groups(prefixes: dict[int, np.ndarray], plan: np.ndarray) -> np.ndarray:
    """Group of each suffix. prefixes: hash of the first n words, by n. plan:
    a row (prefix length, parts, first group) for each bucket of 8-word prefixes."""
    bucket = (prefixes[LADDER[0]] % np.uint64(len(plan))).astype(np.int64)
    length, parts, first = plan[bucket].T
    out = first.copy()
    for n in np.unique(length):
        if n != LADDER[0]:
            at = length == n
            out[at] += (mix(prefixes[int(n)][at]) % parts[at].astype(np.uint64)).astype(np.int64)
    return out


def suffix_prefixes(words: np.ndarray, count: int, ladder: tuple[int, ...]) -> dict[int, np.ndarray]:
    return {n: ngram_hashes(words, n)[:count] for n in ladder}


def plan_groups(found: DataFrame, buckets: int, window: int, limit: int = GROUP_SUFFIXES) -> np.ndarray:
    """Prefix length and parts of each bucket: the shortest prefix of the ladder
    that keeps its groups within the limit. One row a bucket reaches the driver."""
    ladder = (*[n for n in LADDER if n < window], window)

    def counted(n: int, parts: np.ndarray) -> np.ndarray:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = np.cumsum(parts) - parts
            total = np.zeros(int(parts.sum()), np.int64)
            for b in batches:
                for raw, count in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                    p = suffix_prefixes(np.frombuffer(raw.as_buffer(), np.uint64), count, (ladder[0], n))
                    bucket = (p[ladder[0]] % np.uint64(buckets)).astype(np.int64)
                    total += np.bincount(first[bucket] + (mix(p[n]) % parts[bucket].astype(np.uint64)).astype(np.int64), minlength=len(total))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["part", "n"])
        rows = found.select("words", "n").mapInArrow(run, "part long, n long").groupBy("part").agg(F.sum("n").alias("n")).toPandas()
        total = np.zeros(int(parts.sum()), np.int64)
        total[rows["part"].to_numpy()] = rows["n"].to_numpy()
        return total
    parts = np.ones(buckets, np.int64)
    size = counted(ladder[0], parts)
    length = np.full(buckets, ladder[0])
    for n in ladder[1:]:
        over = np.maximum.reduceat(size, np.cumsum(parts) - parts) > limit
        if not over.any():
            break
        whole = np.add.reduceat(size, np.cumsum(parts) - parts)
        length[over] = n
        parts = np.where(over, -(-2 * whole // limit), parts)
        size = counted(n, parts) if n != ladder[-1] else np.zeros(int(parts.sum()), np.int64)
    return np.column_stack([length, parts, np.cumsum(parts) - parts])


def _marks(keys: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """(key, starts: bytes of int64) rows."""
    order = np.lexsort((starts, keys))
    keys, starts = keys[order], starts[order].astype(np.int64)
    cuts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1)) if len(keys) else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(keys[cuts], pa.int64()), pa.array([x.tobytes() for x in np.split(starts, cuts[1:])] if len(cuts) else [], pa.binary())], ["key", "starts"])


def _least_key(node: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (node, key), and for each place the node's smallest key."""
    order = np.lexsort((keys, node))
    ranked = node[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    return order, keys[order][np.maximum.accumulate(np.where(new, np.arange(len(ranked)), 0))]


def repeated_windows(found: DataFrame, window: int, buckets: int) -> DataFrame:
    """(key, starts) of the windows that also start in a document of smaller key."""
    plan = plan_groups(found, buckets, window)
    ladder = tuple(sorted({LADDER[0] if LADDER[0] < window else window, window, *plan[:, 0].tolist()}))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        names = ["group", "key", "nodes", "keys", "starts"]
        for b in batches:
            raw = [np.frombuffer(w.as_buffer(), np.uint64) for w in b.column(1)]
            counts = b.column(2).to_numpy()
            if not len(raw):
                continue
            prefixes = [suffix_prefixes(w, n, ladder) for w, n in zip(raw, counts.tolist(), strict=True)]
            at = {n: np.concatenate([p[n] for p in prefixes]) for n in ladder}
            keys = np.repeat(b.column(0).to_numpy(), counts)
            starts = np.concatenate([np.arange(s, s + n) for s, n in zip(b.column(3).to_pylist(), counts.tolist(), strict=True)])
            order, least = _least_key(at[window], keys)
            later = keys[order] > least
            settled = _marks(keys[order[later]], starts[order[later]])
            n = settled.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([-1] * n, pa.int64()), settled.column(0), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), settled.column(1)], names)
            own = order[~later]
            group = prefix_groups({k: v[own] for k, v in at.items()}, plan)
            by = np.argsort(group, kind="stable")
            nodes, keys, starts, group = at[window][own][by], keys[own][by], starts[own][by].astype(np.int64), group[by]
            cuts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
            rows = [(int(group[x]), None, nodes[x:y].tobytes(), keys[x:y].tobytes(), starts[x:y].tobytes()) for x, y in zip(cuts, [*cuts[1:], len(group)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    def subtrees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def leaves() -> pa.RecordBatch:
            nodes, keys, starts = (np.concatenate([h[i] for h in held]) for i in range(3))
            order, least = _least_key(nodes, keys)
            later = order[keys[order] > least]
            return _marks(keys[later], starts[later])
        now = None
        for b in batches:
            for group, *data in zip(b.column(0).to_pylist(), b.column(1), b.column(2), b.column(3), strict=True):
                if group != now and held:
                    yield leaves()
                    held = []
                now = group
                held.append(tuple(np.frombuffer(x.as_buffer(), k) for x, k in zip(data, (np.uint64, np.int64, np.int64), strict=True)))
        if held:
            yield leaves()
    dealt = materialize(found.select("key", "words", "n", "start").mapInArrow(deal, "group long, key long, nodes binary, keys binary, starts binary"), "suffix-groups")
    inner = dealt.filter("group < 0").select("key", "starts")
    outer = (dealt.filter("group >= 0").select("group", "nodes", "keys", "starts").repartition(buckets, "group")
             .sortWithinPartitions("group").mapInArrow(subtrees, "key long, starts binary"))
    return inner.unionAll(outer)


def covered(starts: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Words inside any of the windows."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:-1]) > 0


def removals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, found: array of (class, nth, copy, marks)): for each key with a text
    that loses words, its texts by class; copy: all words go, else marks holds
    the starts of the windows that go. docs: (key, text)."""
    return settled(lambda: _removals(docs, window), "substring-removals")


def _removals(docs: DataFrame, window: int) -> DataFrame:
    buckets = partitions(docs.sparkSession)
    rows = materialize(row_facts(docs.filter("key is not null")).filter(F.col("n_words") >= window).select("key", "class", "sha"), "substring-rows")
    classes = rows.groupBy("class", "sha").agg(F.min("key").alias("first"))
    # anchors that two classes have
    found = anchors(docs, window)
    shared = found.groupBy("anchor").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo < hi").select("anchor")
    near = found.join(shared, "anchor").groupBy("class").agg(F.collect_set("anchor").alias("shared"))
    # several texts of one key are told apart by their number
    nth = (F.row_number().over(Window.partitionBy("first").orderBy("class")) - 1).alias("nth")
    numbered = materialize(classes.select("class", F.col("first").alias("key"), nth), "substring-classes")
    runs = materialize(stretches(docs.join(near.join(numbered, "class"), "key"), window), "substring-stretches")
    marks = repeated_windows(runs, window, buckets).groupBy("key").agg(F.collect_list("starts").alias("marks"))
    marked = marks.join(numbered, "key").select("key", "class", "nth", F.lit(False).alias("copy"), "marks")
    copies = rows.join(classes, ["class", "sha"]).filter(F.col("key") > F.col("first")).select("key", "class").distinct()
    copies = copies.select("key", "class", F.lit(0).alias("nth"), F.lit(True).alias("copy"), F.lit(None).cast("array<binary>").alias("marks"))
    every = marked.unionAll(copies)
    return every.groupBy("key").agg(F.collect_list(F.struct("class", "nth", "copy", "marks")).alias("found"))


def kept_words(raw: bytes, found: list[dict] | None, window: int) -> tuple[list[bytes], int]:
    """The words that a text keeps, and how many it had."""
    words = raw.split()
    own = class_of(words) if found else None
    for text in found or ():
        if text["class"] == own:
            if text["copy"]:
                return [], len(words)
            starts = np.frombuffer(b"".join(text["marks"]), np.int64)
            gone = covered(starts[starts // TEXT_STRIDE == text["nth"]] % TEXT_STRIDE, len(words), window)
            return [w for w, g in zip(words, gone.tolist(), strict=True) if not g], len(words)
    return words, len(words)


def with_removals(docs: DataFrame, key: str, text: str, window: int) -> tuple[DataFrame, str]:
    """``docs`` with what ``removals`` found in a further column, and its name."""
    src = only(docs, key, text).toDF("key", "text").withColumn("key", F.col("key").cast("long"))
    gone = removals(src, window)
    name = next(n for n in ("found", *(f"found_{i}" for i in range(len(docs.columns) + 1))) if n not in docs.columns)
    gone = gone.select(F.col("key").alias("__key"), F.col("found").alias(name))
    return docs.join(gone, F.col(f"`{key}`").cast("long") == F.col("__key"), "left").drop("__key"), name


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row."""
    joined, found = with_removals(only(docs, key, text), key, text, window)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in text_chunks(batches, text, SUMMED_BYTES):
            rows = []
            for x, f in zip(raw, part.column(2), strict=True):
                kept, n = kept_words(x, f.as_py(), window)
                rows.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.string()))]],
                                             ["key", "n_words", "n_removed", "kept_sha256"])
    kind = docs.schema[key].dataType.simpleString()
    out = joined.select(key, text, found).mapInArrow(run, f"key {kind}, n_words long, n_removed long, kept_sha256 string")
    return out.withColumnRenamed("key", key)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the words left, joined by a space, as text where some go;
    other texts unchanged, and rows that lose all their words dropped."""
    columns, schema = docs.columns, docs.schema
    at = columns.index(text)
    joined, found = with_removals(docs, key, text, window)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in text_chunks(batches, text, SUMMED_BYTES):
            old, new, stay = part.column(at).to_pylist(), [], []
            for x, f, was in zip(raw, part.column(len(columns)), old, strict=True):
                if f.is_valid:
                    kept, n = kept_words(x, f.as_py(), window)
                    was = b" ".join(kept).decode() if len(kept) < n else was
                    stay.append(bool(kept) or not n)
                else:
                    stay.append(True)
                new.append(was)
            out = part.set_column(at, part.schema.field(at), pa.array(new, part.column(at).type)).select(range(len(columns)))
            yield out.filter(pa.array(stay, pa.bool_()))
    return joined.select(*[f"`{c}`" for c in columns], found).mapInArrow(run, schema)
