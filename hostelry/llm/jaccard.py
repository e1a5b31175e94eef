"""N-gram Jaccard join over a token-group matrix (operator 5).

Tokens are hashes of a document's distinct word 5-grams (lower case A-Z; the
whole sequence if it has fewer words). Two documents link when
100 * intersection >= 80 * union, that is 9 * intersection >= 4 * (sum of sizes).

1. Documents with equal sets are one class; the smallest key stands for it.
2. Prefix filter: in any fixed order of all tokens, two linked sets share a token
   among the first size - ceil(0.8 * size) + 1 of each. Every set sends its
   tokens up to a fixed hash to buckets, which find out how many sets have each;
   the rarest come first in the order. Most sets have enough tokens of their own
   to be settled by that: they link with nothing. What one batch holds several
   times is sent once.
3. Stars: every class is compared with the smallest class of tokens it shares,
   if it shares enough of them. Linked ones are in one component; a large group of near copies is
   settled here with one comparison a copy and no pairs.
4. Token-group matrix: the classes of different components that share a prefix token meet in cells
   (the token's classes, in pairs of blocks of about ``BLOCK``). A cell's classes are partitioned into groups of
   ``GROUP`` similar ones (of one component, of like size); a group keeps the union of its members' tokens and their
   smallest and largest size. A class asks each group: the sizes must allow a link, and the bound of its
   overlap with the group's union must reach what its smallest possible partner needs. Only groups that pass are
   opened and their members bounded one by one. Token sets stand there as bitmaps of ``BITS`` hash values, which give
   upper bounds: a bit that the union lacks is a token that it lacks, and sets whose
   parities differ in many bits differ in as many tokens. Cells of up to ``SMALL`` classes have no groups.
   A pair counts in the first token that both classes are known to have. The classes that have a candidate come
   again with their full sets, and a cell gives links until its components are joined, so that
   its rows are fewer than its classes.
5. Components of all links found; links inside a component are not needed again.

Every comparison is exact (64-bit hashes, two for the identity of sets). No
limit is set on partners, candidates or bucket sizes.

Edge cases: null, empty or blank text has an empty set and links with nothing;
its component is its own key. A row with a null key belongs to the class of its
set; a set that only such rows have is compared with no other, and its
component is null. Repeated rows are members like others, and a key that
several texts share belongs to the components of each. A very long text is handled alone, whole,
and its set with it; one huge word is a set of one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostelry.llm.common import SUMMED_BYTES, hash_words, materialize, mix, ngram_hashes, only, partitions, settled, signed, text_chunks
from hostelry.llm.components import connected_components

N, PERCENT = 5, 80
#: All tokens up to this hash, three in ten, are sent and put first in the common order.
LIMIT = np.uint64((1 << 64) * 3 // 10)
#: Members of a group at most, and classes of a block, about.
GROUP, BLOCK = 64, 2048
#: Classes of a cell that are bounded pair by pair.
SMALL = 16
#: Bits of a set's bitmap, and first tokens of a class by which a pair is told to have met before.
BITS, FIRST = 512, 16


def shingles(raw: bytes, n: int = N) -> np.ndarray:
    """Sorted distinct token hashes of a text."""
    words = hash_words(raw.lower().split())
    if not len(words):
        return np.empty(0, np.uint64)
    if len(words) < n:
        return mix(ngram_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(ngram_hashes(words, n))


def needed(size_a, size_b):
    """Least intersection of two linked sets of these sizes (integers or arrays)."""
    return -(-(PERCENT * (size_a + size_b)) // (100 + PERCENT))


def prefix_size(size):
    """Of the first this many tokens, in any common order, linked sets share one."""
    return size - -(-PERCENT * size // 100) + 1


def head(tokens: np.ndarray) -> tuple[np.ndarray, int]:
    """The tokens that a set sends: those up to ``LIMIT``, and further ones by
    hash if these do not fill its prefix; and how many are up to LIMIT."""
    under = int(np.searchsorted(tokens, LIMIT, "right"))
    return tokens[:max(under, prefix_size(len(tokens)))], under


def identity(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes that stand for a set."""
    data = tokens.tobytes()
    return (int(np.uint64(xxhash.xxh64_intdigest(data, 1)).astype(np.int64)), int(np.uint64(xxhash.xxh64_intdigest(data, 2)).astype(np.int64)))


def bitmaps(tokens: np.ndarray) -> bytes:
    """Which of ``BITS`` hash values the tokens have, and which an odd number of them has."""
    counts = np.bincount((tokens >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64), minlength=BITS)
    return np.packbits([counts > 0, counts & 1 > 0], axis=1).tobytes()


def set_rows(docs: DataFrame) -> DataFrame:
    """(key, fp, fp2, size, bits) of each row of (key, text)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in text_chunks(batches):
            rows = [(*identity(s), len(s), bitmaps(s)) for s in map(shingles, raw)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]],
                                             ["key", "fp", "fp2", "size", "bits"])
    return docs.mapInArrow(run, "key long, fp long, fp2 long, size long, bits binary")


def shared_tokens(docs: DataFrame, buckets: int) -> DataFrame:
    """(token, fp, under) of sent tokens that two or more sets have; and for every
    set a row without token that has the number of its tokens up to ``LIMIT``."""
    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[tuple[int, bytes, bytes, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], k) for i, k in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.string()))],
                                              ["bucket", "tokens", "fps", "kind"])
        for _, raw in text_chunks(batches, limit=SUMMED_BYTES):
            distinct = {}
            for s in map(shingles, raw):
                if len(s):
                    distinct.setdefault(identity(s)[0], s)
            if not distinct:
                continue
            heads = [head(s) for s in distinct.values()]
            tokens = np.concatenate([h for h, _ in heads])
            own = np.fromiter(distinct, np.int64, len(distinct))
            fps = np.repeat(own, [len(h) for h, _ in heads])
            yield rows([(int(own[0] % buckets), np.array([n for _, n in heads], np.int64).tobytes(), own.tobytes(), "under")])
            order = np.argsort(tokens, kind="stable")
            tokens, fps = tokens[order], fps[order]
            first = np.ones(len(tokens), bool)
            first[1:] = tokens[1:] != tokens[:-1]
            several = ~first
            several[:-1] |= ~first[1:]
            # what is shared within the batch is known; its first row goes on to meet other batches
            if several.any():
                yield rows([(int(fps[0] % buckets), tokens[several].tobytes(), fps[several].tobytes(), "shared")])
            one_t, one_f = tokens[first], fps[first]
            to = (mix(one_t) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[by], np.arange(buckets + 1))
            yield rows([(b, one_t[by[x:y]].tobytes(), one_f[by[x:y]].tobytes(), "alone")
                        for b, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if y > x])

    def out(tokens: np.ndarray | None, fps: np.ndarray, unders: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(fps), 100_000):
            n = len(fps[i:i + 100_000])
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()) if tokens is None else pa.array(signed(tokens[i:i + n])), pa.array(fps[i:i + n]),
                                              pa.nulls(n, pa.int64()) if unders is None else pa.array(unders[i:i + n])], ["token", "fp", "under"])

    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            for t, f, kind in zip(b.column(0), b.column(1), b.column(2).to_pylist(), strict=True):
                fps = np.frombuffer(f.as_buffer(), np.int64)
                if kind == "under":
                    yield from out(None, fps, np.frombuffer(t.as_buffer(), np.int64))
                elif kind == "shared":
                    yield from out(np.frombuffer(t.as_buffer(), np.uint64), fps)
                else:
                    held.append((np.frombuffer(t.as_buffer(), np.uint64), fps))
        if held:
            tokens, fps = (np.concatenate([h[i] for h in held]) for i in range(2))
            order = np.lexsort((fps, tokens))
            tokens, fps = tokens[order], fps[order]
            new = np.ones(len(tokens), bool)  # a set that several batches hold counts once
            new[1:] = (tokens[1:] != tokens[:-1]) | (fps[1:] != fps[:-1])
            tokens, fps = tokens[new], fps[new]
            same = tokens[1:] == tokens[:-1]
            several = np.zeros(len(tokens), bool)
            several[1:] |= same
            several[:-1] |= same
            yield from out(tokens[several], fps[several])
    dealt = docs.mapInArrow(deal, "bucket int, tokens binary, fps binary, kind string").repartition(buckets, "bucket")
    return dealt.select("tokens", "fps", "kind").mapInArrow(across, "token long, fp long, under long").distinct()


def token_sets(docs: DataFrame) -> DataFrame:
    """(fp, tokens: bytes of the sorted set) of rows of (key, text)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw in text_chunks(batches):
            sets = {identity(s)[0]: s.tobytes() for s in map(shingles, raw)}
            yield pa.RecordBatch.from_arrays([pa.array(sets.keys(), pa.int64()), pa.array(sets.values(), pa.binary())], ["fp", "tokens"])
    return docs.mapInArrow(run, "fp long, tokens binary")


def _overlaps(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of both sides and of the intersection, row by row."""
    out = np.zeros((3, len(a)), np.int64)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
        small, large = (x, y) if len(x) <= len(y) else (y, x)
        at = np.minimum(np.searchsorted(large, small), max(len(large) - 1, 0))
        out[:, i] = len(x), len(y), int((large[at] == small).sum()) if len(large) else 0
    return out[0], out[1], out[2]


def linked(pairs: DataFrame) -> DataFrame:
    """Those (a, b) of rows (a, b, tokens_a, tokens_b) whose sets link."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y, both = _overlaps(b.column(2), b.column(3))
            yield b.select([0, 1]).filter(pa.array(both >= needed(x, y)))
    return pairs.select("a", "b", "tokens_a", "tokens_b").mapInArrow(run, "a long, b long")


def open_groups(queries: tuple, members: tuple, group: int = GROUP) -> tuple[list[np.ndarray], np.ndarray]:
    """The matrix of a cell: the members' groups (their positions), and for every query and group whether
    it must be opened. queries and members: (root, size, bitmaps of the tokens)."""
    root, size, bits = members
    order = np.lexsort((size, root))
    groups = np.split(order, np.arange(group, len(order), group))
    starts = np.arange(0, len(order), group)
    union = np.bitwise_or.reduceat(bits[order], starts, axis=0)
    low, high = np.minimum.reduceat(size[order], starts), np.maximum.reduceat(size[order], starts)
    first, last = np.minimum.reduceat(root[order], starts), np.maximum.reduceat(root[order], starts)
    q_root, q_size, q_bits = (x[:, None] for x in queries)
    lacking = np.bitwise_count(q_bits & ~union[None]).sum(axis=2, dtype=np.int64)
    # the smallest partner that the sizes allow needs the least
    least, most = np.maximum(low, -(-PERCENT * q_size // 100)), np.minimum(high, 100 * q_size // PERCENT)
    other = (first != q_root) | (last != q_root)
    return groups, (least <= most) & other & (q_size - lacking >= needed(q_size, least))


def candidates(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(class, its candidates) of a cell, by position; each pair once, and only in the first token that both
    are known to have."""
    root, size, side = (table.column(c).to_numpy() for c in ("root", "size", "side"))
    bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(root), 2, -1)
    held, odd = bits[:, 0], bits[:, 1]
    token, one = table.column("token")[0].as_py(), table.column("one")[0].as_py()
    asking, inside = (np.arange(len(root)),) * 2 if one else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    if not len(asking) or not len(inside):
        return
    first = np.full((len(root), FIRST), token, np.int64)
    for i, tokens in enumerate(table.column("first").to_pylist()):
        first[i, :len(tokens)] = tokens
    groups, opened = open_groups((root[asking], size[asking], held[asking]), (root[inside], size[inside], held[inside]))
    for k in np.flatnonzero(opened.any(axis=1)):
        i = asking[k]
        to = inside[np.concatenate([groups[g] for g in np.flatnonzero(opened[k])])]
        to = to[(root[to] != root[i]) & (100 * np.minimum(size[to], size[i]) >= PERCENT * np.maximum(size[to], size[i]))]
        if one:
            to = to[to > i]
        differ = np.bitwise_count(odd[to] ^ odd[i]).sum(axis=1, dtype=np.int64)
        to = to[(size[to] + size[i] - differ) // 2 >= needed(size[to], size[i])]
        before = first[i][first[i] < token]
        if len(before) and len(to):
            to = to[~(first[to][:, :, None] == before).any(axis=(1, 2))]
        if len(to):
            yield int(i), to


def cell_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Candidates (positions i, j) of all cells of a table sorted by cell. Most cells have a few
    classes only: these are bounded pair by pair, all cells at once."""
    cell = table.column("cell").to_numpy()
    _, at, counts = np.unique(cell, return_index=True, return_counts=True)
    few = np.repeat(counts <= SMALL, counts)
    found_i, found_j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for d in range(1, SMALL):
        i = np.flatnonzero((cell[d:] == cell[:-d]) & few[:-d])
        if not len(i):
            break
        found_i.append(i)
        found_j.append(i + d)
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    root, size, side, token, one = (table.column(c).to_numpy() for c in ("root", "size", "side", "token", "one"))
    ok = (root[i] != root[j]) & (100 * np.minimum(size[i], size[j]) >= PERCENT * np.maximum(size[i], size[j])) & (one[i] | (side[i] != side[j]))
    i, j = i[ok], j[ok]
    odd = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(root), 2, -1)[:, 1]
    ok = (size[i] + size[j] - np.bitwise_count(odd[i] ^ odd[j]).sum(axis=1, dtype=np.int64)) // 2 >= needed(size[i], size[j])
    i, j = i[ok], j[ok]
    # a token before this one that both have: they met there
    lists = table.column("first").combine_chunks()
    ends = lists.offsets.to_numpy()
    lens = np.diff(ends)
    first = np.full((len(root), FIRST), np.iinfo(np.int64).max, np.int64)
    first[np.repeat(np.arange(len(root)), lens), np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)] = lists.flatten().to_numpy()
    for k in range(0, len(i), 50_000):
        x, y, t = first[i[k:k + 50_000]], first[j[k:k + 50_000]], token[i[k:k + 50_000]]
        before = ((x[:, :, None] == y[:, None, :]) & (x < t[:, None])[:, :, None]).any(axis=(1, 2))
        i[k:k + 50_000][before] = -1
    found_i, found_j = [i[i >= 0]], [j[i >= 0]]
    for a, n in zip(at[counts > SMALL].tolist(), counts[counts > SMALL].tolist(), strict=True):
        for k, to in candidates(table.slice(a, n).combine_chunks()):
            found_i.append(np.full(len(to), a + k))
            found_j.append(a + to)
    return np.concatenate(found_i), np.concatenate(found_j)


def whole_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches, sorted by cell, as tables that no cell crosses."""
    held = None
    for b in batches:
        table = pa.Table.from_batches([b])
        table = table if held is None else pa.concat_tables([held, table])
        cell = table.column("cell").to_numpy()
        cut = int(np.searchsorted(cell, cell[-1], "left")) if len(cell) else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _by_cell(members: DataFrame) -> DataFrame:
    return members.repartition(partitions(members.sparkSession), "cell").sortWithinPartitions("cell")


def asked(members: DataFrame) -> DataFrame:
    """(cell, fp) of the classes that have a candidate in their cell, once each. members: (cell, token,
    one: both blocks are the same, side, fp, root, size, bits, first)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_cells(batches):
            some = np.zeros(table.num_rows, bool)
            for i in cell_pairs(table):
                some[i] = True
            yield from table.select(["cell", "fp"]).filter(pa.array(some)).to_batches()
    return _by_cell(members).mapInArrow(run, "cell long, fp long")


def cell_links(members: DataFrame) -> DataFrame:
    """(a, b) of links between components inside the cells, by the full sets in ``tokens``: as
    many as it takes to join what the cells of a batch can join."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_cells(batches):
            fp, root = table.column("fp").to_numpy(), table.column("root").to_pylist()
            sets = table.column("tokens").combine_chunks()
            parent: dict[int, int] = {}

            def find(x: int, parent: dict[int, int] = parent) -> int:
                while parent.get(x, x) != x:
                    x = parent[x]
                return x
            found = []
            for i, j in zip(*(x.tolist() for x in cell_pairs(table)), strict=True):
                u, v = find(root[i]), find(root[j])
                if u != v:
                    x, y, both = (int(n[0]) for n in _overlaps(sets.slice(i, 1), sets.slice(j, 1)))
                    if both >= needed(x, y):
                        parent[max(u, v)] = min(u, v)
                        found.append((int(fp[i]), int(fp[j])))
            yield pa.RecordBatch.from_arrays([pa.array([max(p) for p in found], pa.int64()), pa.array([min(p) for p in found], pa.int64())], ["a", "b"])
    return _by_cell(members).mapInArrow(run, "a long, b long")


def candidate_tokens(sent: DataFrame, classes: DataFrame) -> DataFrame:
    """(token, fp, class_id, size) of the shared tokens in the prefixes. Tokens
    up to LIMIT come first in the common order, the rarest (by the number of sets
    that have them) leading, so a set's own unshared ones open its prefix; tokens
    beyond LIMIT follow by hash."""
    shared = sent.filter("token is not null").select("token", "fp", F.col("token").between(0, int(LIMIT)).alias("low"))
    df = shared.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    unders = sent.filter("token is null").select("fp", "under")
    known = shared.filter("low").groupBy("fp").agg(F.count(F.lit(1)).alias("shared_low"))
    # what is left of a set's prefix for shared tokens; sets that have none left link with nothing
    size = F.col("size")
    left = classes.join(unders, "fp").join(known, "fp", "left").withColumn(
        "left", size - F.ceil(PERCENT * size / 100) + 1 - (F.col("under") - F.coalesce("shared_low", F.lit(0))))
    left = left.filter("left > 0").select("fp", "class_id", "size", "left")
    rank = F.row_number().over(Window.partitionBy("fp", "low").orderBy("df", "token"))
    ranked = shared.join(left, "fp").join(df, "token").withColumn("rank", rank)
    return ranked.filter("not low or rank <= left").select("token", "fp", "class_id", "size")


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) of classes (their fp): enough links for all components. docs:
    (key, text); classes: (fp, class_id: smallest key, size, bits, n: rows
    of that key) of non-empty sets."""
    buckets = partitions(docs.sparkSession)
    shared = settled(lambda: candidate_tokens(materialize(shared_tokens(docs, buckets), "jaccard-sent"), classes), "jaccard-shared")

    def sets_of(some: DataFrame, name: str) -> DataFrame:
        """(fp, tokens) of the classes in column fp, each from one of its texts."""
        near = some.select("fp").distinct().join(classes, "fp").select("fp", F.col("class_id").alias("key"), "n")
        near = materialize(near, f"{name}-classes")
        texts = docs.join(near.select("key", "n").distinct(), "key")
        once = token_sets(texts.filter("n = 1").select("key", "text"))
        repeated = token_sets(texts.filter("n > 1").select("key", "text")).join(near, "fp", "left_semi").dropDuplicates(["fp"])
        return materialize(once.unionAll(repeated), name)

    def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        one = pairs.join(sets.select(F.col("fp").alias("a"), F.col("tokens").alias("tokens_a")), "a")
        return linked(one.join(sets.select(F.col("fp").alias("b"), F.col("tokens").alias("tokens_b")), "b"))

    def both(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array(*[c for c in pairs.columns if c in ("a", "b")])).alias("fp"))
    # stars around the class with the smallest key of each token
    first = shared.groupBy("token").agg(F.min(F.struct("class_id", "fp", "size")).alias("lead"))
    stars = (shared.join(first, "token").filter("fp <> lead.fp")
             .groupBy(F.col("fp").alias("a"), F.col("lead.fp").alias("b"), "size", F.col("lead.size").alias("low"))
             .agg(F.count(F.lit(1)).alias("met")).withColumn("high", F.col("low")).filter(may_link()).select("a", "b"))
    stars = materialize(stars, "jaccard-star-pairs")
    found = settled(lambda: compared(stars, sets_of(both(stars), "jaccard-star-sets")), "jaccard-stars")
    # tokens that classes of more than one component share so far
    roots = settled(lambda: connected_components(found), "jaccard-roots")
    placed = shared.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    mixed = placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("token")
    open_ = placed.join(mixed, "token").select("token", "fp", "size", "root")
    # the matrix: the classes of each open token, in pairs of blocks
    open_ = materialize(open_, "jaccard-open")
    met = open_.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    about = open_.groupBy("fp").agg(F.slice(F.sort_array(F.collect_set("token")), 1, FIRST).alias("first"))
    about = materialize(about.join(classes.select("fp", "bits"), "fp"), "jaccard-about")
    placed = open_.join(met, "token").join(about, "fp").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    cells = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "token", (F.col("own") == F.col("other")).alias("one"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "fp", "root", "size", "bits", "first")
    near = materialize(asked(cells), "jaccard-asked")
    sets = sets_of(near, "jaccard-sets")
    return found.unionAll(cell_links(cells.join(near, ["cell", "fp"]).join(sets, "fp")))


def may_link():
    """Whether a class of ``size`` that met others of sizes low to high in ``met``
    prefix tokens can link with one. Common tokens up to the earlier end of two
    prefixes were all met; beyond it lie at most ceil(0.8 * larger size) - 1. What
    must be met is least at one end of the sizes that a partner may have."""
    small, large = f"greatest(low, ceil({PERCENT} * size / 100.0D))", f"least(high, floor(100 * size / {PERCENT}.0D))"

    def least_met(s: str) -> str:
        return f"(ceil({PERCENT} * (size + {s}) / {100 + PERCENT}.0D) - ceil({PERCENT} * greatest(size, {s}) / 100.0D) + 1)"
    return F.expr(f"{small} <= {large} and met >= least({least_met(small)}, {least_met(large)})")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, class_id, component_id) of every row. class_id: the
    smallest key with the same set."""
    src = only(docs, key, text).toDF("key", "text").withColumn("key", F.col("key").cast("long"))
    rows = materialize(set_rows(src), "jaccard-rows")
    classes = rows.filter("size > 0").groupBy("fp", "fp2").agg(
        F.min("key").alias("class_id"), F.first("size").alias("size"), F.first("bits").alias("bits"))
    times = rows.groupBy(F.col("key").alias("class_id")).agg(F.count(F.lit(1)).alias("n"))
    classes = materialize(classes.join(times, "class_id", "left"), "jaccard-classes")
    known = classes.filter("class_id is not null").select("fp", "class_id", "size", "bits", "n")
    found = settled(lambda: links(src, known), "jaccard-links")
    roots = connected_components(found).withColumnRenamed("node", "fp")
    rooted = classes.drop("bits").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    component = rooted.groupBy("root").agg(F.min("class_id").alias("component"))
    named = rooted.join(component, "root").select("fp", "fp2", "class_id", "component")
    out = rows.drop("bits").join(named, ["fp", "fp2"], "left")
    some = F.col("size") > 0
    return out.select(F.col("key").alias(key), F.col("size").alias("n_shingles"),
                      F.when(some, F.col("class_id")).otherwise(F.col("key")).alias("class_id"),
                      F.when(some, F.col("component")).otherwise(F.col("key")).alias("component_id"))
