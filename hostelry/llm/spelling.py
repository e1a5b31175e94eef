"""Spelling variants by pivotal grams (operator 12).

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z in lower case. Two words
are near if one inserted, deleted or replaced code point makes one of the other.

1. Counts: each chunk of text is cut into runs by numpy, counted by Arrow, and
   the chunks' counts are added up.
2. Order: bigrams by the number of words that hold them, rarest first. There are
   at most 90 * 90 bigrams over the alphabet, so this table is small at any size.
3. Gram prefix: the three rarest bigram occurrences of a word, and all further
   occurrences of their last bigram. One edit touches two occurrences at most.
4. Pivots: of its prefix, two disjoint bigrams that the fewest words hold, chosen by
   dynamic programming over positions. One edit spares one of them: the left one
   if it lies at or after a cut between them, else the right one. The spared pivot
   is in the partner's prefix, unless the partner's prefix ends earlier in the order;
   then the partner's spared pivot is in this word's prefix.
5. Join: words ask with their pivots, and are indexed by the bigrams of their prefix. A
   pivot's position limit is its distance from the spared end of the word, which
   the edit cannot change. Beside bigram and position the key holds the
   word without one character of the side where the edit is (or the word itself), which is what
   verification would compare: common bigrams make no more candidates than rare ones.
6. Candidates are verified by their edit distance.
7. Roots: each step from a word to its form multiplies the count by ``RISE`` or more, so
   chains are short; pointers are doubled until none changes.

Edge cases: null or empty text has no words; a null key is hashed as an empty
string. Repeated rows count as often as they stand there. Extra columns are
ignored. Without documents the result is empty. A very long text is read in
slices cut between runs; a run of more than ``LONG`` letters is one word like others,
and meets others by its variants without a bigram. Two words with the same 64-bit
id only make further candidates.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostelry.llm.common import materialize, mix, only, signed, text_chunks

#: A run loses a character if this divides its hash.
TYPO = 199
#: Code points of a word at least; occurrences of a word at least; a form's count is at least so many times the word's.
LEAST_LENGTH, LEAST_COUNT, RISE = 6, 5, 5
#: Edits touch Q bigrams each: a prefix has Q + 1, of which two are disjoint.
Q = 2
PREFIX = Q + 1
#: Distinct words counted in a task before their counts are sent on.
HELD_WORDS = 400_000
#: Rows of keys in one batch of a long run; words whose keys are made together.
ROWS, TOGETHER = 50_000, 2_000
#: Runs of more letters are no words of a language. They (and those of just so many, which may be near to both
#: kinds) meet by all their variants, as a run of one letter has as many equal bigrams as letters.
LONG = 64
#: Bytes of text counted at once.
SLICE = 1 << 20
#: The letters that runs can have.
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
_LETTERS = np.zeros(0x100, np.int64)
_LETTERS[[ord(c) for c in ALPHABET]] = range(len(ALPHABET))
_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc_of_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """crc32 of each data[start:start+length], going on from crc32 ``first``."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    crc = first[order] ^ np.uint32(0xFFFFFFFF)
    falling = -lengths
    for k in range(int(lengths[0]) if len(lengths) else 0):
        n = int(np.searchsorted(falling, -k, "left"))  # runs longer than k
        if n < 64:  # the few long runs that are left
            for i in range(n):
                rest = data[starts[i] + k:starts[i] + lengths[i]].tobytes()
                crc[i] = zlib.crc32(rest, int(crc[i] ^ np.uint32(0xFFFFFFFF))) ^ 0xFFFFFFFF
            break
        crc[:n] = _CRC[(crc[:n] ^ data[starts[:n] + k]) & np.uint32(255)] ^ (crc[:n] >> np.uint32(8))
    out = np.empty(len(crc), np.uint32)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def _in_run(data: np.ndarray) -> np.ndarray:
    """Bytes of UTF-8 that belong to runs: a-z, and the two bytes of U+00C0 to
    U+00FF, which are those that begin with 0xC3."""
    lead = data == 0xC3
    inside = ((data >= 0x61) & (data <= 0x7A)) | lead
    inside[1:] |= lead[:-1]
    return inside


def slices(text: bytes, limit: int = SLICE) -> Iterator[bytes]:
    """The text in parts of about ``limit`` bytes, cut where no run goes on."""
    at = 0
    while len(text) - at > limit:
        cut = at + limit
        while cut < len(text):
            some = np.frombuffer(text, np.uint8, min(4096, len(text) - cut), cut)
            outside = np.flatnonzero(~_in_run(some) & (some < 0x80))
            if len(outside):
                cut += int(outside[0])
                break
            cut += len(some)
        yield text[at:cut]
        at = cut
    yield text[at:]


def words_of(parts: list[tuple[bytes, bytes]]) -> tuple[pa.Array, list[str]]:
    """Runs of (key, lower-case text) parts with at least ``LEAST_LENGTH`` code
    points: those left as they are, and those that lost one."""
    data = np.frombuffer(b" " + b" ".join(t for _, t in parts) + b" ", np.uint8)
    inside = _in_run(data).view(np.int8)
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1) + 1, np.flatnonzero(step == -1) + 1
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    count = points[ends] - points[starts]
    enough = count >= LEAST_LENGTH
    starts, ends, count = starts[enough], ends[enough], count[enough]
    begins = np.cumsum([1, *(len(t) + 1 for _, t in parts)])
    first = np.array([zlib.crc32(k + b":") for k, _ in parts], np.uint32)[np.searchsorted(begins, starts, "right") - 1]
    hashes = crc_of_runs(data, starts, ends - starts, first)
    typo = hashes % TYPO == 0
    lost = []
    for i in np.flatnonzero(typo & (count > LEAST_LENGTH)):
        word = data[starts[i]:ends[i]].tobytes().decode()
        at = int(hashes[i]) % len(word)
        lost.append(word[:at] + word[at + 1:])
    lengths = (ends - starts)[~typo]
    mark = np.zeros(len(data) + 1, np.int8)
    mark[starts[~typo]] = 1
    mark[ends[~typo]] -= 1
    body = data[np.cumsum(mark[:-1]).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(body)]), lost


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of (key, text) rows: how often each word of enough code points stands there."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        def count(parts: list[tuple[bytes, bytes]]) -> None:
            whole, lost = words_of(parts)
            found = pc.value_counts(whole)
            for w, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True):
                held[w] += n
            held.update(lost)
        for part, raw in text_chunks(batches, limit=SLICE):
            keys = [b"" if k is None else str(k).encode() for k in part.column(0).to_pylist()]
            if len(raw) > 1 or len(raw[0]) <= SLICE:
                count([(k, t.lower()) for k, t in zip(keys, raw, strict=True)])  # bytes.lower: only A-Z
            else:
                for piece in slices(raw[0].lower()):
                    count([(keys[0], piece)])
                    if len(held) >= HELD_WORDS:
                        yield out()
            if len(held) >= HELD_WORDS:
                yield out()
        if held:
            yield out()
    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def gram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """bigram -> (place in the common order, words that hold it). At most 90 * 90 rows come to the driver."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter[str] = Counter()
        for b in batches:
            for w in b.column(0).to_pylist():
                df.update({w[i:i + Q] for i in range(len(w) - 1)})
        yield pa.RecordBatch.from_arrays([pa.array(df.keys(), pa.string()), pa.array(df.values(), pa.int64())], ["gram", "df"])
    rows = words.select("word").mapInArrow(run, "gram string, df long").groupBy("gram").agg(F.sum("df").alias("df")).collect()
    return {r.gram: (i, r.df) for i, r in enumerate(sorted(rows, key=lambda r: (r.df, r.gram)))}


def variants(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words of one length, given as rows of code points: hash of each word, and of it
    without each of its characters. A polynomial modulo 2^64: what follows a
    missing character moves down by one power, so none is hashed anew."""
    terms = (codes + np.uint64(1)) * np.cumprod(np.full(codes.shape[1], _BASE))
    upto = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    np.cumsum(terms, axis=1, out=upto[:, 1:])
    return upto[:, -1], upto[:, :-1] + (upto[:, -1:] - upto[:, 1:]) * _INVERSE


def pivots(weights: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the two disjoint bigrams of least total weight in each row's prefix,
    going through the positions: the best one that ends before this begins, then the
    best two so far. Ties: the leftmost."""
    m, n = weights.shape
    cost = np.where(inside, weights, np.int64(1) << 60)
    one, one_at = np.full(m, np.int64(1) << 60), np.zeros(m, np.int64)
    two, left, right = np.full(m, np.int64(1) << 61), np.zeros(m, np.int64), np.zeros(m, np.int64)
    for i in range(Q, n):
        better = cost[:, i - Q] < one
        one, one_at = np.where(better, cost[:, i - Q], one), np.where(better, i - Q, one_at)
        better = one + cost[:, i] < two
        two, left, right = np.where(better, one + cost[:, i], two), np.where(better, one_at, left), np.where(better, i, right)
    return left, right


def _tag(side: int, rank: np.ndarray, at) -> np.ndarray:
    return mix((rank.astype(np.uint64) * np.uint64(2) + np.uint64(side)) << np.uint64(32) | np.asarray(at).astype(np.uint64))


def key_rows(words: list[str], place: np.ndarray, df: np.ndarray) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray]]:
    """(asks, words' numbers, keys, last bigrams of the prefixes) of words of one length up to ``LONG``.
    Key: hash of side, bigram, its distance from the spared end, and the word as it is
    or without one character of the other side. place: of each pair of letters in the
    common order; df: words that hold the bigram of each place."""
    n = len(words[0])
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, n).astype(np.uint64)
    letters = _LETTERS[codes.astype(np.int64)]
    ranks = place[letters[:, :-1], letters[:, 1:]]
    last = np.partition(ranks, PREFIX - 1, axis=1)[:, PREFIX - 1]
    inside = ranks <= last[:, None]
    p1, p2 = pivots(df[ranks], inside)
    cut = np.clip(n // 2, p1 + Q, p2)
    whole, without = variants(codes)
    every, at = np.arange(len(words)), np.arange(n)

    def rows(asks: bool, who: np.ndarray, tag: np.ndarray, which: np.ndarray):
        """The words ``who`` with their tags, whole and without each character of ``which``."""
        i, e = np.nonzero(which)
        yield asks, who, mix(whole[who] + tag), last[who]
        yield asks, who[i], mix(without[who[i], e] + tag[i]), last[who[i]]
    yield from rows(True, every, _tag(0, ranks[every, p1], p1), at >= cut[:, None])
    yield from rows(True, every, _tag(1, ranks[every, p2], n - p2), at < cut[:, None])
    for q in range(n - 1):
        who = np.flatnonzero(inside[:, q])
        if len(who):
            yield from rows(False, who, _tag(0, ranks[who, q], np.full(len(who), q)), np.broadcast_to(at >= q + Q, (len(who), n)))
            yield from rows(False, who, _tag(1, ranks[who, q], np.full(len(who), n - q)), np.broadcast_to(at < q, (len(who), n)))


def long_rows(word: str) -> Iterator[tuple[bool, np.ndarray]]:
    """(asks, keys) of a run of ``LONG`` or more letters: as it is, and without each of its characters."""
    whole, without = variants(np.frombuffer(word.encode("utf-32-le"), np.uint32)[None, :].astype(np.uint64))
    found = mix(np.unique(np.concatenate([whole, without[0]])) + _MULT)
    for i in range(0, len(found), ROWS):
        yield True, found[i:i + ROWS]
        yield False, found[i:i + ROWS]


def keys(words: DataFrame, ranks: dict[str, tuple[int, int]]) -> DataFrame:
    """(asks, key, id, last: place in the order of the prefix's last bigram) of rows (id, word)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, df = np.zeros((len(ALPHABET), len(ALPHABET)), np.int64), np.zeros(max(len(ranks), 1), np.int64)
        for gram, (i, n) in ranks.items():
            place[ALPHABET.index(gram[0]), ALPHABET.index(gram[1])], df[i] = i, n

        def batch(asks: bool, ids: np.ndarray, key: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), asks)), pa.array(ids), pa.array(signed(key)), pa.array(last.astype(np.int32))],
                                              ["asks", "id", "key", "last"])
        for b in batches:
            ids, by_length = b.column(0).to_numpy(), {}
            for i, w in enumerate(b.column(1).to_pylist()):
                if len(w) >= LONG:
                    for asks, key in long_rows(w):
                        yield batch(asks, np.full(len(key), ids[i]), key, np.zeros(len(key)))
                if len(w) <= LONG:
                    by_length.setdefault(len(w), []).append((i, w))
            for same in by_length.values():
                for k in range(0, len(same), TOGETHER):
                    numbers = np.array([i for i, _ in same[k:k + TOGETHER]])
                    for asks, who, key, last in key_rows([w for _, w in same[k:k + TOGETHER]], place, df):
                        if len(key):
                            yield batch(asks, ids[numbers[who]], key, last)
    return words.select("id", "word").mapInArrow(run, "asks boolean, id long, key long, last int")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b) of near words of rows (id, word): each pair in both directions."""
    rows = materialize(keys(words, gram_ranks(words)), "spelling-keys")
    asking = rows.filter("asks").select("key", F.col("id").alias("id_a"), F.col("last").alias("last_a"))
    index = rows.filter("not asks").select("key", F.col("id").alias("id_b"), F.col("last").alias("last_b"))
    met = asking.join(index, "key").filter("last_a <= last_b and id_a <> id_b")
    met = met.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()
    named = met.join(words.select(F.col("id").alias("id_a"), F.col("word").alias("a")), "id_a")
    named = named.join(words.select(F.col("id").alias("id_b"), F.col("word").alias("b")), "id_b")
    found = materialize(named.filter(F.levenshtein("a", "b", 1) == 1).select("a", "b"), "spelling-pairs")
    return found.unionAll(found.select("b", "a"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form), form not null: the end of each chain. Each
    round doubles the steps taken; chains have at most 27 steps, as counts rise by ``RISE``."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = materialize(step, "spelling-roots")
        now = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word with enough code points and occurrences."""
    counted = word_counts(only(docs, key, text).toDF("key", "text"))
    words = materialize(counted.filter(F.col("n") >= LEAST_COUNT).withColumn("id", F.xxhash64("word")), "spelling-words")
    pairs = near_pairs(words)
    counts = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    best = pairs.join(counts, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b"))).alias("best"))
    chosen = words.join(best, "word", "left")
    rises = -F.col("best.less") >= RISE * F.col("n")
    chosen = chosen.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(rises, F.col("best.b")).alias("form"), F.when(rises, -F.col("best.less")).alias("form_n"))
    chosen = materialize(chosen, "spelling-forms")
    ends = roots(chosen.filter("form is not null"))
    return chosen.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
