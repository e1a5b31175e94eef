"""MinHash near-duplicates against plain versions."""
# ruff: noqa: F811
import random

import numpy as np
import pytest
from llm_fixtures import docs, empty, lspark  # noqa: F401
from pyspark.sql import functions as F

from hostelry.llm import minhash
from hostelry.llm.common import mix


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def plain(data):
    """Rows (key, size, component, kept) from all pairs of (key, text) rows without null keys."""
    sets = [(k, shingles(t)) for k, t in data]
    parent = {k: k for k, _ in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return sorted((k, len(s), find(k), find(k) == k) for k, s in sets)


def found(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        words[i:i + rng.choice([0, 1, 1, 2])] = [f"e{rng.randrange(10 ** 6)}"] * rng.choice([0, 1, 1])
    return words


def family(seed, size, edits, length):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(length)]
    return [" ".join(edited(rng, base, rng.randint(*edits))) for _ in range(size)]


@pytest.mark.parametrize("block", [3, 1024])
def test_edited_copies(lspark, monkeypatch, block):
    """Groups of copies at all distances around the threshold, many of them unlinked neighbours in one bucket."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = family(1, 60, (0, 12), 200) + family(2, 60, (2, 5), 90) + family(3, 40, (1, 3), 300) + family(4, 30, (0, 1), 12)
    random.Random(5).shuffle(texts)
    data = [(i * 3, t) for i, t in enumerate(texts)]
    df = lspark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = found(minhash.minhash_components(df))
    assert got == plain(data) and 20 < sum(r[3] for r in got) < 170


def test_odd_rows(lspark, docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = minhash.minhash_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "class_id", "component_id", "kept"]
    assert found(got.filter("doc_id is not null")) == plain([r for r in rows if r[0] is not None])
    nameless = got.filter("doc_id is null").collect()
    assert [(r.n_shingles, r.component_id, r.kept) for r in nameless] == [(16, 11, False)]  # the set of document 11
    alone = docs.select(F.lit(None).cast("long").alias("doc_id"), "text")
    assert all(r.component_id is None for r in minhash.minhash_components(alone).collect())
    assert minhash.minhash_components(empty).count() == 0


def test_cells_find_what_stars_do_not(lspark):
    """Pairs that no star compares: members of different components of one bucket."""
    rng = np.random.default_rng(6)
    sets = [np.sort(rng.integers(0, 1 << 64, 400, np.uint64)) for _ in range(3)]
    sets += [np.sort(np.concatenate([s[:n], rng.integers(0, 1 << 64, 400 - n, np.uint64)])) for s, n in zip(sets, (380, 375, 355), strict=True)]
    sig = minhash.signatures(sets)
    rows = [(i, i, len(s), bytes(x), s.tobytes()) for i, (s, x) in enumerate(zip(sets, sig, strict=True))]
    schema = "cell long, band int, one boolean, side int, fp long, root long, size long, sig binary, tokens binary"
    cells = lspark.createDataFrame([(b, b, True, 0, *r) for b in range(minhash.BANDS) for r in rows], schema)
    asked = {(r.cell, r.fp) for r in minhash.near_members(cells.drop("tokens")).collect()}
    first = {p: next(b for b in range(minhash.BANDS) if (sig[p[0]].reshape(-1, 6)[b] == sig[p[1]].reshape(-1, 6)[b]).all()) for p in ((0, 3), (1, 4), (2, 5))}
    assert asked == {(b, k) for p, b in first.items() for k in p}  # a pair counts in its first band only
    links = {(r.a, r.b) for r in minhash.cell_links(cells).collect()}
    assert links == {(3, 0), (4, 1)}  # similarities 0.905, 0.882 and 0.798
    assert minhash.near_members(cells.withColumn("root", F.lit(1).cast("long"))).count() == 0  # one component: nothing to find
    two = lspark.createDataFrame([(1, first[0, 3], False, int(r[0] > 2), *r) for r in rows], schema)
    assert (3, 0) in {(r.a, r.b) for r in minhash.cell_links(two).collect()}


def test_signatures(monkeypatch):
    rng = np.random.default_rng(7)
    sets = [np.sort(mix(rng.integers(0, 1 << 64, n, np.uint64))) for n in (1, 5, 2000, 3, 700, 1)]
    want = [[int(min((x * a + b) >> np.uint64(32) for x in s)) & 255 for a, b in zip(minhash._A[:20], minhash._B[:20], strict=True)] for s in sets]
    for part in (1 << 16, 64, 7):
        monkeypatch.setattr(minhash, "PART", part)
        assert minhash.signatures(sets)[:, :20].tolist() == want
    x, y = rng.integers(0, 1 << 64, (2, 3000), np.uint64)
    pair = minhash.signatures([np.concatenate([x, y[:500]]), np.concatenate([x, y[500:1000]])])  # similarity 0.75
    assert abs((pair[0] == pair[1]).mean() - 0.75) < 0.1
