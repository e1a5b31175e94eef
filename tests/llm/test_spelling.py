"""Spelling variants against a plain version."""
# ruff: noqa: F811
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import docs, empty, lspark  # noqa: F401

from hostelry.llm import spelling


def plain(data):
    counts = Counter()
    for key, text in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}

    def less(w):
        return {w[:i] + w[i + 1:] for i in range(len(w))}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return a in less(b) or b in less(a)
    out = {}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    for w in n:
        close = [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if v != w and near(w, v)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = (n[w], len(close), form, n[form] if form else None)
    rows = set()
    for w, (c, k, form, form_n) in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        rows.add((w, form, root, c, k, form_n))
    return rows


def found(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("alphabet", ["ab", "abcÉé", "abcdefghijk"])
def test_random_words(lspark, alphabet):
    rng = random.Random(alphabet)
    stems = ["".join(rng.choices(alphabet, k=rng.randint(6, 11))) for _ in range(40)]
    words = []
    for s in stems:
        words += [s] * rng.choice([5, 40, 300])
        for _ in range(6):
            i, c = rng.randrange(len(s)), rng.choice(alphabet)
            words += [rng.choice([s[:i] + s[i + 1:], s[:i] + c + s[i:], s[:i] + c + s[i + 1:], s.upper()])] * rng.randint(4, 9)
    rng.shuffle(words)
    data = [(i, " ".join(words[i::9]) + rng.choice(["", " 日本", "\n×÷"])) for i in range(9)]
    got = found(spelling.spelling_variants(lspark.createDataFrame(data, "doc_id long, text string")))
    assert got == plain(data) and any(r[1] for r in got)


def test_odd_rows(lspark, docs, empty):
    data = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(spelling.spelling_variants(docs)) == plain(data)
    assert spelling.spelling_variants(empty).count() == 0
    again = docs.unionAll(docs).unionAll(docs).unionAll(docs).unionAll(docs)
    assert found(spelling.spelling_variants(again)) == plain(data * 5)


def test_long_runs(lspark):
    """Runs about the length from which on they meet by all variants, one letter over and over, and a huge run."""
    base = "".join(random.Random(1).choices("abcdefg", k=66))
    runs = [base[:k] for k in (62, 63, 64, 65, 66)] + ["x" * k for k in (6, 7, 40, 63, 64, 65)] + ["y" * 30000, "y" * 29999]
    data = [(i, " ".join(runs)) for i in range(7)] + [(9, "x" * 64 + " ") ] * 30
    assert found(spelling.spelling_variants(lspark.createDataFrame(data, "doc_id long, text string"))) == plain(data)


def test_texts_beyond_a_slice():
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcé", k=rng.randint(1, 30))) for _ in range(3000)).encode()
    parts = list(spelling.slices(text, 500))
    assert b"".join(parts) == text and len(parts) > 50
    assert [w for p in parts for w in p.split()] == text.split()
    assert list(spelling.slices(b"a" * 5000 + b" b", 500)) == [b"a" * 5000, b" b"]


def test_crc_and_variants():
    rng = random.Random(3)
    runs = ["".join(rng.choices("abé", k=rng.randint(6, 20))).encode() for _ in range(500)] + [b"q" * 3000]
    ends = np.cumsum([len(r) for r in runs])
    starts = ends - [len(r) for r in runs]
    got = spelling.crc_of_runs(np.frombuffer(b"".join(runs), np.uint8), starts, ends - starts, np.full(len(runs), zlib.crc32(b"7:"), np.uint32))
    assert got.tolist() == [zlib.crc32(b"7:" + r) for r in runs]

    def code(w):
        return np.frombuffer(w.encode("utf-32-le"), np.uint32)[None, :].astype(np.uint64)
    whole, without = spelling.variants(code("abécab"))
    assert without[0].tolist() == [spelling.variants(code("abécab"[:i] + "abécab"[i + 1:]))[0][0] for i in range(6)]


def test_pivots_are_the_rarest_disjoint_bigrams():
    rng = np.random.default_rng(4)
    weights = rng.integers(1, 20, (300, 9))
    inside = rng.random((300, 9)) < 0.6
    left, right = spelling.pivots(weights, inside)
    for w, ok, a, b in zip(weights, inside, left, right, strict=True):
        best = min((w[i] + w[j] for i in range(9) for j in range(i + 2, 9) if ok[i] and ok[j]), default=None)
        if best is not None:
            assert b - a >= 2 and ok[a] and ok[b] and w[a] + w[b] == best
