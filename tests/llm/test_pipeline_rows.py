"""Rows of every stage and of run(), against plain Python versions."""
import hashlib
import math
from collections import Counter, defaultdict

import pandas as pd
import pytest
from llm_fixtures import SF001, docs, lspark  # noqa: F401
from test_operators import PATH, brute_components, ids_of, tokenizer  # noqa: F401

import corpus_pipeline
from hostelry.llm import mixing, quality
from hostelry.llm.common import documents, materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def listed(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def split(text):
    return (text or "").encode().split()


def plain_quality(lspark, data):  # noqa: F811
    """Verdicts by naive rules and every threshold tried; the fitted trees are the operator's."""
    labels = defaultdict(list)
    for r in lspark.read.parquet(f"{SF001}/labels.parquet").collect():
        if r.doc_id is not None and r.quality is not None:
            labels[r.doc_id].append(r.quality)

    def base_fails(words):
        seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        hit = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
        return len(words) < 50 or 2 * len(hit) > len(words)
    fails = [base_fails(split(r[1])) for r in data]
    stats = pd.DataFrame([quality.measure((r[1] or "").encode()) for r in data], columns=list(quality.STATS))
    known = [(i, min(labels[r[0]])) for i, r in enumerate(data) if not fails[i] and r[0] in labels]
    rows = [(data[i][0], *map(int, stats.iloc[i]), q) for i, q in known]
    frame = lspark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{s} long" for s in quality.STATS) + ", quality int")
    forest = quality.fit_forest(frame)
    threshold = None
    if forest:
        step = [math.floor(s * quality.SCORE_STEPS) for s in forest.scores(stats)]
        good, bad = ([step[i] for i, q in known if q == k] for k in (1, 0))
        fits = [t for t in set(bad) if sum(s >= t for s in good) <= quality.MAX_GOOD_LOSS * len(good)] if good else []
        threshold = min(fits) if fits else None
    return Counter(r for i, r in enumerate(data) if not fails[i] and (threshold is None or step[i] < threshold))


def plain_jaccard(data):
    component = {i: c for i, _, c in brute_components([(r[0], r[1] or "") for r in data])}
    return Counter({r for r in data if r[0] is not None and component[r[0]] == r[0]} | {r for r in data if r[0] is None})


def plain_substring(data):
    first, out = {}, Counter()
    for r in data:
        w = split(r[1])
        for k in range(len(w) - 49 if r[0] is not None else 0):
            at = tuple(w[k:k + 50])
            first[at] = min(first.get(at, r[0]), r[0])
    for i, text, lang, source, _ in data:
        w = split(text)
        gone = {j for k in range(len(w) - 49 if i is not None else 0) if first[tuple(w[k:k + 50])] < i for j in range(k, k + 50)}
        if not w or len(gone) < len(w):
            left = b" ".join(x for k, x in enumerate(w) if k not in gone).decode() if gone else text
            out[i, left, lang, source, None if left is None else len(left)] += 1
    return out


def check_mix(data, got):
    """Copies of every group of equal source and size, and their even spread over its rows."""
    groups, sources = defaultdict(list), sorted({r[3] for r in data}, key=lambda s: (s is None, (s or "").encode()))
    for r in data:
        groups[r[3], len(split(r[1]))].append(r)
    totals = [sum(len(split(r[1])) for r in data if r[3] == s) for s in sources]
    assert set(got) <= set(data)
    for s, total, target in zip(sources, totals, mixing.target_words(totals), strict=True):
        sizes = sorted((n for t, n in groups if t == s), reverse=True)
        mean = max(total / sum(len(groups[s, n]) for n in sizes), 1e-9)

        def rate(n, tilt, mean=mean):
            return 2 / (1 + math.exp(-max(-700, min(700, tilt * n / mean))))
        low, high = -1e6, 1e6
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(n * len(groups[s, n]) * rate(n, mid) for n in sizes) < target else (low, mid)
        owed = 0.0
        for n in sizes:
            rows = groups[s, n]
            want = owed + n * len(rows) * (2.0 if target >= 2 * total else rate(n, low))
            copies = min(2 * len(rows), max(0, round(want / n))) if n else 0
            owed = want - copies * n
            taken = Counter(rows)
            assert sum(got[r] for r in taken) == copies, (s, n)
            assert all(got[r] in range(copies // len(rows) * m, -(-copies // len(rows)) * m + 1) for r, m in taken.items()), (s, n)


def plain_ids(tokenizer, rows):  # noqa: F811
    out = Counter()
    for r, m in rows.items():
        ids = ids_of(tokenizer, r[1] or "")
        out[r[0], len(ids), tuple(ids), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += m
    return out


def encoded(df):
    return Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded_sha256) for r in df.collect())


def check_stage(lspark, tokenizer, name, data, out):  # noqa: F811
    if name == "bpe_encode":
        assert encoded(out) == plain_ids(tokenizer, Counter(data))
        return
    got = Counter(listed(out))
    if name == "quality_rules":
        assert got == plain_quality(lspark, data)
    elif name == "jaccard_join":
        assert got == plain_jaccard(data)
    elif name == "substring_dedup":
        assert got == plain_substring(data)
    else:
        check_mix(data, got)


def test_run_is_its_stages(lspark, tokenizer):  # noqa: F811
    now = documents(lspark, SF001)
    for name, stage in corpus_pipeline.STAGES:
        data = listed(now)
        now = materialize(stage(lspark, now, SF001), f"rows-{name}")
        check_stage(lspark, tokenizer, name, data, now)
    assert encoded(corpus_pipeline.run(lspark, SF001)) == plain_ids(tokenizer, Counter(data))


@pytest.mark.parametrize("at", range(5))
def test_odd_rows_of_a_stage(lspark, tokenizer, docs, at):  # noqa: F811
    name, stage = corpus_pipeline.STAGES[at]
    odd = docs.select(*COLUMNS)
    check_stage(lspark, tokenizer, name, listed(odd), stage(lspark, odd, SF001))


def test_odd_ids(lspark, docs):  # noqa: F811
    odd, stages = docs.select(*COLUMNS), dict(corpus_pipeline.STAGES)

    def ids(name):
        return sorted((r.doc_id for r in stages[name](lspark, odd, SF001).collect()), key=lambda i: (i is None, i or 0))
    assert ids("jaccard_join") == [1, 2, 3, 4, 6, 9, 10, 11, 13, 14, 15, 16, None]
    assert ids("substring_dedup") == [1, 2, 3, 4, 5, 6, 8, 8, 9, 10, 11, 12, 13, 14, 15, 16, None]
    assert ids("bpe_encode") == [1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 10, 11, 12, 13, 14, 15, 16, None]
