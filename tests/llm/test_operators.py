"""Operators on small tables against plain brute-force versions."""
# ruff: noqa: F811
import hashlib
import json
import math
import random
import re
import time
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import docs, empty, lspark  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hostelry.llm import bpe, files, jaccard, language, mixing, quality, search, substrings, token_counts, token_files, warc
from hostelry.llm.common import materialize, scratch
from hostelry.llm.components import connected_components

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def rows(df):
    return df.collect()


def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def ids_of(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


# --- 3, 7, 10: tokens

def test_fragments_encode_like_the_library(tokenizer):
    import pyarrow as pa
    rng = random.Random(3)
    alphabet = ["a", "Bc", "à", "\n", " ", "  ", "\t", "'s", "1", "!", "日", "<|endoftext|>", "\x1c", "\r", "　"]
    cases = ["", " ", "\n"] + ["".join(rng.choices(alphabet, k=rng.randint(1, 14))) for _ in range(1500)]
    enc = bpe.FragmentEncoder(PATH)
    ids, counts = enc.encode(pa.array(cases, pa.large_string()))
    ends = np.cumsum(counts)
    for t, a, b in zip(cases, ends - counts, ends, strict=True):
        assert ids[a:b].tolist() == ids_of(tokenizer, t), t
        assert "".join(enc.pieces(t)) == t
        assert enc.decode(ids[a:b]).decode() == tokenizer.decode(ids[a:b].tolist(), skip_special_tokens=False)


def test_every_token_is_made_by_its_merges():
    assert bpe.FragmentEncoder(PATH).unreachable() == []


def test_bpe_rows(docs, empty, tokenizer):
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows(bpe.bpe_encoded(docs, PATH, with_ids=False)))
    want = Counter()
    for i, t in texts(docs):
        ids = ids_of(tokenizer, t)
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert got == want
    assert bpe.bpe_encoded(empty, PATH).count() == 0
    back = bpe.bpe_decode(bpe.bpe_encoded(docs, PATH), PATH)
    assert Counter((r.doc_id, r.text) for r in rows(back)) == Counter(texts(docs))


def test_long_texts_resynchronise(tokenizer):
    rng = random.Random(5)
    for _ in range(30):
        t = "".join(rng.choices(["word", " ", "\n", "  ", "'s ", "é", "日本", "<|endoftext|>", "longerword "], k=400))
        assert token_counts.count_tokens(t, tokenizer, chunk=90, overlap=8) == len(ids_of(tokenizer, t))
    for kind in ["x", "日本", " ", "\n", "a1", "!'s", "é\u00b2"]:
        assert token_counts.count_tokens(kind * 2500, tokenizer, chunk=90, overlap=8) == len(ids_of(tokenizer, kind * 2500))


def test_stable_places_are_cuts_in_any_context(tokenizer):
    """Wherever a text is cut at a stable place, both sides encode as they do together."""
    rng = random.Random(8)
    alphabet = ["a", "Zé", "я", "日本語", "、", "。", "7", "42", "!", "'", "'s", "'ll", "#", "[x]", " ", "\n", "\t", "한", "½", "_", "\\", "<|endoftext|"]
    for _ in range(400):
        t = "".join(rng.choices(alphabet, k=12))
        whole = ids_of(tokenizer, t)
        for m in token_counts._STABLE.finditer(t, 1):
            assert ids_of(tokenizer, t[:m.start()]) + ids_of(tokenizer, t[m.start():]) == whole, (t, m.start())


def test_long_texts_take_linear_time(tokenizer):
    rng = random.Random(9)
    for alphabet in ("abcdefgh", "日本語中国人民共和"):
        took = []
        for n in (400_000, 800_000):
            text = "".join(rng.choices(alphabet, k=n))
            start = time.process_time()
            assert token_counts.count_tokens(text, tokenizer) == len(ids_of(tokenizer, text))
            took.append(time.process_time() - start)
        assert took[1] <= 2.9 * took[0] + 1


def test_token_counts(docs, empty, tokenizer):
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows(token_counts.token_counts(docs, PATH)))
    want = Counter((i, len(t.encode()), n := len(ids_of(tokenizer, t)), n > 1024) for i, t in texts(docs))
    assert got == want and token_counts.token_counts(empty, PATH).count() == 0


LONG = {"blanks": " " * 2_000_000, "tabs": "\t" * 2_000_000, "lines": "\n" * 2_000_000, "letters": "x" * 2_000_000, "mixed": "a " + " " * 1_200_000 + "b"}


@pytest.mark.parametrize("kind", LONG)
def test_long_runs_encode_like_the_library(tokenizer, kind):
    import pyarrow as pa
    ids, counts = bpe.FragmentEncoder(PATH).encode(pa.array(["a b", LONG[kind], "c"], pa.large_string()))
    want = [ids_of(tokenizer, t) for t in ("a b", LONG[kind], "c")]
    assert counts.tolist() == [len(w) for w in want]
    assert np.array_equal(ids, np.concatenate([np.array(w, np.uint32) for w in want]))


def test_svb_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 1001):
        v = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        assert token_files.svb_decode(*token_files.svb_encode(v), n).tolist() == v.tolist()


def test_token_files(docs, empty, tokenizer):
    got = rows(token_files.token_files(docs, PATH))
    start, seen = 0, Counter((i, t) for i, t in texts(docs))
    by_id = {i: t for i, t in seen}
    for r in sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.start)):
        ids = ids_of(tokenizer, by_id[r.doc_id]) + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == docs.count() and token_files.token_files(empty, PATH).count() == 0


# --- 1: repeated passages

def brute_removed(docs, window):
    split = [(i, t.split()) for i, t in ((i, t.encode()) for i, t in docs)]
    first = {}
    for i, w in split:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        out[i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()] += 1
    return out


def test_substring_dedup(docs, empty):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows(substrings.substring_dedup(docs)))
    assert got == brute_removed(texts(docs), 50)
    assert substrings.substring_dedup(empty).count() == 0 and substrings.without_repeats(empty).count() == 0
    left = {r.doc_id: r for r in rows(substrings.without_repeats(docs))}
    assert 7 not in left and left[8].text == "tail" and left[6].key == "k" and left[2].text == "" and left[1].text is None


def test_substring_dedup_of_random_passages(lspark):
    rng = random.Random(8)
    passages = [" ".join(rng.choices("abcdefgh", k=70)) for _ in range(6)]
    data = [(i // 2 if i > 55 else i, " ".join(rng.choices(passages + ["x", "y z", "q " * 30], k=rng.randint(1, 6)))) for i in range(60)]
    df = lspark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows(substrings.substring_dedup(df)))
    assert got == brute_removed(data, 50)


def test_full_groups_take_longer_prefixes(lspark):
    words = np.random.default_rng(0).integers(0, 1 << 62, 400).astype(np.uint64)
    runs = lspark.createDataFrame([(i, 0, 0, words.tobytes(), 351) for i in range(20)], "key long, class long, start long, words binary, n long")
    plan = substrings.plan_groups(runs, 3, 50, limit=500)
    assert (plan[:, 0] > 8).all() and (plan[:, 1] > 1).all()


# --- 5: near duplicates

def brute_components(data):
    sets = []
    for i, t in data:
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
        sets.append((i, frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    named = [(i, s) for i, s in sets if i is not None and s]
    parent = {s: s for _, s in sets}

    def find(s):
        while parent[s] != s:
            s = parent[s]
        return s
    distinct = list({s for _, s in named})
    for x, a in enumerate(distinct):
        for b in distinct[x + 1:]:
            both = len(a & b)
            if 100 * both >= 80 * (len(a) + len(b) - both):
                parent[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for i, s in named:
        r = find(s)
        least[r] = i if least[r] is None else min(least[r], i)
    return Counter((i, len(s), least[find(s)] if s else i) for i, s in sets)


def test_jaccard_components(docs, empty):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows(jaccard.jaccard_components(docs)))
    assert got == brute_components(texts(docs))
    assert jaccard.jaccard_components(empty).count() == 0


def test_jaccard_of_many_edited_copies(lspark):
    rng = random.Random(4)
    bases = [[f"b{b}_{i}" for i in range(n)] for b, n in enumerate((60, 60, 90, 12, 4))]
    data = []
    for i in range(220):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
        data.append((i, " ".join(w[:rng.choice([len(w), len(w), len(w) - 2])])))
    df = lspark.createDataFrame(data, "doc_id long, text string").repartition(6)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows(jaccard.jaccard_components(df)))
    assert got == brute_components(data)


@pytest.mark.parametrize("block", [5, 20, 2048])
def test_jaccard_matrix(lspark, monkeypatch, block):
    """The cells and their matrix find links that no star compares, also across blocks, and open few groups."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = np.random.default_rng(10)
    sets, pairs = [], []
    for _ in range(20):
        base = rng.integers(0, 1 << 64, 300, np.uint64)
        for keep in (300, 285, 262):  # similarities to the first: 0.905 and 0.776
            sets.append(np.unique(np.concatenate([base[:keep], rng.integers(0, 1 << 64, 300 - keep, np.uint64)])))
        pairs.append((len(sets) - 2, len(sets) - 3))
    common = rng.integers(0, 1 << 63, 1, np.uint64)  # one token that all have
    sets = [np.unique(np.append(s, common)) for s in sets]
    token = int(common.astype(np.int64)[0])
    rows = [(i, i, len(s), jaccard.bitmaps(s), [token], s.tobytes()) for i, s in enumerate(sets)]
    blocks = -(-len(sets) // block)
    cells = [(min(a, b) * 1000 + max(a, b), token, a == b, int(a > b), *r) for r in rows for a in [r[0] % blocks] for b in range(blocks)]
    df = lspark.createDataFrame(cells, "cell long, token long, one boolean, side int, fp long, root long, size long, bits binary, first array<long>, tokens binary")
    near = {r.fp for r in jaccard.asked(df.drop("tokens")).collect()}
    assert {x for p in pairs for x in p} <= near
    assert {(r.a, r.b) for r in jaccard.cell_links(df).collect()} == set(pairs)
    met = df.withColumn("first", F.array(F.lit(token - 1), F.lit(token)))  # they met in an earlier token
    assert jaccard.asked(met.drop("tokens")).count() == 0
    bits = np.frombuffer(b"".join(jaccard.bitmaps(s) for s in sets), np.uint64).reshape(len(sets), 2, -1)[:, 0]
    whole = (np.arange(len(sets)), np.array([len(s) for s in sets]), bits)
    groups, opened = jaccard.open_groups(whole, whole, group=3)
    assert len(groups) == 20 and opened.sum() <= 0.2 * opened.size
    assert all(opened[i, i // 3] for i in range(len(sets)))


def test_bitmap_bounds(lspark):
    rng = np.random.default_rng(11)
    for _ in range(200):
        both = rng.integers(0, 1 << 64, rng.integers(1, 300), np.uint64)
        x, y = (np.unique(np.concatenate([both, rng.integers(0, 1 << 64, rng.integers(0, 300), np.uint64)])) for _ in range(2))
        (h, p), (g, q) = (np.frombuffer(jaccard.bitmaps(s), np.uint64).reshape(2, -1) for s in (x, y))
        n = len(np.intersect1d(x, y))
        assert n <= len(x) - np.bitwise_count(h & ~g).sum() and 2 * n <= len(x) + len(y) - int(np.bitwise_count(p ^ q).sum())


def test_components_of_a_path(lspark):
    edges = lspark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in rows(connected_components(edges))}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


# --- 2: search

def test_search(docs, empty):
    data = [(i, re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())) for i, t in texts(docs)]
    n, mean = len(data), sum(len(w) for _, w in data) / len(data)
    df = Counter(x for _, w in data for x in set(w))
    for top in (2, 10):
        want = []
        for q in {i for i, _ in data if i is not None}:
            terms = {x for i, w in data if i == q for x in w}
            scored = []
            for i, w in data:
                tf = Counter(w)
                s = sum(math.log1p((n - df[x] + 0.5) / (df[x] + 0.5)) * tf[x] * 2.2 / (tf[x] + 1.2 * (0.25 + 0.75 * len(w) / mean)) for x in terms if tf[x])
                if s > 0 and i is not None:
                    scored.append((-round(s, 6), i))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:top])]
        got = [(r.query_id, r["rank"], r.doc_id, r.score) for r in rows(search.search(docs, docs, top=top))]
        assert Counter(got) == Counter(want)
    assert search.search(docs, empty).count() == 0 and search.search(empty, docs).count() == 0


def test_search_in_shards_without_long_terms(lspark):
    """One partition of texts without words, one of 30 documents that share no term."""
    def part(data):
        return lspark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    blank = part([(101, None), (102, ""), (103, " \n\t "), (None, "")])
    alone = part([(i, f"only{i} only{i}") for i in range(30)])
    n, mean = 34, 60 / 34
    score = round(math.log1p((n - 0.5) / 1.5) * 2 * 2.2 / (2 + 1.2 * (0.25 + 0.75 * 2 / mean)), 6)
    docs = blank.union(alone)
    assert Counter(map(tuple, rows(search.search(docs, docs)))) == Counter((i, 1, i, score) for i in range(30))
    assert search.search(blank, alone).count() == 0 and search.search(blank, blank).count() == 0


def test_search_queries_go_through_files(lspark, docs, monkeypatch):
    """Every query is in one file with all its terms, no row carries a block of queries, and the number of blocks shows nowhere."""
    want = Counter(map(tuple, rows(search.search(docs, docs))))
    terms = lspark.createDataFrame([(q, 10 * q + i, q + i) for q in range(40) for i in range(1 + q % 3)], "query long, term long, df long")
    written = search.write_queries(terms, search.scratch(lspark, "test-queries"), 7)
    uris = [r.queries for r in written.collect()]
    assert written.columns == ["queries"] and 1 < len(uris) <= 7
    got = {}
    for uri in uris:
        ids, own = search.load_queries(uri, 100)
        got.update((q, dict(zip(t.tolist(), w.tolist(), strict=True))) for q, (t, w) in zip(ids.tolist(), own, strict=True))
    assert got == {q: {10 * q + i: search.weight(100, float(q + i)) for i in range(1 + q % 3)} for q in range(40)}
    monkeypatch.setattr(search, "QUERY_BLOCK", 3)
    assert Counter(map(tuple, rows(search.search(docs, docs)))) == want


def test_search_sends_no_terms_through_the_driver(lspark, docs, monkeypatch):
    """Terms and their frequencies are shuffled, never broadcast: the driver would hold all terms of the corpus."""
    want, plans = Counter(map(tuple, rows(search.search(docs, docs)))), {}

    def planned(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, name)
    monkeypatch.setattr(search, "materialize", planned)
    before = lspark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    lspark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")
    try:
        assert Counter(map(tuple, rows(search.search(docs, docs)))) == want
    finally:
        lspark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {"query-terms", "query-blocks"} <= set(plans) and "Join" in plans["query-blocks"]
    assert [name for name, plan in plans.items() if "Broadcast" in plan] == []


def test_search_carries_the_score_to_beat_over_shards(lspark):
    """What one shard has found is kept for the next: no more than ``top`` rows a query leave a group
    of shards, they are the best of all, with ties to smaller keys, and blocks that cannot beat them stay closed."""
    def shard(keys, times):
        found = [search.terms_of(b" ".join([b"every"] * times + [b"own%d" % k])) for k in keys]
        return search.Shard(search.Shard.build(list(keys), found), 4.0)
    asked = (np.unique(search.hash_words([b"every"])), np.array([2.0]))
    best = search.Best(np.array([7]), [asked], 3)
    best.look_in(shard(range(100, 200), 3))
    best.look_in(shard(range(300, 400), 1))
    best.look_in(shard(range(2, 50, 2), 3))
    got = best.rows().to_pydict()
    score = float(np.round(2.0 * search.factors(np.array(3.0), np.array(4.0), 4.0), search.DIGITS))
    assert got == {"query": [7] * 3, "key": [2, 4, 6], "score": [score] * 3}
    assert [len(d) for d, _ in shard(range(300, 400), 1).search([asked], 3, np.array([score]))] == [0]


# --- 4: archives

def test_warc(lspark):
    page = "<p>" + "x" * 200
    data = [(5, "u", page), (3, None, page), (3, "dup", page), (None, "n", page), (7, "é ü", "short"), (8, "s", "short"), (9, "z", None), (10, "z", "")]
    pages = lspark.createDataFrame([(*d, "x", "y") for d in data], "page_id long, url string, html string, digest string, first string")
    got = Counter(tuple(r) for r in rows(warc.warc_round_trip(pages).drop("url")))
    want = Counter()
    for i, _, t in data:
        raw = (t or "").encode()
        back = len(raw) >= 100 and i != 3
        want[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if back else "response", 3 if back else None] += 1
    assert got == want and warc.warc_round_trip(pages.limit(0)).count() == 0


def test_packages_are_zip_files(lspark, tmp_path):
    writer = warc.ArchiveWriter(f"file://{tmp_path}/a.wacz")
    for i in range(3):
        writer.add(warc.warc_record(i, f"http://h/{i}", b"payload %d" % i, "0", None), {"n": i})
    writer.close()
    with zipfile.ZipFile(tmp_path / "a.wacz") as z:
        assert z.testzip() is None and z.namelist() == ["archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"]
        assert [json.loads(x)["n"] for x in z.read("indexes/index.cdxj").splitlines()] == [0, 1, 2]
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:  # without ZIP64 fields, and with a comment
        z.writestr("one.txt", "first")
        z.writestr("two.txt", "second")
        z.comment = b"c" * 300
    with files.open_ranged(str(tmp_path / "b.zip")) as f:
        members = warc.zip_members(f, files.size(str(tmp_path / "b.zip")))
        assert {k: files.read_range(f, *v) for k, v in members.items()} == {"one.txt": b"first", "two.txt": b"second"}


# --- 6: quality

def test_rule_statistics():
    line = "a b c d"
    text = f"{line}\n{line}\n \nx #$ Y!"
    words = text.split()
    assert quality.measure(text.encode()) == (len(words), sum(map(len, words)), 2, 1, 8, 1, 1)
    for seed in range(30):
        rng = random.Random(seed)
        w = [rng.choice("abc").encode() for _ in range(rng.randint(0, 30))]
        windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        hit = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
        assert quality.repeat_words(w) == len(hit)


def test_quality_rules(lspark, docs, empty):
    rng = random.Random(2)
    data, labels = [], []
    for i in range(300):
        w = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(120)]
        bad = i % 10 == 0
        data.append((i, " ".join(x + "###" if bad else x for x in w)))
        labels.append((i, 0 if bad else 1, 0))
    df = lspark.createDataFrame(data, "doc_id long, text string")
    known = lspark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in rows(quality.quality_rules(df, known))}
    # every threshold tried: of those that lose few enough good rows, the lowest that a bad row reaches
    step = {i: math.floor(r.score * quality.SCORE_STEPS) for i, r in got.items()}
    bad = [i for i in got if i % 10 == 0]
    fits = [t for t in {step[i] for i in bad} if sum(step[i] >= t for i in got if i % 10) <= quality.MAX_GOOD_LOSS * (300 - len(bad))]
    threshold = min(fits) if fits else None
    assert {i for i in got if got[i].kept} == {i for i in got if threshold is None or step[i] < threshold}
    assert {r.doc_id for r in rows(quality.good_documents(df, known))} == {i for i in got if got[i].kept}


def test_forest_scores(lspark, docs, empty):
    rng = np.random.default_rng(3)
    sample = np.concatenate([rng.normal(0, 1, (500, 3)), rng.normal(9, 0.1, (5, 3))])
    forest = quality.IsolationForest(sample, trees=60)
    scores = forest.scores(sample)
    assert scores[500:].min() > np.quantile(scores[:500], 0.95)

    def path(row, node):
        while forest.feature[node] >= 0:
            node = int(forest.left[node] if row[forest.feature[node]] <= forest.split[node] else forest.path[node])
        return forest.path[node]
    for i in (0, 100, 502):
        assert forest.paths(sample[i:i + 1])[0] == pytest.approx(np.mean([path(sample[i], r) for r in forest.roots]))
    known = lspark.createDataFrame([(6, 1, 0)], "doc_id long, quality int, toxic int")
    odd = rows(quality.quality_rules(docs, known.limit(0)))
    assert len(odd) == docs.count() and all(r.kept != r.base_failed for r in odd)
    assert quality.quality_rules(empty, known).count() == 0


# --- 8: mixing

def test_targets():
    assert mixing.target_words([10, 10, 10]) == pytest.approx([20, 50 / 3, 25 / 3])
    assert mixing.target_words([0, 0]) == [0, 0] and mixing.target_words([]) == []


def test_mix(lspark, docs, empty):
    data = [(i, "w " * (i % 37), f"s{i % 5}" if i % 11 else None) for i in range(400)]
    df = lspark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)
    got = rows(mixing.mix(df))
    taken, target = defaultdict(int), {}
    for r in got:
        assert r.size == r.doc_id % 37 and 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 2 for s in target)
    assert sorted(map(str, got)) == sorted(map(str, rows(mixing.mix(df.repartition(7)))))
    odd = rows(mixing.mix(docs))
    assert len(odd) == docs.count() and all(r.taken <= 2 * r.size for r in odd) and mixing.mix(empty).count() == 0


# --- 9: language

def test_language(lspark, docs, empty):
    rng = random.Random(6)
    parts = {"en": ["the", "ing", "and", "wh"], "de": ["sch", "ung", "und", "ei"], "fr": ["eau", "ion", "les", "ou"], "es": ["ado", "que", "los", "ll"]}
    data = [(i, " ".join("".join(rng.choices(parts[v], k=2)) for _ in range(30)), v) for i in range(400) for v in [list(parts)[i % 4]]]
    df = lspark.createDataFrame(data, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in rows(language.identify(df))}
    held = [i for i, _, _ in data if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in got if got[i].held_out} == set(held)
    assert sum(got[i].lang_pred == data[i][2] for i in held) >= 0.95 * len(held)
    odd = {r.doc_id: r for r in rows(language.identify(docs))}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (1, 2, 3, 16)) and all(0 <= r.score <= 1 for r in odd.values())
    assert language.identify(empty).count() == 0
    assert all(language.describe(t) is None for t in ("½ ²", "① ②", "Ⅻ", "12_3 !", "")) and language.describe("½ é") is not None
    assert {r.lang_pred for r in rows(language.predict(docs, None))} == {"und"}


def naive_features(text):
    """Counts of the letters' 1- to 3-byte sequences, one by one."""
    letters = "".join(c if re.fullmatch(r"[^\W\d_]", c) else " " for c in text).split()
    data = f" {' '.join(letters).lower()} ".encode()
    tables = [[0] * n for n in language.BUCKETS]
    for i, a in enumerate(data):
        tables[0][a & 255] += 1
        if i + 1 < len(data):
            tables[1][(((a * 0x9E37 + data[i + 1] * 0x85EB) % (1 << 32)) >> 3) & (language.BUCKETS[1] - 1)] += 1
        if i + 2 < len(data):
            tables[2][(((a * 0x9E3779B1 + data[i + 1] * 0x85EBCA77 + data[i + 2] * 0xC2B2AE3D) % (1 << 32)) >> 15) & (language.BUCKETS[2] - 1)] += 1
    return [v / math.sqrt(sum(x * x for x in t)) for t in tables for v in t]


def test_language_decisions():
    """Features, margins, votes and ties against a naive version."""
    rng = np.random.default_rng(14)
    text = "Über 12 garçons, x_y ½ naïve! " * 3
    assert np.allclose(language.describe(text), naive_features(text), atol=1e-5)
    langs = ["de", "en", "nl", "es", "fr", "xx"]
    model = language.Hierarchy(rng.random((60, language.WIDTH)).astype(np.float32), langs * 10)
    families = {"germanic": ["de", "en", "nl"], "romance": ["es", "fr"], "xx": ["xx"]}
    for _ in range(300):
        margins = np.round(rng.normal(size=len(model.weights)) * 2) / 2  # with ties
        top = sorted(range(3), key=lambda k: (-margins[k], sorted(families)[k]))
        own = families[sorted(families)[top[0]]]
        rest = dict(zip([(a, b) for f in sorted(families) for i, a in enumerate(families[f]) for b in families[f][i + 1:]], margins[3:], strict=True))
        against = {v: [m if v == a else -m for (a, b), m in rest.items() if v in (a, b)] for v in own}
        won = {v: sum((m >= 0) if v == a else (m < 0) for (a, b), m in rest.items() if v in (a, b)) for v in own}
        best = sorted(own, key=lambda v: (-won[v], -sum(against[v]), v))[0]
        score = 1 / (1 + math.exp(-min([max(margins[top[0]] - margins[top[1]], 0.0), *against[best], 10.0])))
        got = model._decide(margins.tolist())
        assert got[0] == best and abs(got[1] - score) < 1e-9
    x = np.stack([language.describe(t) for t in ("the house", "das Haus")])
    naive = [[sum(float(a) * float(b) for a, b in zip(w[:-1], v, strict=True)) + float(w[-1]) for w in model.weights] for v in x]
    assert [m for m, _ in model.predict(x)] == [model._decide(m)[0] for m in naive]


def test_scratch_tables_survive(lspark):
    df = materialize(lspark.range(5).select(F.col("id")), "t")
    assert df.count() == 5 and "t-" in df.inputFiles()[0] and scratch(lspark, "a") != scratch(lspark, "a")
