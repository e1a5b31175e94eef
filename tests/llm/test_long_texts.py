"""Every operator on a text of many words, its near copy, one huge word and a long run of blanks."""
# ruff: noqa: F811
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import SF001, lspark  # noqa: F401
from test_minhash import plain as plain_minhash
from test_operators import brute_components
from tokenizers import Tokenizer

import corpus_pipeline
from hostelry.llm import bpe, jaccard, language, minhash, mixing, quality, search, spelling, substrings, token_counts, token_files, warc

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def data():
    rng = random.Random(21)
    words = [f"word{rng.randrange(50_000)}" for _ in range(300_000)]
    near = list(words)
    near[::1000] = ["other"] * 300
    tail = [f"tail{i}" for i in range(60)] + words[1000:1100]
    return [(1, " ".join(words), "en", "a"), (2, " ".join(near), "en", "a"), (3, "x" * 2_000_000, "en", "b"), (4, "a" + " " * 1_500_000 + "b", None, "b"),
            (5, " ".join(tail), "en", "c")]


@pytest.fixture(scope="module")
def long_docs(lspark, data):
    return lspark.createDataFrame([(*r, len(r[1])) for r in data], "doc_id long, text string, lang string, source string, n_chars long").repartition(2)


def test_tokens(long_docs, data):
    tokenizer = Tokenizer.from_file(PATH)
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t, *_ in data}
    digest = {i: hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for i, x in ids.items()}
    assert {r.doc_id: r.ids_sha256 for r in bpe.bpe_encoded(long_docs, PATH, with_ids=False).collect()} == digest
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(long_docs, PATH).collect()} == {i: len(x) for i, x in ids.items()}
    assert {r.doc_id: r.n_tokens for r in token_files.token_files(long_docs, PATH).collect()} == {i: len(x) + 1 for i, x in ids.items()}


def test_near_duplicates(long_docs, data):
    pairs = [(i, t) for i, t, *_ in data]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(long_docs).collect())
    assert got == brute_components(pairs)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.minhash_components(long_docs).collect()) == plain_minhash(pairs)


def test_repeated_passages(long_docs, data):
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.substring_dedup(long_docs).collect()}
    # between two changed words lie 999 others, all in windows
    assert got[1] == (300_000, 0) and got[2] == (300_000, 299_700) and got[3] == (1, 0) and got[4] == (2, 0) and got[5] == (160, 100)


def test_rules_language_mix_and_search(lspark, long_docs, data):
    rules = {r.doc_id: r for r in quality.quality_rules(long_docs, lspark.read.parquet(f"{SF001}/labels.parquet")).collect()}
    assert rules[1].n_words == 300_000 and rules[1].word_chars == sum(map(len, data[0][1].split())) and not rules[1].base_failed
    assert rules[3].base_failed and rules[3].word_chars == 2_000_000
    assert {r.doc_id: r.lang_pred for r in language.identify(long_docs).collect()}.keys() == {1, 2, 3, 4, 5}
    assert {r.doc_id: r.size for r in mixing.mix(long_docs).collect()} == {1: 300_000, 2: 300_000, 3: 1, 4: 2, 5: 160}
    hits = {(r.query_id, r["rank"]): r.doc_id for r in search.search(long_docs, long_docs).collect()}
    assert hits[3, 1] == 3 and hits[4, 1] == 4 and hits[5, 1] == 5
    assert spelling.spelling_variants(long_docs).count() == 0  # all runs of letters are short, or stand there once


def test_payloads_and_stages(lspark, long_docs, data):
    pages = lspark.createDataFrame([(i, f"http://h/{i}", t) for i, t, *_ in data] + [(9, "http://h/9", data[2][1])], "page_id long, url string, html string")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.warc_round_trip(pages).collect()}
    for i, t, *_ in data:
        assert got[i] == (len(t.encode()), hashlib.sha256(t.encode()).hexdigest(), "response", None)
    assert got[9][2:] == ("revisit", 3)
    kept = {name: sorted(r.doc_id for r in stage(lspark, long_docs, SF001).select("doc_id").collect()) for name, stage in corpus_pipeline.STAGES}
    assert 3 not in kept["quality_rules"] and kept["jaccard_join"] == [1, 3, 4, 5]
    assert kept["substring_dedup"] == [1, 2, 3, 4, 5] and kept["bpe_encode"] == [1, 2, 3, 4, 5] and set(kept["mix_sources"]) <= {1, 2, 3, 4, 5}
