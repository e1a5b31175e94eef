"""The corpus pipeline, and the queries that SQL can express, over the smallest driver tables."""
import pytest
from llm_fixtures import SF001, docs, lspark  # noqa: F401

import corpus_pipeline
from hostelry.llm import queries
from hostelry.llm.common import documents, materialize
from sqloracle.compare import compare, duck


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(lspark, name):  # noqa: F811
    res = compare(queries.QUERIES[name](lspark, SF001), duck(SF001), queries.SQL[name])
    assert res["ok"], res


def test_stages(lspark):  # noqa: F811
    docs = documents(lspark, SF001)
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(lspark, docs, SF001), name)
        assert docs.columns == columns
        seen.append(docs.count())
    assert seen[0] > seen[1] > seen[2] >= seen[3] > 0
    assert docs.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 2
    out = corpus_pipeline.STAGES[-1][1](lspark, docs, SF001)
    assert out.count() == seen[-1] and out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]


def test_odd_rows(lspark, docs):  # noqa: F811
    odd = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(lspark, odd, SF001)
        ids = {r.doc_id for r in out.collect()}
        assert ids <= {r.doc_id for r in odd.collect()} and (name != "bpe_encode" or out.count() == odd.count())
        assert name != "jaccard_join" or {4, 6, 9, 10, 11}.issubset(ids) and not {5, 7} & ids
