import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pytest  # noqa: E402

from hostelry.llm.common import ship  # noqa: E402

SF001 = "/root/testdata/sf0.001"
BASE = "the quick brown fox jumps over a lazy dog while seven small birds sing in old trees near cold water"


def words(n, seed):
    return " ".join(f"w{seed}x{i * 7919 % 1009}" for i in range(n))


#: Null and empty texts, ties, repeated rows, near and exact copies, a long text, odd white space.
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "Hello", "en", "b"), (5, "hello", "de", "b"),
    (6, words(120, 1), "en", "a"), (7, words(120, 1), "en", "b"), (8, words(120, 1) + " tail", "en", None), (8, words(120, 1) + " tail", "en", None),
    (9, words(60, 2) + " " + words(55, 1), "fr", "c"), (10, words(6000, 3), "en", "a"), (11, BASE, "en", "a"), (12, BASE + " today", "en", "a"),
    (None, BASE, "en", "a"), (13, "à b à  c\n\n<|endoftext|> 日本語 　x", "de", None), (14, ("ab " * 200).strip(), "en", "c"),
    (15, "x" * 40000, "en", "c"), (16, "12 34\n!! ##", "es", "c"),
]


@pytest.fixture(scope="session")
def lspark(spark):
    return ship(spark)


@pytest.fixture(scope="session")
def docs(lspark):
    # extra columns, some named like an operator's own
    rows = [(*r, 0, 1, "k", 2.0, "f") for r in ROWS]
    return lspark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size long, key string, score double, found string").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
