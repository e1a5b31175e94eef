"""Registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from hostelry.llm import bpe, jaccard, language, minhash, mixing, quality, search, spelling, substrings, token_counts, token_files, turns, warc
from hostelry.llm.common import documents, ship


def _tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(documents(ship(spark), sf_dir))


def op2_search_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(ship(spark), sf_dir)
    return search.search(docs, docs.filter("doc_id % 100 = 0"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_encoded(documents(ship(spark), sf_dir), _tokenizer(), with_ids=False)


def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = ship(spark).read.parquet(f"{sf_dir}/pages.parquet")
    return warc.warc_round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(documents(ship(spark), sf_dir))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(ship(spark), sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(ship(spark), sf_dir), _tokenizer())


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(ship(spark), sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(ship(spark), sf_dir))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(documents(ship(spark), sf_dir), _tokenizer())


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair_conversations(ship(spark).read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.spelling_variants(documents(ship(spark), sf_dir))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.minhash_components(documents(ship(spark), sf_dir))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


QUERIES = {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (op1_substring_dedup, op2_search_top_k, op3_bpe_round_trip, op4_warc_archives, op5_jaccard_components, op6_quality_rules, op7_token_counts, op8_mix_sources,
                                   op9_language_id, op10_token_files, op11_repair_conversations, op12_spelling_variants, op13_minhash_components)}

OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
c AS (SELECT count(*) AS n, avg(len(ws)) AS mean FROM w),
t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS term FROM w) GROUP BY doc_id, term),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
s AS (
  SELECT q.doc_id AS query_id, t.doc_id,
         round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / mean))), 6) AS score
  FROM (SELECT doc_id, term FROM t WHERE doc_id % 100 = 0) q JOIN t USING (term) JOIN f USING (term) JOIN w ON w.doc_id = t.doc_id, c
  GROUP BY q.doc_id, t.doc_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s)
SELECT query_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first IS NULL OR f.first IS NOT DISTINCT FROM d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first IS NOT DISTINCT FROM d.page_id THEN NULL ELSE f.first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

#: Pairs by shared shingle, then the smallest document reached by following links until nothing new is reached.
OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                      WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) END AS sh
  FROM w),
c AS (SELECT sh, min(doc_id) AS class, len(sh) AS n FROM (SELECT doc_id, list_sort(sh) AS sh FROM s) WHERE len(sh) > 0 GROUP BY sh),
t AS (SELECT class, n, unnest(sh) AS shingle FROM c),
p AS (
  SELECT a.class AS a, b.class AS b FROM t a JOIN t b ON a.shingle = b.shingle AND a.class <> b.class
  GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(class, reached) AS (SELECT class, class FROM c UNION SELECT r.class, p.b FROM r JOIN p ON r.reached = p.a),
m AS (SELECT class, min(reached) AS component FROM r GROUP BY class),
k AS (SELECT c.sh, m.component FROM c JOIN m USING (class))
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, coalesce(k.component, s.doc_id) AS component_id
FROM s LEFT JOIN k ON list_sort(s.sh) = k.sh
"""

#: The same with the other threshold, and whether a document stands for its component.
OP13_SQL = OP5_SQL.replace(">= 80 *", ">= 85 *").replace("AS component_id\n", "AS component_id, s.doc_id = coalesce(k.component, s.doc_id) AS kept\n")

OP1_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS s, ws FROM w WHERE len(ws) >= 50),
h AS (SELECT doc_id, s, md5(array_to_string(ws[s:s + 49], ' ')) AS win FROM x),
o AS (SELECT win, min(doc_id) AS first FROM h GROUP BY win),
r AS (SELECT h.doc_id, h.s FROM h JOIN o USING (win) WHERE h.doc_id > o.first),
g AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM r),
k AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN ws ELSE [ws[i] FOR i IN range(1, len(ws) + 1) IF NOT list_contains(gone, i)] END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

#: crc32 by its table, which is made here too. Near words: equal but for one place, or one is the other without one place.
OP12_SQL = r"""
WITH RECURSIVE z AS (SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
o AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS n FROM o WHERE length(run) >= 6 GROUP BY doc_id, run),
y AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM d),
h AS (SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
  lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) AS crc FROM y, z),
w AS (SELECT word, sum(n)::BIGINT AS n FROM (
  SELECT CASE WHEN crc % 199 = 0 THEN run[:crc % length(run)] || run[crc % length(run) + 2:] ELSE run END AS word, n FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
v AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS less FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word AS a, b.word AS b FROM v a JOIN v b USING (i, less) WHERE a.word <> b.word
  UNION SELECT v.word, w.word FROM v JOIN w ON v.less = w.word
  UNION SELECT w.word, v.word FROM v JOIN w ON v.less = w.word),
m AS (SELECT a, count(*) AS n_near, arg_min(b, (-w.n, b)) AS near, max(w.n) AS near_n FROM p JOIN w ON w.word = b GROUP BY a),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM w LEFT JOIN m ON a = word),
r AS (SELECT word, word AS root, form FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON r.form = f.word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN r ON r.word = f.word AND r.form IS NULL
"""

SQL: dict[str, str] = {"op1_substring_dedup": OP1_SQL, "op2_search_top_k": OP2_SQL, "op4_warc_archives": OP4_SQL, "op5_jaccard_components": OP5_SQL, "op12_spelling_variants": OP12_SQL, "op13_minhash_components": OP13_SQL}
