"""The registered queries of the training-data operators: thin, over whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelet.llm import ann, bpe, conversation_repair, covertree, langid, minhash, packing, prefix_trie, quality, secret_scan, suffix, token_files, toxicity
from lakelet.llm.common import fold, read_table, ship
from lakelet.llm.conversation_sql import OP12_SQL, OP13_SQL

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where("vec_id % 50 = 0"), k=5)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return suffix.removal_digests(read_table(spark, sf_dir, "documents"), length=200)


def op3_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), width=2, num=80, den=100)


def op4_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(read_table(spark, sf_dir, "documents"), TOKENIZER, TOKENIZER_RANKS, end_id=2, max_len=1024, with_ids=False)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs, train_fold=(4, 2)))
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.fit(docs, recall=0.99))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels"), train_fold=(4, 2)), cut=0.3)
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op8_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = read_table(spark, sf_dir, "embeddings")
    return covertree.top_products(rows, rows.where("vec_id % 50 = 0"), k=5)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, read_table(spark, sf_dir, "labels"), train_fold=(3, 1)), cut=0.5)
    return found.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.digests(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return token_files.read_files(token_files.write_files(read_table(spark, sf_dir, "documents"), WORD_TOKENIZER, end_id=2))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = read_table(spark, sf_dir, "conversations")
    return conversation_repair.digests(conversation_repair.damage(rows), ids=rows.select("conv_id"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return prefix_trie.rebuilt_trie(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1_ann,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_minhash_forest": op3_minhash_forest,
    "op4_bestfit_packing": op4_bestfit_packing,
    "op5_language_id": op5_language_id,
    "op6_secret_scan": op6_secret_scan,
    "op7_toxicity": op7_toxicity,
    "op8_covertree": op8_covertree,
    "op9_quality": op9_quality,
    "op10_bpe": op10_bpe,
    "op11_token_files": op11_token_files,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_prefix_trie": op13_prefix_trie,
}

OP8_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(d.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.e) = len(d.e)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
WHERE n <= 5
"""

# every 200-byte string counted by its hash; blocks keep the strings short that are cut from
OP2_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), b AS (
  SELECT r, 1000 * j AS lo, substr(h, 2000 * j + 1, 2398) AS part
  FROM (SELECT r, h, unnest(range((length(h) // 2 + 999) // 1000)) AS j FROM d)
), w AS (
  SELECT r, lo + i AS i, md5_number(substr(part, 2 * i + 1, 400)) AS name
  FROM (SELECT r, lo, part, unnest(range(length(part) // 2 - 199)) AS i FROM b)
), c AS (
  SELECT r, i FROM w QUALIFY count(*) OVER (PARTITION BY name) > 1
), f AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS first FROM c
), u AS (
  SELECT r, min(i) AS lo, max(i) + 200 AS hi
  FROM (SELECT r, i, sum(first) OVER (PARTITION BY r ORDER BY i) AS run FROM f) GROUP BY r, run
), t AS (
  SELECT r, list({'lo': lo, 'hi': hi} ORDER BY lo) AS cut, sum(hi - lo) AS n_removed FROM u GROUP BY r
), k AS (
  SELECT doc_id, h, coalesce(n_removed, 0) AS n_removed, coalesce(len(cut), 0) AS n_spans,
    list_concat([0], [x.hi FOR x IN coalesce(cut, [])]) AS los, list_concat([x.lo FOR x IN coalesce(cut, [])], [length(h) // 2]) AS his
  FROM d LEFT JOIN t ON t.r = d.r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
  sha256(unhex(array_to_string([h[2 * lo + 1:2 * his[j]] FOR lo, j IN los], ''))) AS kept_sha256
FROM k
"""

# links by a join on shingles, components by reachability: for tables of a thousand documents or so
OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE len(words) WHEN 0 THEN [] WHEN 1 THEN words
    ELSE list_distinct([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) END AS shingles
  FROM w
), x AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), r(doc_id, root) AS (
  SELECT doc_id, doc_id FROM s
  UNION
  SELECT l.b, r.root FROM r JOIN l ON r.doc_id = l.a
)
SELECT s.doc_id, CAST(len(any_value(shingles)) AS BIGINT) AS n_shingles, min(root) AS component_id, s.doc_id = min(root) AS kept
FROM s JOIN r ON r.doc_id = s.doc_id
GROUP BY s.doc_id
"""

ORACLE: dict[str, str] = {"op2_suffix_dedup": OP2_SQL, "op3_minhash_forest": OP3_SQL, "op8_covertree": OP8_SQL, "op12_conversation_repair": OP12_SQL, "op13_prefix_trie": OP13_SQL}
