"""The training-data operators as queries over whole tables, and SQL that checks them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from vigilpay.llm import (
    bytebpe, collocations, language, lm, mixing, pieces, prefixtrie, quality, ring, simhash, substring, suffix, vectors,
)

SHARDS = 8

#: The rank file of op11.
BYTE_VOCABULARY = os.environ.get("VIGILPAY_BYTE_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


#: Documents that the target model of op10 learns from.
TARGET = "quality = 1 AND toxic = 0"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.load_model(corpus_pipeline.PIECE_MODEL)
    encoded = pieces.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), model, check="round_trip")
    return encoded.select("doc_id", F.size("ids").alias("n_ids"), "ids", "round_trip")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeat_report(_table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_report(docs).select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeat_report(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_report(docs).select("doc_id", "size", "source_size", "target", "taken")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring.shard_documents(_table(spark, sf_dir, "documents"), SHARDS)
    return placed.selectExpr(
        "doc_id", "size", "text_crc32", "'rows' AS law", "shard", "slot", "CAST(NULL AS INT) AS grown_shard"
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return lm.cross_entropy_difference(docs, labels, TARGET)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bytebpe.load_vocabulary(BYTE_VOCABULARY)
    encoded = bytebpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary, keep=["doc_id"])
    # the decimal ids are made before decoding, so the ids themselves travel once
    encoded = encoded.withColumn("joined", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256))
    decoded = bytebpe.decode(encoded, vocabulary)
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.col("joined").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_sentencepiece": op1_sentencepiece,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_id": op6_language_id,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_mixing": op8_mixing,
    "op9_sharding": op9_sharding,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_collocations": op12_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE = {
    "op2_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), w AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d)
), m AS (
  SELECT g, min(doc_id) AS lo FROM w GROUP BY g
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM w JOIN m USING (g) WHERE lo < doc_id
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS words, count(*) AS n
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d) ANTI JOIN gone USING (doc_id, p)
  GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op5_quality_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), windows AS (
  SELECT k, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5
), counted AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, array_to_string(ws[i:i + 4], ' ')) AS c FROM windows
), repeated AS (
  SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + 5)) AS p FROM counted WHERE c > 1) GROUP BY k
), measured AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN repeated USING (k)
), based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (100 * n_symbols > 20 * n_words) AND NOT (100 * n_dup_lines > 30 * n_lines)
    AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words AS kept
FROM based
""",
    "op12_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
), g AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w
), f AS (
  SELECT lang, ws[i:i + k - 1] AS ph, k, CAST(count(*) AS HUGEINT) AS f
  FROM g, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws) GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT * FROM f WHERE k >= 2 AND f >= 30
), parts AS (
  SELECT lang, f, ph[i:i + m - 1] AS ph
  FROM (SELECT lang, ph, k, f, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k)
), longest AS (
  SELECT lang, ph, max(f) AS most FROM parts GROUP BY ALL
), own AS (
  SELECT c.* FROM c LEFT JOIN longest USING (lang, ph) WHERE most IS NULL OR 100 * most < 80 * f
), cuts AS (
  SELECT lang, ph, f, unnest(range(1, k)) AS cut FROM own
), scored AS (
  SELECT cuts.lang, cuts.ph, cuts.f AS a, cut, x.f AS l, y.f AS r, (2000000 * cuts.f) // (x.f + y.f) AS score
  FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.ph = cuts.ph[1:cut]
    JOIN f AS y ON y.lang = cuts.lang AND y.ph = cuts.ph[cut + 1:]
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(ph, ' '))) AS rank,
  array_to_string(ph, ' ') AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM best JOIN n USING (lang) QUALIFY rank <= 2000
""",
    # crc32 has no DuckDB function: its bits are worked out from the digits
    "op13_prefix_trie": r"""
WITH t AS (
  SELECT conv_id AS c, sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, ''))) AS h,
    octet_length(encode(coalesce(text, ''))) AS bytes, turn
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, h, bytes, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, h) AS pos FROM t
), plan AS (
  SELECT c, has, c - c % 5 AS base, xor(list_reduce(
      list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
      lambda a, x: list_reduce(range(0, 8), lambda b, i: CASE WHEN b % 2 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END, xor(a, x)),
      4294967295), 4294967295) % 9 AS take
  FROM (SELECT c, count(*) AS has FROM own GROUP BY c)
), seq AS (
  SELECT plan.c, pos, h, bytes FROM plan JOIN own ON own.c = base WHERE pos <= take
  UNION ALL
  SELECT plan.c, pos - take + least(take, coalesce(b.has, 0)), h, bytes
  FROM plan JOIN own USING (c) LEFT JOIN (SELECT c AS base, has FROM plan) AS b ON b.base = plan.base WHERE pos > take
), whole AS (
  SELECT c, coalesce(list(h ORDER BY pos), []) AS hs, coalesce(list(bytes ORDER BY pos), []) AS bs
  FROM plan LEFT JOIN seq USING (c) GROUP BY c
), whole2 AS (
  SELECT c, list_filter(hs, lambda x: x IS NOT NULL) AS hs, list_filter(bs, lambda x: x IS NOT NULL) AS bs FROM whole
), member AS (
  SELECT c, d, hs[1:d] AS path, CASE WHEN d > 0 THEN bs[d] ELSE 0 END AS bytes, len(hs) = d AS done
  FROM (SELECT c, hs, bs, unnest(range(0, len(hs) + 1)) AS d FROM whole2)
), node AS (
  SELECT d, path, min(c) AS c, count(*) AS n, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (done), '')) AS ends
  FROM member GROUP BY d, path
), kids AS (
  SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS kids FROM node WHERE d > 0 GROUP BY ALL
), valued AS (
  SELECT node.*, coalesce(kids, 0) AS kids, (n - 1) * bytes AS saved FROM node LEFT JOIN kids USING (d, path)
), up AS (
  SELECT path[1:e] AS path, e AS d, sum(saved) AS saved, count(*) FILTER (kids = 0) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM valued) GROUP BY ALL
)
SELECT v.c AS conv_id, v.d AS depth, parent.c AS parent_conv_id, v.n AS n_convs, v.kids AS n_children,
  up.leaves AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens, v.ends AS ends_sha256
FROM valued AS v JOIN up USING (d, path) LEFT JOIN node AS parent ON parent.d = v.d - 1 AND parent.path = v.path[1:v.d - 1]
""",
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
