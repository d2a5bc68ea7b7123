"""Registered queries of the subpackage and their oracle SQL.

Each query applies its operator, with the parameters used in production, to the
whole table and derives the contract's digest columns from the operator's
results.  Where SQL cannot express an operator, ``tests/llm`` holds it against
a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import (
    embedding_dedup, exact_dedup, fill_in_middle, language_id, lm_scoring, ngram_jaccard, packing,
    prefix_forest, secret_scan, sentencepiece_codec, substring_dedup, token_alignment, token_output,
)
from lodestar.llm._spark import documents

# Folder of the public tokenizers' files, if their package is not on the path.
TOKENIZERS = "/opt/tokenizers"
PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
BYTES = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    try:
        import public_tokenizers
    except ImportError:
        return f"{TOKENIZERS}/{name}"
    return public_tokenizers.path(name)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(documents(spark, sf_dir), tokenizer_path(PIECES))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return exact_dedup.mark_duplicates(docs).drop("text").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.near_duplicates(documents(spark, sf_dir))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.packed_sequences(documents(spark, sf_dir), tokenizer_path(WORDS))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(
        spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(PIECES)
    return sentencepiece_codec.encode_digests(
        sentencepiece_codec.encode(documents(spark, sf_dir), path), path)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir), texts=False).select(
        "doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    spans = F.col("spans")
    base = len(secret_scan.BASE_RULES)
    return secret_scan.scan(docs).select(
        "doc_id", secret_scan.count_kind(spans, 0).alias("n_assign"),
        secret_scan.count_kind(spans, 1).alias("n_access"),
        secret_scan.count_kind(spans, 2).alias("n_hex"),
        F.sha2(secret_scan.span_list(spans, kinds=base), 256).alias("base_sha256"),
        secret_scan.span_list(spans).alias("spans"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path(WORDS))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle.restore(fill_in_middle.fill_in_middle(documents(spark, sf_dir)))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2("restored", 256).alias("restored_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align(documents(spark, sf_dir), tokenizer_path(BYTES),
                                    tokenizer_path(PIECES), hashed=True)
    return aligned.documents.withColumnRenamed("groups", "groups_sha256")


def op13_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_token_output": op4_token_output,
    "op5_language_id": op5_language_id,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_token_alignment": op12_token_alignment,
    "op13_nearest_vectors": op13_nearest_vectors,
}

# The white space of the word contracts, as a DuckDB pattern.
_WORD = r"[^\x20\x09-\x0D]+"

ORACLE_SQL = {
    "op2_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op8_substring_dedup": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS s FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d)),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY s) AS n FROM win)
  WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS p FROM rep),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(len(regexp_extract_all(t, '{_WORD}')), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op11_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
g AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1,
    ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2,
    ('0x' || h[17:24])::BIGINT % 100 AS r3, ('0x' || h[25:32])::BIGINT % 100 AS r4 FROM d),
p AS (SELECT doc_id, t, n,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR r3 >= 100 THEN 'plain' WHEN r4 < 50 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(u[1:least(c1, c2)], '') AS prefix,
    array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
    array_to_string(u[greatest(c1, c2) + 1:], '') AS suffix FROM g)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle)
    ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p""",
}
