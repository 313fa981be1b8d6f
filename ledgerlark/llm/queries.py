"""One query per operator over the whole of its table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import (
    bbit_minhash,
    block_max,
    chunk_recipes,
    hard_negatives,
    hash_tree,
    license_rules,
    merkle_manifest,
    ordinal_quality,
    ppm_language,
    prefix_bpe,
    slack_packing,
    streaming_viterbi,
    suffix_dedup,
)
from ledgerlark.llm.merkle_sql import merkle_sql

SHARDS = 40
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.near_duplicates(documents(spark, sf_dir))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_streaming_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and checksum of the ids, and whether decoding gives the text back."""
    docs = documents(spark, sf_dir)
    back = streaming_viterbi.decode(streaming_viterbi.encode(docs, PIECES), PIECES)
    return back.select("doc_id", "n_ids", "ids_crc32", "text_sha256")


def op4_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shard_rows(documents(spark, sf_dir), hash_tree.regular_tree(SHARDS))


def op5_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_language.identify(documents(spark, sf_dir))


def op6_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(documents(spark, sf_dir))


def op7_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id is divisible by 50 is a query against all rows."""
    docs = documents(spark, sf_dir)
    return block_max.top_k(docs, docs.where("doc_id % 50 = 0"))


def op8_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    ratings = ordinal_quality.ratings_of(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ordinal_quality.grade(docs, ordinal_quality.fit(docs, ratings, grades=3))


def op9_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.exact_duplicates(documents(spark, sf_dir))


def op10_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slack_packing.pack(documents(spark, sf_dir), WORD_TOKENIZER)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; every seventh row's label is moved on by one."""
    vec_id, given = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(vec_id % 7 == 0, (given + 1) % 10).otherwise(given)
    return hard_negatives.hard_negatives(
        spark.read.parquet(f"{sf_dir}/embeddings.parquet"), anchor=vec_id % 100 == 0, label=moved
    )


def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's ids and of the text they decode to."""
    coded = prefix_bpe.encode(documents(spark, sf_dir), WORD_TOKENIZER)
    return coded.select(
        "doc_id",
        F.floor(F.length("ids") / F.lit(4)).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's proof; of a third of the ids the text is lower-cased after the manifest is made."""
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    lowered = F.when(hit, merkle_manifest.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    proofs = merkle_manifest.manifest(documents(spark, sf_dir), tampered={"text": lowered})
    return proofs.select(
        "doc_id", "leaf", "subroot", "root",
        merkle_manifest.proof_digest(F.col("steps")).alias("proof_sha256"), "folded_root", "verified",
    )


OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""

OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), n AS (
  SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
         CAST(row_number() OVER (
           PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

def _op6_sql() -> str:
    known = ", ".join(f"('{s}', '{i}')" for s, i in license_rules.SENTENCES.items())
    rules = ", ".join(f"('{r.license}', ' {' '.join(r.sequence)} ')" for r in license_rules.RULES)
    return rf"""
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id,
         string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \t]+', E'\\1\n', 'g'), E'\n') AS parts
  FROM documents
), sentence AS (
  SELECT r, unnest(parts) AS s, generate_subscripts(parts, 1) AS i FROM cut
), known(s, k) AS (VALUES {known}), rules(license, line) AS (VALUES {rules}), found AS (
  SELECT r, i, k FROM (
    SELECT r, i, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS s FROM sentence
  ) JOIN known USING (s)
), line AS (
  SELECT r, count(*) AS n_known, string_agg(k, ' ' ORDER BY i) AS ids FROM found GROUP BY r
), matched AS (
  SELECT r, string_agg(DISTINCT license, ' ' ORDER BY license) AS licenses
  FROM line JOIN rules ON contains(' ' || ids || ' ', rules.line) GROUP BY r
)
SELECT doc_id, coalesce(n_known, 0) AS n_known, coalesce(ids, '') AS sentence_ids,
       coalesce(licenses, '') AS licenses
FROM cut LEFT JOIN line USING (r) LEFT JOIN matched USING (r)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bbit_minhash": op1_bbit_minhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_streaming_viterbi": op3_streaming_viterbi,
    "op4_hash_tree": op4_hash_tree,
    "op5_ppm_language": op5_ppm_language,
    "op6_license_rules": op6_license_rules,
    "op7_block_max": op7_block_max,
    "op8_ordinal_quality": op8_ordinal_quality,
    "op9_chunk_recipes": op9_chunk_recipes,
    "op10_slack_packing": op10_slack_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_bpe": op12_prefix_bpe,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op6_license_rules": _op6_sql(),
    "op9_chunk_recipes": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_merkle_manifest": merkle_sql(),
}
