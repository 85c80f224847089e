"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm import (
    byte_bpe, chat, divergence, hnsw, mixing, pages, pitman_yor, quality, secrets, sentencepiece, simhash, spelling, token_files,
)
from silverline.llm.common import table

PIECES = "piece_bpe_32k.model"


def piece_model() -> bytes:
    import public_tokenizers

    return Path(public_tokenizers.path(PIECES)).read_bytes()


def tokenizer_file() -> str:
    import public_tokenizers

    return Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")


def sentencepiece_query(spark, sf_dir: str) -> DataFrame:
    return sentencepiece.encode_documents(table(spark, sf_dir, "documents"), piece_model())


def quality_query(spark, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         "stratum", "severity", "cutoff")


def simhash_query(spark, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def mixing_query(spark, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def secrets_query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(secrets.samples(docs)))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secrets.spell(F.col("base")), 256).alias("base_sha256"), secrets.spell(F.col("spans")).alias("spans"))


def chat_query(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    chosen = turns.withColumnRenamed("conv_id", "pair_id")
    return chat.format_preferences(chosen, chat.with_swapped_replies(turns))


def nearest_query(spark, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


def pitman_yor_query(spark, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"))


def pages_query(spark, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def token_files_query(spark, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), tokenizer_file())


def divergence_query(spark, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def spelling_query(spark, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def byte_bpe_query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes()
    return byte_bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


QUERIES = {
    "op1_sentencepiece": sentencepiece_query,
    "op2_quality_rules": quality_query,
    "op3_preferences": chat_query,
    "op4_hnsw": nearest_query,
    "op5_pitman_yor": pitman_yor_query,
    "op6_simhash": simhash_query,
    "op7_main_text": pages_query,
    "op8_mixing": mixing_query,
    "op9_secrets": secrets_query,
    "op10_token_files": token_files_query,
    "op11_divergence": divergence_query,
    "op12_spelling": spelling_query,
    "op13_byte_bpe": byte_bpe_query,
}

MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight, source IS NULL, source) AS k FROM sources),
before AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM ranked),
-- the first source, by how early it fills, that the remaining sum does not fill
level AS (SELECT rest, share FROM before WHERE weight * rest <= 3 * source_size * share ORDER BY k LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN weight * level.rest > 3 * source_size * level.share THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(weight AS DOUBLE) * CAST(level.rest AS DOUBLE) / CAST(level.share AS DOUBLE) END AS target
  FROM sources, level),
rated AS (
  SELECT d.doc_id, d.size, CAST(t.source_size AS BIGINT) AS source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0.0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""

ORACLE = {"op8_mixing": MIXING_SQL, "op11_divergence": divergence.ORACLE_SQL}
