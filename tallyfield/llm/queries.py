"""Registered queries over the given tables, and SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm import (
    decontaminate,
    langid,
    mixing,
    piececount,
    pii,
    quality,
    rules,
    secrets,
    simhash,
    spelling,
    tokens,
    warc,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The word tokenizer of the public collection."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model_path() -> str:
    """The piece tokenizer of the public collection."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_and_read(_table(spark, sf_dir, "documents"), tokenizer_path())


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest_columns(secrets.scan(_table(spark, sf_dir, "documents")))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(_table(spark, sf_dir, "documents"))


def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(_table(spark, sf_dir, "pages"))


def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "coverage", "slots", "consistency", "same_values")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(_table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), simhash.as_hex(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piececount.count_tokens(_table(spark, sf_dir, "documents"), piece_model_path())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_token_file, op3_secret_scan, op4_source_mix, op5_pseudonyms, op6_warc_index,
        op7_benchmark_leaks, op8_quality_rules, op9_language, op10_simhash,
        op11_whitening, op12_spelling_variants, op13_token_counts,
    )
}

SQL: dict[str, str] = {
    # Base32 of the digest: its hex digits as bits, five at a time.
    "op6_warc_index": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41),
        lambda i: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', hex[i:i])]), '') AS bits FROM h),
d AS (SELECT page_id, payload_bytes, hex, array_to_string(list_transform(range(0, 32),
        lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
          16 * CAST(bits[5*k+1:5*k+1] AS INT) + 8 * CAST(bits[5*k+2:5*k+2] AS INT) + 4 * CAST(bits[5*k+3:5*k+3] AS INT)
          + 2 * CAST(bits[5*k+4:5*k+4] AS INT) + CAST(bits[5*k+5:5*k+5] AS INT), 1)), '') AS payload_digest FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f""",
}
