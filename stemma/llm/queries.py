"""The operators applied to their whole tables, with the parameters used in production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stemma.llm import bpe, exact_dedup, html_text, media, packing, pii, quality, secrets_scan, simhash, urls

_ORACLE: dict[str, str] = {}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_read(spark, sf_dir, "documents"))


_ORACLE["op1_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n
"""


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_round_trip(_read(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_read(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_read(spark, sf_dir, "pages"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_read(spark, sf_dir, "pages"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(pii.KEY_CONF, "key of the published query, which hides nothing")
    return pii.replaced(_read(spark, sf_dir, "documents"), key)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.span_digests(secrets_scan.scan(_read(spark, sf_dir, "documents")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels").select("doc_id", "quality"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
