"""The registered queries of this subpackage: thin calls of its operators on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, embeddings, licenses, mixing, packing, pii, quality, simhash, sql, substring, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_read(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_read(spark, sf_dir, "pages"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.planted(_read(spark, sf_dir, "conversations")))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(_read(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_read(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digests(_read(spark, sf_dir, "documents"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_read(spark, sf_dir, "embeddings"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pii, op2_warc, op3_chat_formatting, op4_substring_dedup, op5_best_fit_packing, op6_source_mixing, op7_simhash, op8_license_scan, op9_embedding_dedup, op10_quality_rules)}


def oracle_sql() -> dict[str, str]:
    return sql.SQL
