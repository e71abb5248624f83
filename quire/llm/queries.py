"""The registered queries and the pipeline: thin digests over the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audit, decontamination, lm_scoring, mixing, pii, quality, simhash, tokens, topk, toxicity, url_filters, vector_codes, warc
from .common import table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.report(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge(pages, url_filters.rules_frame(spark)).select("page_id", "host", "path", "rule", "verdict")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_simhash": op2_simhash,
        "op3_decontamination": op3_decontamination,
        "op4_toxicity": op4_toxicity,
        "op5_url_filter": op5_url_filter,
        "op6_warc": op6_warc,
        "op7_top_k": op7_top_k,
        "op8_quality": op8_quality,
        "op9_pii": op9_pii,
        "op10_mixing": op10_mixing,
        "op11_filter_audit": op11_filter_audit,
        "op12_vector_codes": op12_vector_codes,
        "op13_byte_bpe": op13_byte_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontamination": decontamination.ORACLE,
        "op5_url_filter": url_filters.ORACLE,
        "op6_warc": warc.ORACLE,
        "op7_top_k": topk.ORACLE,
        "op10_mixing": mixing.oracle(),
        "op11_filter_audit": audit.ORACLE,
        "op12_vector_codes": vector_codes.oracle(),
    }
