"""Queries of the operators of this subpackage, one per operator, and the pipeline."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dimfold.llm import (
    bpe, byte_bpe, decontaminate, fingerprints, language_id, license_scan, near_dedup, periodic_runs, quality, token_counts, token_store, url_filter, whitening)
from dimfold.llm.common import table

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


@functools.cache
def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@functools.cache
def ranks_path() -> tuple[str, str]:
    """Path of the rank file, and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(spark, table(spark, sf_dir, "documents"), tokenizer_path())


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_documents(spark, table(spark, sf_dir, "documents"), tokenizer_path())


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_documents(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), *ranks_path())


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_token_counts, op2_near_dedup, op3_url_filter, op4_bpe, op5_fingerprints, op6_decontaminate, op7_token_store,
           op8_license_scan, op9_language_id, op10_quality, op11_byte_bpe, op12_whitening, op13_periodic_runs)
    return {f.__name__: f for f in ops} | {"pipeline": _pipeline}


def oracle_sql() -> dict[str, str]:
    """Queries of this subpackage that SQL expresses."""
    return {}
