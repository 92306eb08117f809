"""A corpus pipeline of the library's training-data operators.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns the documents that go on
(columns of documents), the last one the tokens.  ``run`` writes each stage's result to the shared folder and reads
it again for the next stage, so a lost executor never reaches back further than one stage.

Defined results: stages decide on rows, by their texts: rows without an id, or with an id that other rows have, go only for
their own text (a null text has no language and goes in the first stage); columns of any name pass unchanged; an
empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimfold.llm import bpe, decontaminate, language_id, near_dedup, quality
from dimfold.llm.common import stored, table
from dimfold.llm.registry import tokenizer_path


def _kept(docs: DataFrame, verdict: Column, keep) -> DataFrame:
    """Rows whose verdict (computed once, under a name of its own) passes, with the columns of ``docs``."""
    name = f"v_{uuid.uuid4().hex}"
    return docs.withColumn(name, verdict).where(keep(F.col(name))).drop(name)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected."""
    model = language_id.fit(docs.where(language_id.is_training_row()))
    return _kept(docs, language_id.predictor(model)(F.col("text").cast("string")), lambda v: ~v["rejected"])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier predicts 0."""
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(quality.is_training_row()))
    return _kept(docs, quality.scorer(model)(F.col("text").cast("string")), lambda v: v >= quality.CUT)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class of near-duplicate texts, that of the least id."""
    return near_dedup.first_of_classes(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a benchmark item stands."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of the text that they decode to."""
    return bpe.digests(docs, tokenizer_path(), keep_ids=True)


STAGES = [("language", language), ("quality", good_quality), ("near_dedup", one_of_near_copies), ("decontaminate", decontaminated), ("bpe", tokens)]

#: SQL can't express the compression, kernel and sampling stages; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
