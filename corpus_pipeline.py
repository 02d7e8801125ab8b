"""A corpus pipeline of five stages over the llm operators.

Each stage works on all that its predecessor kept and, but for the last, returns the
columns of documents. ``run`` applies the stages to the table documents.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import bpe, langid, mixing, simhash, toxicity
from lexiloom.llm.common import discard, small_batches, stored
from lexiloom.llm.queries import VOCABULARY, language_filter, toxic_field
from lexiloom.session import read_table, workers_import_package

#: Share of a text's n-grams that its language must hold, for the text to be of any known language.
LEAST_COVERAGE = 0.2


def ready(stage):
    """A stage that can be called by itself, on any session."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        workers_import_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@ready
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents in no known language: without letters, or with few known n-grams."""
    names = [F.col(f"d.{c}").alias(c) for c in docs.columns]
    found = langid.identify(docs.select(F.struct(*docs.columns).alias("d"), "text"), language_filter(docs))
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("coverage") >= LEAST_COVERAGE)).select(*names)


@ready
def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that score as toxic."""
    names = [F.col(f"d.{c}").alias(c) for c in docs.columns]
    found = toxicity.score(docs.select(F.struct(*docs.columns).alias("d"), "text"), toxic_field(docs, read_table(spark, sf_dir, "labels")))
    return found.filter("predicted = 0").select(*names)


@ready
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose five-word shingles are 0.8 alike or more."""
    return simhash.keep_one(docs)


@ready
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents so that sources meet their target weights; a document occurs as often as it is drawn."""
    return mixing.mixed(docs).select(*docs.columns)


@ready
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document drawn, with the digests of ids and decoded bytes."""
    small_batches(spark)
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    return bpe.digests(docs.select("doc_id", "source", "text"), path, pattern).drop("text")


STAGES = [("language_id", language), ("toxicity", toxic), ("simhash_near_dedup", near_dedup), ("mixing", mix), ("byte_level_bpe", tokens)]

#: SQL can't express the fitted classifiers of the first two stages; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; what each keeps is written to the shared folder for the next."""
    docs = read_table(spark, sf_dir, "documents")
    before: list[DataFrame] = []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        discard(*before)  # a stage's documents have been read once the next one's are written
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
