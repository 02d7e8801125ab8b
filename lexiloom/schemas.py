"""Schemas of the stages, and conforming frames to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIFIED = "text string, label tinyint, source string, origin_label string, split_origin string"
MUTATED = UNIFIED + ", mutated tinyint, variant tinyint"
DEDUPED = MUTATED + ", cluster bigint"
SPLIT = DEDUPED + ", split string"
EXPORT = DEDUPED
CANDIDATE = "text string, source string, subreddit string, created_utc bigint, score bigint, id string, category string, profanity tinyint, insult tinyint, attack tinyint"
LABELLED = "text string, source string, subreddit string, created_utc bigint, score bigint, id string, label tinyint, origin_label string, split_origin string"
BANK = UNIFIED + ", subreddit string, created_utc bigint, score bigint, category string, conf float"
BENCHMARK = EXPORT + ", benchmark_split string"


def fields(schema: str) -> list[tuple[str, str]]:
    return [tuple(part.split()) for part in schema.split(", ")]


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The schema's columns in order, cast to its types; those that ``df`` lacks are null."""
    have = set(df.columns)
    return df.select(*((F.col(f"`{n}`") if n in have else F.lit(None)).cast(t).alias(n) for n, t in fields(schema)))
