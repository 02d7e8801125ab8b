"""Exact deduplication in which order decides who survives, and unions with precedence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions.text import dedup_key, digest


def keep_first(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row of each key. (WIN-01, WIN-02)

    Implemented as a grouped minimum of (order, row), so copies of a key are merged
    before the shuffle and a key with a third of all rows stays one row per task.
    """
    row = F.struct(*order, F.struct(*df.columns).alias("_row"))
    return df.groupBy(key.alias("_key")).agg(F.min(row).alias("_first")).select("_first._row.*")


def dedup_exact(df: DataFrame, order: list[str]) -> DataFrame:
    """Keep the first row of each text, compared in lower case and trimmed. (WIN-01)"""
    return keep_first(df, dedup_key(F.col("text")), order)


def dedup_text(df: DataFrame, order: list[str]) -> DataFrame:
    """Keep the first row of each text as it is. (WIN-02)"""
    return keep_first(df, F.col("text"), order)


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns that one lacks are null. (SET-01)"""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_first(*frames: DataFrame, order: list[str]) -> DataFrame:
    """Distinct by text, rows of earlier frames before those of later ones. (SET-02, MRG-02)"""
    ranked = union_all(*(f.withColumn("_rank", F.lit(i)) for i, f in enumerate(frames)))
    return keep_first(ranked, F.col("text"), ["_rank", *order]).drop("_rank")


def added(old: DataFrame, new: DataFrame, order: list[str]) -> DataFrame:
    """Rows of ``new``, distinct by text, whose text ``old`` lacks. (SET-02, SET-03)"""
    return dedup_text(new, order).join(old.select("text"), "text", "left_anti")


def unseen(rows: DataFrame, written: DataFrame) -> DataFrame:
    """Rows whose content digest has not been written yet. (SNK-03, JN-06)"""
    return rows.withColumn("_digest", digest(F.col("text"))).join(written.select(digest(F.col("text")).alias("_digest")).distinct(), "_digest", "left_anti").drop("_digest")


def normalize(df: DataFrame, order: list[str], least: int = 3, most: int = 512) -> DataFrame:
    """Keep-first deduplication, then bounds on words. (NRM-01, FLT-02)"""
    from lexiloom.functions.text import word_count

    return dedup_exact(df, order).filter(word_count(F.col("text")).between(least, most))


def rank_in_group(df: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each group. (FLT-10, FLT-11)"""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= most).drop("_place")
