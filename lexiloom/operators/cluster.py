"""Clusters of texts with one canonical form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions.text import canonicalize
from lexiloom.operators.dedup import dedup_exact
from lexiloom.session import kept as stored


def with_canon(df: DataFrame, split_empty: bool = False) -> DataFrame:
    """Add ``canon``; with ``split_empty``, texts without letters or digits get a key of their own. (CLU-01)"""
    canon = canonicalize(F.col("text"))
    if split_empty:
        canon = F.when(canon == "", F.concat(F.lit("∅"), F.md5("text"))).otherwise(canon)
    return df.withColumn("canon", canon)


def assign_clusters(df: DataFrame, order: list[str], dense: bool = False, split_empty: bool = False) -> DataFrame:
    """Deduplicate exactly, then add ``cluster``. (CLU-01, WIN-04)

    By default the id is a hash of the canonical form, which needs no order. With
    ``dense`` it is the place of the form's first appearance, from 0: distinct forms
    are dealt out by ranges of that order and numbered range by range.
    """
    kept = with_canon(dedup_exact(df, order), split_empty)
    if not dense:
        return kept.withColumn("cluster", F.xxhash64("canon")).drop("canon")
    first = kept.groupBy("canon").agg(F.min(F.struct(*order)).alias("_at"))
    ranged = stored(first.repartitionByRange("_at").withColumn("_part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy(F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_at")) - 1 + F.col("_before")
    ids = ranged.join(F.broadcast(sizes.withColumn("_before", before)), F.col("_part") == F.col("_p")).select("canon", place.cast("bigint").alias("cluster"))
    return kept.join(ids, "canon").drop("canon")


def lineage_clusters(df: DataFrame, base: str = "base_text") -> DataFrame:
    """Cluster variants by the canonical form of the text they were made from, so that none leaks across splits."""
    return df.withColumn("cluster", F.xxhash64(canonicalize(F.coalesce(F.col(base), F.col("text")))))


def cluster_table(df: DataFrame, order: list[str]) -> DataFrame:
    """One row per cluster: size, most frequent label (the smaller on a tie), first source and split_origin. (AGG-03)"""
    at = F.struct(*order)
    return df.groupBy("cluster").agg(
        F.count("*").alias("size"), (2 * F.sum("label") > F.count("*")).cast("int").alias("label"),
        F.min_by("source", at).alias("source"), F.min_by("split_origin", at).alias("split_origin"), F.min_by("label", at).cast("int").alias("first_label"),
    )


def cluster_counts(df: DataFrame) -> DataFrame:
    """Number of clusters and of those with several rows. (AGG-05)"""
    sizes = df.groupBy("cluster").agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("clusters"), F.count_if(F.col("n") > 1).alias("multi_row"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
