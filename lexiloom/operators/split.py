"""Cluster-level splits and rebalancing: rows of one cluster never part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.chance import SEED, hashed, running
from lexiloom.operators.cluster import cluster_table

HELD_OUT = ("hatexplain",)


def pick(clusters: DataFrame, target: int, purpose: str, seed: int = SEED) -> DataFrame:
    """Clusters taken in hash order while their class's total before them is below ``target``. (WIN-05)

    The last one may overshoot, as in a greedy loop over a permutation; classes are independent.
    """
    ordered = clusters.withColumn("_h", hashed(purpose, F.col("cluster"), seed=seed))
    return running(ordered, ["label"], ["_h", "cluster"], F.col("size"), "_before").filter(F.col("_before") < target).select("cluster")


def held_out(sources: tuple[str, ...] = HELD_OUT) -> Column:
    """Whether a cluster may go to test. (FLT-07)"""
    return F.col("source").isin(*sources) | (F.col("split_origin") == "test")


def assign_split(df: DataFrame, order: list[str], test_target: int = 30_000, val_target: int = 20_000, sources: tuple[str, ...] = HELD_OUT, seed: int = SEED) -> DataFrame:
    """Add ``split``: test from held-out clusters, validation from the rest, the remainder train. (SPL-01, JN-01, JN-02)"""
    table = cluster_table(df, order)
    test = pick(table.filter(held_out(sources)), test_target // 2, "test", seed)
    rest = table.join(test, "cluster", "left_anti")
    validation = pick(rest, val_target // 2, "validation", seed)
    taken = test.withColumn("_split", F.lit("test")).unionByName(validation.withColumn("_split", F.lit("validation")))
    return df.join(taken, "cluster", "left").withColumn("split", F.coalesce("_split", F.lit("train"))).drop("_split")


def with_obfuscated(df: DataFrame) -> DataFrame:
    """Rows of all splits plus a copy of the mutated test rows as ``test_obfuscated``. (SPL-02)"""
    return df.unionByName(df.filter("split = 'test' AND mutated = 1").withColumn("split", F.lit("test_obfuscated")))


def rebalance(df: DataFrame, order: list[str], seed: int = SEED) -> DataFrame:
    """Drop clusters of train's majority label, in hash order, until at least the excess is gone. (BAL-01, WIN-06, JN-03)

    A cluster's label is its first row's. Other splits, and a balanced train, stay as they are.
    """
    train = df.filter("split = 'train'")
    table = cluster_table(train, order).select("cluster", "size", F.col("first_label").alias("label"))
    totals = table.agg(F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("size"))), F.lit(0)).alias("pos"), F.coalesce(F.sum(F.when(F.col("label") == 0, F.col("size"))), F.lit(0)).alias("neg"))
    ordered = table.withColumn("_h", hashed("balance", F.col("cluster"), seed=seed))
    ranked = running(ordered, ["label"], ["_h", "cluster"], F.col("size"), "_before")
    majority = F.when(F.col("pos") > F.col("neg"), 1).otherwise(0)
    drop = ranked.join(F.broadcast(totals), (F.col("label") == majority) & (F.col("_before") < F.abs(F.col("pos") - F.col("neg")))).select("cluster")
    return df.filter("split <> 'train'").unionByName(train.join(drop, "cluster", "left_anti").select(*df.columns))


def benchmark_set(df: DataFrame) -> DataFrame:
    """Test rows and, tagged apart, their mutated subset. (BEN-01); sort by (benchmark_split, cluster) to export"""
    test = df.filter("split = 'test'")
    return test.withColumn("benchmark_split", F.lit("test")).unionByName(test.filter("mutated = 1").withColumn("benchmark_split", F.lit("test_obfuscated"))).drop("split")
