"""Samples and caps by hash order; quotas by largest remainder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions.chance import SEED, first_by_hash, hashed, running
from lexiloom.operators.dedup import dedup_text

#: Rows up to which a sample is taken by an ordered limit.
ORDERED = 100_000


def _with_total(df: DataFrame, by: list[str]) -> DataFrame:
    """Add the rows of each group (or of all) from a table of totals."""
    if not by:
        return df.join(F.broadcast(df.agg(F.count("*").alias("_n"))))
    totals = df.groupBy(*(F.col(c).alias(f"_of_{c}") for c in by)).agg(F.count("*").alias("_n"))
    on = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    return df.join(totals, on).drop(*(f"_of_{c}" for c in by))


def cap_per_source(df: DataFrame, keys: list[str], most_pos: int, most_neg: int, seed: int = SEED) -> DataFrame:
    """At most so many rows of each source and label; 0 is no cap. (WIN-07)"""
    cap = F.when(F.col("label") == 1, most_pos if most_pos > 0 else 1 << 60).otherwise(most_neg if most_neg > 0 else 1 << 60)
    return first_by_hash(df, ["source", "label"], "cap", keys, cap, seed)


def sample_n(df: DataFrame, keys: list[str], n: int, seed: int = SEED, purpose: str = "sample") -> DataFrame:
    """n rows, or all if there are fewer. (WIN-10, SRC-11)

    Up to ``ORDERED`` rows each task keeps its own first n and nothing else moves; beyond that all rows are ranked.
    """
    if n < 0:
        return df
    if n > ORDERED:
        return first_by_hash(df, [], purpose, keys, F.lit(n), seed)
    return df.withColumn("_h", hashed(purpose, *(F.col(k) for k in keys), seed=seed)).orderBy("_h", *keys).limit(n).drop("_h")


def head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows in an order. (FLT-12)"""
    return df.orderBy(*order).limit(n)


def sample_fraction(df: DataFrame, keys: list[str], fraction: float, least: int = 0, seed: int = SEED, purpose: str = "fraction") -> DataFrame:
    """Exactly the whole part of rows * fraction, ``least`` at least. (WIN-11, WIN-12)"""
    most = F.greatest(F.floor(F.col("_n") * fraction), F.lit(least))
    return first_by_hash(_with_total(df, []), [], purpose, keys, most, seed).drop("_n")


def quotas(df: DataFrame, cap: int) -> DataFrame:
    """(label, quota): ``cap`` dealt out by share, the largest remainders rounded up, the smaller label first on a tie."""
    counts = df.groupBy("label").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    exact = F.col("n") * F.lit(cap) / total
    dealt = counts.withColumn("exact", exact).withColumn("quota", F.floor("exact")).withColumn("left", F.lit(cap) - F.sum("quota").over(Window.partitionBy()))
    place = F.row_number().over(Window.orderBy(F.desc(F.col("exact") - F.col("quota")), "label"))
    raised = dealt.withColumn("quota", F.col("quota") + (place <= F.col("left")).cast("bigint"))
    return raised.select("label", F.when(total <= cap, F.col("n")).otherwise(F.col("quota")).alias("quota"))


def stratified(df: DataFrame, keys: list[str], cap: int, seed: int = SEED) -> DataFrame:
    """Exactly ``cap`` rows in the labels' ratio, or all if there are fewer. (WIN-08)"""
    limits = quotas(df, cap).select(F.col("label").alias("_label"), "quota")
    joined = df.join(F.broadcast(limits), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    return first_by_hash(joined, ["label"], "stratified", keys, F.col("quota"), seed).drop("quota")


def parse_caps(text: str) -> dict[str, int]:
    """``source=n,source=n`` to a dictionary; the last equals sign parts name and number."""
    caps = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        name, mark, n = part.rpartition("=")
        if not mark:
            raise ValueError(f"{part!r} has no source=number form")
        caps[name.strip()] = int(n)
    return caps


def subsample_sources(df: DataFrame, caps: dict[str, int], keys: list[str], order: list[str], seed: int = SEED) -> DataFrame:
    """Stratified sample of each listed source, the others as they are, distinct by text. (MRG-04, JN-07)"""
    if not caps:
        return df
    out = df.filter(~F.coalesce(F.col("source").isin(*caps), F.lit(False)))
    for source, cap in caps.items():
        out = out.unionByName(stratified(df.filter(F.col("source") == source), keys, cap, seed))
    return dedup_text(out, order)


def keep_ratio(df: DataFrame, keys: list[str], n: int, seed: int = SEED) -> DataFrame:
    """About n rows with the ratio of labels kept: max(1, round(n * pos / N)) of label 1, the rest of label 0. (WIN-09)"""
    counts = df.agg(F.count("*").alias("_all"), F.coalesce(F.sum(F.when(F.col("label") == 1, 1)), F.lit(0)).alias("_pos"))
    pos = F.greatest(F.lit(1), F.bround(F.lit(n) * F.col("_pos") / F.col("_all")).cast("bigint"))
    most = F.when(F.col("_all") <= n, F.col("_all")).when(F.col("label") == 1, pos).otherwise(F.greatest(F.lit(0), F.lit(n) - pos))
    return first_by_hash(df.join(F.broadcast(counts)), ["label"], "ratio", keys, most, seed).drop("_all", "_pos")


def in_hash_order(df: DataFrame, keys: list[str], purpose: str = "order", seed: int = SEED) -> DataFrame:
    """Add ``place``, the rank in hash order from 0."""
    return running(df.withColumn("_h", hashed(purpose, *(F.col(k) for k in keys), seed=seed)), [], ["_h", *keys], F.lit(1), "place").drop("_h")
