"""Choices by hash instead of random streams: they depend on seed, purpose and key alone, not on partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42


def hashed(purpose: str, *keys: Column, seed: int = SEED) -> Column:
    """MD5 (hex) of seed, purpose and keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), *(k.cast("string") for k in keys)))


def number(h: Column, at: int = 1) -> Column:
    """A whole number below 2^52 from 13 hex digits of a hash."""
    return F.conv(F.substring(h, at, 13), 16, 10).cast("bigint")


def unit(h: Column, at: int = 1) -> Column:
    """A number in [0, 1)."""
    return number(h, at) / F.lit(float(1 << 52))


def running(df: DataFrame, by: list[str], order: list[str], value: Column, out: str, digits: int = 3) -> DataFrame:
    """Add the sum of ``value`` over the rows before this one within ``by``, in the order of ``order``.

    The first column of ``order`` is a hash in hex. Rows fall into 16**digits
    buckets by its first digits; totals of buckets are summed once per group, rows
    only within their bucket, so a group of any size is spread over tasks.
    """
    h = order[0]
    cut = df.withColumn("_bucket", F.substring(h, 1, digits)).withColumn("_value", value)
    groups = [F.col(c).alias(f"_{c}") for c in by]
    totals = cut.groupBy(*groups, "_bucket").agg(F.sum("_value").alias("_total"))
    before = F.sum("_total").over(Window.partitionBy(*(f"_{c}" for c in by)).orderBy("_bucket")) - F.col("_total")
    totals = totals.withColumn("_offset", before).drop("_total").withColumnRenamed("_bucket", "_b")
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], F.col("_bucket") == F.col("_b"))
    inside = F.sum("_value").over(Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_value")
    return cut.join(totals, on).withColumn(out, F.col("_offset") + inside).drop("_bucket", "_value", "_b", "_offset", *(f"_{c}" for c in by))


def first_by_hash(df: DataFrame, by: list[str], purpose: str, keys: list[str], most: Column, seed: int = SEED) -> DataFrame:
    """Rows whose place in hash order within ``by`` is below ``most``."""
    ranked = running(df.withColumn("_h", hashed(purpose, *(F.col(k) for k in keys), seed=seed)), by, ["_h", *keys], F.lit(1), "_place")
    return ranked.filter(F.col("_place") < most).drop("_h", "_place")
