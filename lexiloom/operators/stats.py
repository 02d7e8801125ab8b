"""Counts, cross-tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values beyond which a cross-table without a list of them is refused.
MOST_COLUMNS = 1000


def counts(df: DataFrame, *by: str) -> DataFrame:
    """Rows by group, in long form. (AGG-01)"""
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def undecided_by_file(df: DataFrame) -> DataFrame:
    """Undecided rows of a written table by its files. (AGG-13)"""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return df.filter("label = -1").groupBy(name.alias("file")).agg(F.count("*").alias("n"))


def cross_table(df: DataFrame, row: str, column: str, values: list | None = None) -> DataFrame:
    """Rows by ``row`` and each value of ``column``, those listed or all that are there, 0 where none. (AGG-02)"""
    if values is None:
        values = [r[0] for r in df.select(column).distinct().dropna().orderBy(column).limit(MOST_COLUMNS + 1).collect()]
        if len(values) > MOST_COLUMNS:
            raise ValueError(f"{column} has over {MOST_COLUMNS} values; list those wanted")
    return df.groupBy(row).agg(*(F.count_if(F.col(column) == v).alias(f"{column}_{v}") for v in values))


def split_summary(df: DataFrame) -> DataFrame:
    """Rows, positives and negatives of each split and of all. (AGG-11)"""
    return df.rollup("split").agg(F.count("*").alias("rows"), F.sum(F.col("label").cast("long")).alias("pos"), F.sum((1 - F.col("label")).cast("long")).alias("neg")).withColumn("split", F.coalesce("split", F.lit("total")))


def report(df: DataFrame) -> DataFrame:
    """The statistics of an export in long form (kind, split, value, n); pass ``with_obfuscated`` rows to count those too. (AGG-12, SNK-05)"""
    sets = df.groupBy("split", "label", "source", "mutated").agg(F.count("*").alias("n"))
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in (("label_distribution", "label"), ("source_distribution", "source"), ("mutated_share", "mutated"))), F.struct(F.lit("splits").alias("kind"), F.lit("rows").alias("value")))
    return sets.select("split", "n", F.explode(kinds).alias("k")).groupBy("k.kind", "split", "k.value").agg(F.sum("n").alias("n"))


def class_excess(df: DataFrame) -> DataFrame:
    """Totals of both classes, which is larger and by how much. (AGG-06)"""
    totals = df.agg(F.coalesce(F.sum("label").cast("long"), F.lit(0)).alias("pos"), F.coalesce(F.sum(1 - F.col("label")).cast("long"), F.lit(0)).alias("neg"))
    return totals.select("pos", "neg", F.when(F.col("pos") > F.col("neg"), 1).otherwise(0).alias("majority"), F.abs(F.col("pos") - F.col("neg")).alias("excess"))


def length_limit(df: DataFrame, length: str, share: float = 0.95, least: int = 16, most: int = 512, sample: int = 0, keys: list[str] | None = None) -> DataFrame:
    """A percentile of lengths with linear interpolation, cut to a whole number and clamped; over ``sample`` rows by hash of ``keys`` if told. (AGG-07)"""
    if sample:
        from lexiloom.operators.sampling import sample_n

        df = sample_n(df, keys or df.columns, sample, purpose="length")
    p = F.percentile(F.col(length), F.lit(share)).cast("int")
    return df.agg(p.alias("p95"), F.greatest(F.lit(least), F.least(p, F.lit(most))).alias("max_length"))


def oldest(df: DataFrame, by: str, time: str) -> DataFrame:
    """Cursor of the next page: the oldest time of each group. (SRT-04)"""
    return df.groupBy(by).agg(F.min(time).alias("oldest"))
