"""Classifier metrics, sliced in one pass, and what surrounds them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Class names that reduce to 0 and to 1.
CLEAN_NAMES = ["ok", "clean", "normal", "benign", "non-offensive", "not offensive", "neutral"]
OFFENSIVE_NAMES = ["offensive", "toxic", "hate", "hateful", "abusive", "explicit"]
SLICES = ["benchmark_split", "mutated", "source"]


def _measures(label: str, predicted: str) -> list[Column]:
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    y, p = F.col(label) == 1, F.col(predicted) == 1
    tp, fp, fn = one(y & p), one(~y & p), one(y & ~p)
    rate = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return [
        F.count("*").alias("rows"), rate(one(F.col(label) == F.col(predicted)), F.count("*")).alias("accuracy"), rate(tp, tp + fp).alias("precision"),
        rate(tp, tp + fn).alias("recall"), rate(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def metrics(df: DataFrame, label: str = "label", predicted: str = "pred") -> DataFrame:
    """Rows, accuracy, precision, recall and F1; rates without a base are 0. (AGG-08)"""
    return df.agg(*_measures(label, predicted))


def sliced_metrics(df: DataFrame, slices: list[str] = SLICES, by: list[str] = [], label: str = "label", predicted: str = "pred") -> DataFrame:  # noqa: B006
    """Metrics overall and by each slicing column, per ``by`` (say, model): one pass over grouping sets. (AGG-09, EVL-01)"""
    every = df.select(*by, label, predicted, *(F.col(s).cast("string").alias(s) for s in slices))
    cells = every.groupBy(*by, label, predicted, *slices).agg(F.count("*").alias("_n"))
    shown = F.explode(F.array(F.struct(F.lit("overall").alias("slice"), F.lit("all").alias("value")), *(F.struct(F.lit(s).alias("slice"), F.col(s).alias("value")) for s in slices)))
    weighted = cells.select(*by, label, predicted, "_n", shown.alias("_s"))
    one = lambda c: F.sum(F.when(c, F.col("_n")).otherwise(0))
    y, p = F.col(label) == 1, F.col(predicted) == 1
    tp, fp, fn, hit = one(y & p), one(~y & p), one(y & ~p), one(F.col(label) == F.col(predicted))
    rate = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return weighted.groupBy(*by, F.col("_s.slice").alias("slice"), F.col("_s.value").alias("value")).agg(
        F.sum("_n").alias("rows"), rate(hit, F.sum("_n")).alias("accuracy"), rate(tp, tp + fp).alias("precision"), rate(tp, tp + fn).alias("recall"), rate(2 * tp, 2 * tp + fp + fn).alias("f1")
    )


def reduce_label(name: Column, n_labels: Column | int, override: dict[str, int] | None = None) -> Column:
    """A class name as 0 or 1: by override, else its number, else known names, else 1 of several classes; null if unknown. (TXT-13)"""
    n_labels = n_labels if isinstance(n_labels, Column) else F.lit(n_labels)
    low = F.lower(name)
    rule = F.coalesce(F.trim(name).try_cast("int"), F.when(low.isin(*CLEAN_NAMES), 0).when(low.isin(*OFFENSIVE_NAMES) | (n_labels > 2), 1))
    for known, value in (override or {}).items():
        rule = F.when(name == known, value).otherwise(rule)
    return rule


def best_checkpoint(log: DataFrame) -> DataFrame:
    """The checkpoint whose last F1 is highest, the first by name on a tie; ``log`` has checkpoint, step, f1. (AGG-10)"""
    last = log.filter("f1 IS NOT NULL").groupBy("checkpoint").agg(F.max_by("f1", "step").alias("f1"))
    return last.orderBy(F.desc("f1"), "checkpoint").limit(1)


def latest_checkpoint(names: DataFrame) -> DataFrame:
    """The ``checkpoint-N`` of the highest number. (TRN-02)"""
    n = F.regexp_extract("checkpoint", r"^checkpoint-(\d+)$", 1)
    return names.filter(n != "").agg(F.max_by("checkpoint", n.cast("long")).alias("checkpoint"))


def parse_metric_log(lines: DataFrame, f1_only: bool = False) -> DataFrame:
    """``task: name=number name=number`` lines as (task, metric, value); with ``f1_only``, F1 times 100. (TXT-14)"""
    row = lines.select(F.regexp_extract("value", r"^\s*([a-zA-Z0-9_]+):\s*(.*)$", 1).alias("task"), F.regexp_extract("value", r"^\s*([a-zA-Z0-9_]+):\s*(.*)$", 2).alias("rest")).filter("task <> ''")
    pairs = row.select("task", F.explode(F.regexp_extract_all("rest", F.lit(r"[a-zA-Z0-9_]+=[0-9.]+"), 0)).alias("pair"))
    out = pairs.select("task", F.split_part("pair", F.lit("="), F.lit(1)).alias("metric"), F.split_part("pair", F.lit("="), F.lit(2)).try_cast("double").alias("value"))
    return out.filter("metric = 'f1'").withColumn("value", F.col("value") * 100) if f1_only else out
