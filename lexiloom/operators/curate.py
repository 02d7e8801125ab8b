"""Banks, grey zone, model labels, review and merging."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.chance import SEED
from lexiloom.operators.dedup import added, union_all, union_first
from lexiloom.operators.sampling import sample_fraction, sample_n
from lexiloom.schemas import UNIFIED, fields


@dataclass(frozen=True)
class Grey:
    high: float = 0.70
    low: float = 0.30
    verify_share: float = 0.02
    attack_floor: float = 0.40  #: bank A rows below this go to review
    clean_ceiling: float = 0.90  #: bank C rows above this go to review


def banks(df: DataFrame) -> DataFrame:
    """Bank and label by category: attack A/1, emotional B/0, clean C/0, grey undecided. (CUR-01, CUR-02)"""
    c = F.col("category")
    return df.withColumns({
        "bank": F.when(c == "attack", "A").when(c == "emotional", "B").when(c == "clean", "C").otherwise("grey"),
        "label": F.when(c == "attack", 1).when(c.isin("emotional", "clean"), 0).cast("tinyint"), "origin_label": c,
    })


def grey_label(p: Column, grey: Grey = Grey()) -> Column:
    """1 at ``high`` and over, 0 at ``low`` and under, -1 between, in the precision of scores. (MDL-02)"""
    at = p.cast("float")
    return F.when(at >= F.lit(grey.high).cast("float"), 1).when(at <= F.lit(grey.low).cast("float"), 0).otherwise(-1).cast("tinyint")


def model_labels(df: DataFrame, p: str, grey: Grey = Grey()) -> DataFrame:
    """Label rows by score, with the score in ``origin_label``. (MDL-02)"""
    return df.withColumns({"label": grey_label(F.col(p), grey), "origin_label": F.format_string("model_%.3f", F.col(p).cast("double")), "split_origin": F.lit("train")})


def assign_grey(df: DataFrame, p: str = "p", grey: Grey = Grey()) -> DataFrame:
    """Move grey rows to A or C by score, the unsure to manual review with label -1. (CUR-03)"""
    is_grey, label = F.col("bank") == "grey", grey_label(F.col(p), grey)
    return df.withColumns({
        "bank": F.when(~is_grey, F.col("bank")).when(label == 1, "A").when(label == 0, "C").otherwise("manual"),
        "label": F.when(is_grey, label).otherwise(F.col("label")).cast("tinyint"),
        "origin_label": F.when(~is_grey, F.col("origin_label")).when(label == 1, "grey->attack").when(label == 0, "grey->clean").otherwise("grey"),
        "conf": F.when(is_grey, F.col(p)).cast("float"),
    })


def verify(df: DataFrame, keys: list[str], p: str = "p", grey: Grey = Grey(), seed: int = SEED, score: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Score a sample of banks A and C and send disagreements to manual review. (CUR-04, WIN-12)

    With ``score``, which adds ``p``, only the sample is scored. Rows that share their keys are moved together.
    """
    pulled = []
    for bank, wrong in (("A", F.col(p) < grey.attack_floor), ("C", F.col(p) > grey.clean_ceiling)):
        drawn = sample_fraction(df.filter(F.col("bank") == bank), keys, grey.verify_share, 1, seed, f"verify-{bank}")
        pulled.append((score(drawn) if score else drawn).filter(wrong).select(*keys))
    moved = union_all(*pulled).distinct().withColumn("_moved", F.lit(True))
    out = df.join(moved, keys, "left")
    is_moved = F.col("_moved").isNotNull()
    return out.withColumns({
        "bank": F.when(is_moved, "manual").otherwise(F.col("bank")), "label": F.when(is_moved, -1).otherwise(F.col("label")).cast("tinyint"),
        "origin_label": F.when(is_moved, "verify-disagree").otherwise(F.col("origin_label")),
    }).drop("_moved")


def combine_banks(df: DataFrame, keys: list[str], targets: dict[str, int], seed: int = SEED) -> DataFrame:
    """A uniform sample of each bank, one table, without undecided rows. (CUR-05, WIN-10)"""
    parts = [sample_n(df.filter(F.col("bank") == b), keys, n, seed, f"bank-{b}") for b, n in targets.items()]
    return union_all(*parts).filter("label IN (0, 1)")


def merge_banks(*frames: DataFrame, order: list[str]) -> DataFrame:
    """Labelled rows of all banks in unified columns, the first of each text. (MRG-01, FLT-06)"""
    names = [n for n, _ in fields(UNIFIED)]
    return union_first(*(f.filter("label IN (0, 1)") for f in frames), order=order).select(*names)


def merge_labelled(existing: DataFrame, candidates: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Existing rows and new labelled candidates, existing first; and the rows that were added. (MRG-02)"""
    new = candidates.filter("label IN (0, 1)")
    return union_first(existing, new, order=order), added(existing, new, order)


def apply_fixes(df: DataFrame, fixes: DataFrame) -> DataFrame:
    """Give undecided rows the label of a fix for their text; those without one stay undecided. (JN-05, MRG-03)"""
    known = fixes.filter("label IN (0, 1)").groupBy("text").agg(F.max("label").cast("tinyint").alias("_fix"))
    return df.join(known, "text", "left").withColumn("label", F.when(F.col("label") == -1, F.coalesce("_fix", "label")).otherwise(F.col("label")).cast("tinyint")).drop("_fix")


def fallback_labels(df: DataFrame, undecided: Column | None = None) -> DataFrame:
    """Label undecided rows, those with label -1 if not told, by category: attack 1, emotional and clean 0, grey dropped. (JN-09, MRG-03)"""
    c, undecided = F.col("category"), F.col("label") == -1 if undecided is None else undecided
    fixed = F.when(c == "attack", 1).when(c.isin("emotional", "clean"), 0)
    return df.withColumn("label", F.when(undecided, fixed).otherwise(F.col("label")).cast("tinyint")).filter("label IS NOT NULL")

