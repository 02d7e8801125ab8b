"""Variants of rows: originals and hash-chosen orthographic mutations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.chance import SEED, hashed
from lexiloom.functions.mutation import hits_of, let, long_words, mutate_random_word, mutate_text, sentence_style
from lexiloom.functions.text import clean_text
from lexiloom.operators.dedup import keep_first
from lexiloom.operators.sampling import sample_fraction

def fan_out_offensive(df: DataFrame, targets: list[str], variants: int = 3, seed: int = SEED) -> DataFrame:
    """Each row and ``variants`` mutations of it: up to two target words, else one random word, else, for each third variant, the whole style. (MUT-13)

    ``base_text`` keeps the text a row was made from, for clusters that do not leak.
    """
    text, v, hits, places = F.col("base_text"), F.col("variant"), F.col("_hits"), F.col("_places")
    found = df.withColumnRenamed("text", "base_text").withColumns({"_hits": hits_of(text, targets, 2), "_places": long_words(text)})
    # The explode keeps the hits as columns: they are found once per text, not once per token of each variant.
    rows = found.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(variants)))).withColumn("_h", hashed("offensive", F.col("source"), text, v, seed=seed))
    # A random word may come out as it was, and there may be none to change: each third variant then takes the whole style.
    whole = let(mutate_random_word(text, places, F.col("_h")), lambda t: F.when((t == text) & (v % 3 == 0), sentence_style(text, F.col("_h"))).otherwise(t))
    said = F.when(v == 0, text).otherwise(clean_text(F.when(F.size(hits) > 0, mutate_text(text, hits, F.col("_h"))).otherwise(whole)))
    return rows.withColumn("text", said).withColumns({"mutated": (v > 0).cast("tinyint"), "variant": v.cast("tinyint")}).drop("_hits", "_places", "_h")


def fan_out_clean(df: DataFrame, keys: list[str], targets: list[str], share: float = 0.4, seed: int = SEED) -> DataFrame:
    """Each row, and for an exact share of them one mutation of a target, such as an everyday word, where they have one. (MUT-14)"""
    base = df.withColumnRenamed("text", "base_text")
    chosen = sample_fraction(base, keys, share, 0, seed, "clean-variants")
    h = hashed("clean", F.col("source"), F.col("base_text"), seed=seed)
    found = chosen.withColumn("_hits", F.explode(F.array(hits_of(F.col("base_text"), targets, 1)))).filter(F.size("_hits") > 0)
    made = found.withColumn("text", clean_text(mutate_text(F.col("base_text"), F.col("_hits"), h))).drop("_hits")
    tag = lambda f, on: f.withColumns({"variant": F.lit(on).cast("tinyint"), "mutated": F.lit(on).cast("tinyint")})
    return tag(base.withColumn("text", F.col("base_text")), 0).unionByName(tag(made, 1))


def mutate(df: DataFrame, order: list[str], targets: list[str], clean_targets: list[str], variants: int = 3, clean_share: float = 0.4, seed: int = SEED) -> DataFrame:
    """Offensive rows with variants, then clean rows with theirs, the first of each text. (MUT-13, MUT-14, WIN-02)"""
    hot = fan_out_offensive(df.filter("label = 1"), targets, variants, seed).withColumn("_class", F.lit(0))
    cold = fan_out_clean(df.filter("label = 0"), order, clean_targets, clean_share, seed).withColumn("_class", F.lit(1))
    return keep_first(hot.unionByName(cold), F.col("text"), ["_class", *order, "variant"]).drop("_class")
