"""Labelled corpora of known shapes, and any table by a column map, as unified or candidate rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import clean_text, html_to_text_all, sentences, timestamp_seconds, word_count
from lexiloom.schemas import UNIFIED, conform

# Flag columns, class names and label maps of the known corpora.
FLAGS = ["toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate"]
CLASSES = {0: "hate", 1: "offensive", 2: "neither"}
TOKEN_LABELS = {"0": 0, "normal": 0, "1": 1, "hate": 1, "2": 1, "offensive": 1}
REMOVED = {"comments": ["[removed]", "[deleted]", ""], "posts": [""], "videos": ["[removed]", "[deleted]", ""]}


def _unified(df: DataFrame, text: Column, label: Column, origin: Column, split: Column, source: str) -> DataFrame:
    rows = df.select(clean_text(text).alias("text"), label.cast("tinyint").alias("label"), F.lit(source).alias("source"), origin.alias("origin_label"), split.alias("split_origin"))
    return conform(rows.filter("text <> '' AND label IS NOT NULL"), UNIFIED)


def from_flags(df: DataFrame, source: str, text: str = "comment_text", split: str = "train") -> DataFrame:
    """Label 1 if any of six flags is 1; the flags' names joined by plus signs, or clean. (SRC-03)"""
    on = F.array_join(F.filter(F.array(*(F.when(F.col(f) == 1, F.lit(f)) for f in FLAGS)), lambda x: x.isNotNull()), "+")
    any_on = F.greatest(*(F.coalesce((F.col(f) == 1).cast("int"), F.lit(0)) for f in FLAGS))
    return _unified(df, F.col(text), any_on, F.when(on == "", "clean").otherwise(on), F.lit("test" if split == "balanced_test" else split), source)


def from_class(df: DataFrame, source: str, text: str = "text", label: str = "label", split: str = "train") -> DataFrame:
    """Classes 0 and 1 to label 1, others to 0. (SRC-04)"""
    names = F.create_map(*(F.lit(x) for kv in CLASSES.items() for x in kv))
    return _unified(df, F.col(text), F.col(label).isin(0, 1).cast("int"), F.coalesce(names[F.col(label).cast("int")], F.col(label).cast("string")), F.lit(split), source)


def from_score(df: DataFrame, source: str, text: str = "text", score: str = "toxicity_human", least: float = 3.5, split: str = "train") -> DataFrame:
    """Label 1 from a score up; what is no number scores 0. (SRC-05)"""
    value = F.coalesce(F.col(score).try_cast("double"), F.lit(0.0))
    return _unified(df, F.col(text), (value >= least).cast("int"), F.format_string("%.1f", value), F.lit(split), source)


def from_prompt(df: DataFrame, source: str, text: str = "generation", label: str = "prompt_label", split: str = "train") -> DataFrame:
    """A whole-number label as it is; rows where it is none are dropped. (SRC-06)"""
    value = F.col(label).try_cast("int")
    return _unified(df, F.col(text), value, value.cast("string"), F.lit(split), source)


def from_tokens(df: DataFrame, source: str, text: str = "text", label: str = "label") -> DataFrame:
    """Text that may be a JSON array of tokens; known labels only; held out as test. (SRC-07)"""
    joined = F.coalesce(F.array_join(F.from_json(F.col(text), "array<string>"), " "), F.col(text))
    name = F.lower(F.col(label).cast("string"))
    value = F.create_map(*(F.lit(x) for kv in TOKEN_LABELS.items() for x in kv))[name]
    return _unified(df, joined, value, name, F.lit("test"), source)


def from_articles(df: DataFrame, source: str, keys: list[str], n: int = 350_000, least: int = 4, most: int = 60, text: str = "text") -> DataFrame:
    """Sentences of articles within bounds of words, the first n in the order of keys and place. (SRC-08, TXT-09)"""
    rows = df.select(*keys, F.posexplode(sentences(F.col(text))).alias("place", "said")).withColumn("said", clean_text(F.col("said")))
    first = rows.filter(word_count(F.col("said")).between(least, most)).orderBy(*keys, "place").limit(n)
    return _unified(first, F.col("said"), F.lit(0), F.lit("clean"), F.lit("train"), source)


@dataclass(frozen=True)
class ColumnMap:
    """Where a table has a candidate's columns; None, or a column that it lacks, takes the default."""

    text: str = "text"
    source: str | None = None
    time: str | None = None
    score: str | None = None
    id: str | None = None
    name: str = "dataset"


def adapt(df: DataFrame, names: ColumnMap) -> DataFrame:
    """Candidate columns from any table; a missing text column is an error. (SRC-09, SRC-10)"""
    if names.text not in df.columns:
        raise ValueError(f"no text column {names.text!r} among {df.columns}")
    at = lambda c, default: F.col(f"`{c}`") if c and c in df.columns else F.lit(default)
    return df.select(
        clean_text(at(names.text, "").cast("string")).alias("text"), F.lit(names.name).alias("source"), F.coalesce(at(names.source, "").cast("string"), F.lit("")).alias("subreddit"),
        timestamp_seconds(at(names.time, None)).alias("created_utc"), F.coalesce(at(names.score, 0).try_cast("bigint"), F.lit(0)).alias("score"), F.coalesce(at(names.id, "").cast("string"), F.lit("")).alias("id"),
    ).filter("text <> ''")


def _candidate(df: DataFrame, text: Column, source: str, channel: Column, time: Column, score: Column, key: Column, removed: list[str]) -> DataFrame:
    rows = df.select(
        text.alias("text"), F.lit(source).alias("source"), F.coalesce(channel.cast("string"), F.lit("")).alias("subreddit"), time.alias("created_utc"),
        F.coalesce(score.try_cast("bigint"), F.lit(0)).alias("score"), F.coalesce(key.cast("string"), F.lit("")).alias("id"),
    )
    return rows.filter(~F.col("text").isin(*removed, ""))


def from_comments(df: DataFrame, source: str = "comments") -> DataFrame:
    """Comment records (body, subreddit, created_utc, score, id) without removed ones. (SRC-15, FLT-05)"""
    return _candidate(df, clean_text(F.col("body")), source, F.col("subreddit"), timestamp_seconds(F.col("created_utc")), F.col("score"), F.col("id"), REMOVED["comments"])


def from_posts(df: DataFrame, source: str = "posts") -> DataFrame:
    """Board posts whose markup is in ``com`` or ``comment``. (SRC-16, SRC-17, TXT-05)"""
    have = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    return _candidate(df, clean_text(html_to_text_all(F.coalesce(have("com"), have("comment")))), source, have("board"), timestamp_seconds(have("time")), F.lit("0"), have("no"), REMOVED["posts"])


def comment_records(df: DataFrame, source: str = "comments") -> DataFrame:
    """Comments from a paged API's records (channel, JSON value). (SRC-12)"""
    j = F.from_json("value", "body string, subreddit string, created_utc string, score string, id string")
    return from_comments(df.select(j.alias("j")).select("j.*"), source)


def post_records(df: DataFrame, source: str = "posts") -> DataFrame:
    """Board posts from a paged API's records. (SRC-16, SRC-17)"""
    j = F.from_json("value", "com string, comment string, time string, no string")
    return from_posts(df.select(F.col("channel").alias("board"), j.alias("j")).select("board", "j.*"), source)


VIDEO_COMMENT = "snippet struct<topLevelComment: struct<id: string, snippet: struct<textDisplay: string, publishedAt: string, likeCount: bigint>>>"


def from_video_comments(df: DataFrame, source: str = "videos", value: str = "value") -> DataFrame:
    """Comment threads as JSON text: likes are the score, the time of publishing becomes seconds. (SRC-18)"""
    top = df.select("*", F.from_json(F.col(value), VIDEO_COMMENT).alias("_j")).select("*", F.col("_j.snippet.topLevelComment").alias("_c"))
    channel = F.col("channel") if "channel" in df.columns else F.lit("")
    return _candidate(top, clean_text(html_to_text_all(F.col("_c.snippet.textDisplay"))), source, channel, timestamp_seconds(F.col("_c.snippet.publishedAt")), F.col("_c.snippet.likeCount").cast("string"), F.col("_c.id"), REMOVED["videos"])


def usable(df: DataFrame, least_words: int = 4, latin: bool = True) -> DataFrame:
    """Candidates of enough words, mostly in Latin script if asked. (FLT-03, FLT-04)"""
    from lexiloom.functions.text import is_latin

    kept = df.filter(word_count(F.col("text")) >= least_words)
    return kept.filter(is_latin(F.col("text"))) if latin else kept
