"""The engine's views over the driver's tables, as DataFrames and as DuckDB SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import text
from lexiloom.functions.lexicon import Lexicon
from lexiloom.session import read_table

# A neutral word list of frequent tokens of the driver's English documents.
LEXICON = Lexicon(
    expletives=("ononst", "inoran", "thst"), insults=("hehely", "orantion", "eresh"), pronouns=("this", "that"),
    attacks=(r"\bthe and attion\b",), censored=(r"\bt[^\w\s]{1,4}(?:st|re)\b",),
)
TARGETS = ["the", "that", "this", "ononst", "with", "from", "hand", "nd"]


def unified(spark: SparkSession, sf_dir: str, cleaned: bool = True) -> DataFrame:
    """Documents with labels: text, label, source, origin_label, split_origin, ord."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    said = text.clean_text(F.col("text")) if cleaned else F.col("text")
    return docs.select("doc_id", "text", "source").join(labels, "doc_id").select(
        said.alias("text"), F.col("toxic").cast("int").alias("label"), "source", F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("origin_label"),
        F.when(F.col("doc_id") % 10 == 0, "test").otherwise("train").alias("split_origin"), F.col("doc_id").alias("ord"),
    )


def documents(spark: SparkSession, sf_dir: str, *columns: Column | str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*columns)


def sql_clean(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '[\\s]+', ' ', 'g'))"


def sql_words(c: str) -> str:
    return f"(CASE WHEN {c} = '' THEN 0 ELSE len(string_split({c}, ' ')) END)"


def sql_hash(purpose: str, *keys: str, seed: int = 42) -> str:
    return f"md5(concat_ws('|', '{seed}', '{purpose}', {', '.join(keys)}))"


def sql_number(h: str, at: int = 1) -> str:
    return f"('0x' || substr({h}, {at}, 13))::BIGINT"


def sql_unit(h: str, at: int = 1) -> str:
    return f"({sql_number(h, at)} / 4503599627370496.0)"


def sql_letters(c: str) -> str:
    """Letters of the canonical form, repeats still there; a column of its own, so that it is found once a row."""
    wide = text.wide(text.ALNUM)
    return f"string_split(regexp_replace(translate(lower(translate({c}, '{text.LOOKALIKES}{wide}', '{text.LOOKALIKES_LATIN}{text.ALNUM}')), '{text.LEET_DIGITS}', '{text.LEET_LETTERS}'), '[^a-z0-9]+', '', 'g'), '')"


def sql_cluster(ctes: str) -> str:
    """Common table expressions up to ``clustered``: the chain normalise, canonicalise, cluster."""
    return f"""WITH u AS ({SQL_UNIFIED}),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(text)) ORDER BY source, ord) AS rn FROM u) WHERE rn = 1),
normal AS (SELECT * EXCLUDE rn FROM first WHERE {sql_words("text")} BETWEEN 3 AND 512),
letters AS (SELECT *, {sql_letters("text")} AS l FROM normal),
clustered AS (SELECT * EXCLUDE l, md5(array_to_string(list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1]), '')) AS cluster FROM letters){ctes}"""


SQL_UNIFIED = f"""SELECT {sql_clean("d.text")} AS text, l.toxic::INT AS label, d.source, CASE WHEN l.toxic = 1 THEN 'toxic' ELSE 'clean' END AS origin_label,
  CASE WHEN d.doc_id % 10 = 0 THEN 'test' ELSE 'train' END AS split_origin, d.doc_id AS ord FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""
