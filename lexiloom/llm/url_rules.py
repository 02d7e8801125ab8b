"""URL filters by hashed host-suffix and path-prefix expressions.

Each URL is expanded into the expressions that a rule could have: every host
suffix at a label boundary with as many labels as some rule has, joined with
every path prefix as long as some rule's path. The expressions are joined to the
rules on the first four bytes of their SHA-256; the full digest then confirms. What
each distinct host and path gets is written before the rows are joined back to it,
so that the rows of a very common URL can be split over tasks.

Null, empty and scheme-less URLs have empty host and path and get the default
verdict. Repeated rows stay repeated. No column but the URL is read; all other
columns, whatever their names, pass through. An empty rule table blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters of a hex digest that make up the short prefix (four bytes).
PREFIX_HEX = 8


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to ``pages``.

    ``rules`` has host, path and verdict. A rule fits its host and all its
    subdomains if the URL's path starts with the rule's path. Of the rules that
    fit, the one with most characters wins, then the one with the longer host;
    of two equal rules, block wins. ``rule`` is its host and path, null if none.
    Columns of ``pages`` with those four names are replaced.
    """
    rules = rules.filter(F.col("host").isNotNull() & (F.col("host") != "")).select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict")
    shapes = rules.select(F.size(F.split("host", "\\.")).alias("labels"), F.length("path").alias("chars")).distinct().collect()
    labels, chars = sorted({r.labels for r in shapes}), sorted({r.chars for r in shapes})
    others = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    named = pages.select(F.struct(*pages.columns).alias("row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    shown = [F.col(f"row.`{c}`").alias(c) for c in others] + ["host", "path"]
    if not shapes:
        return named.select(*shown, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    keyed = rules.select(
        _digest(F.col("host"), F.col("path")).alias("r_digest"),
        F.struct(
            (F.length("host") + F.length("path")).alias("chars"), F.length("host").alias("host_chars"),
            F.col("verdict").alias("verdict"), F.concat("host", "path").alias("rule"),
        ).alias("hit"),
    ).groupBy("r_digest").agg(F.max("hit").alias("hit"))
    # Rules under one prefix are few: two different ones share it by chance of one in 2^32.
    prefixed = keyed.groupBy(F.substring("r_digest", 1, PREFIX_HEX).alias("r_prefix")).agg(F.collect_list(F.struct("r_digest", "hit")).alias("hits"))

    part = F.split("host", "\\.")
    suffixes = F.array(*(F.when(F.size(part) >= n, F.array_join(F.slice(part, -n, n) if n > 1 else F.array(F.element_at(part, -1)), ".")) for n in labels))
    prefixes = F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in chars))
    expressions = (
        named.select("host", "path").filter(F.col("host") != "").distinct()
        .withColumn("parts", F.filter(suffixes, lambda x: x.isNotNull()))
        .withColumn("suffix", F.explode("parts"))
        .withColumn("start", F.explode(F.filter(prefixes, lambda x: x.isNotNull())))
        .select("host", "path", _digest(F.col("suffix"), F.col("start")).alias("digest"))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    )
    best = (
        expressions.join(prefixed, F.col("prefix") == F.col("r_prefix"))
        .select("host", "path", F.explode(F.filter("hits", lambda h: h.r_digest == F.col("digest"))).alias("confirmed"))
        .groupBy("host", "path").agg(F.max("confirmed.hit").alias("hit"))
        .select(F.col("host").alias("_h"), F.col("path").alias("_p"), "hit")
    )
    best = stored(best, "url-verdicts")
    return (
        named.join(best, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
        .select(*shown, F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
    )
