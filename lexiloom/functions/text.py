"""Scalar text functions, as Catalyst expressions that stay within code generation."""

from __future__ import annotations

import html
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Lookalike letters, leet digits and full-width forms, position by position.
LOOKALIKES = "аеосрухкмтніьοιερστ"
LOOKALIKES_LATIN = "aeocpyxkmthiboiepct"
LEET_DIGITS, LEET_LETTERS = "483910572", "abegiostz"
ALNUM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
WIDE = 0xFEE0
# Inflections that a stem may carry, longest first.
SUFFIXES = ["ings", "ing", "ers", "ies", "ist", "ed", "er", "es", "s", "y", "o"]
# Named character references that are decoded without Python, ampersand last.
REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&#039;": "'", "&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&amp;": "&"}


def wide(ascii_text: str) -> str:
    return "".join(chr(ord(c) + WIDE) for c in ascii_text)


def clean_text(s: Column) -> Column:
    """Drop NULs, collapse white space, trim; null gives an empty text. (TXT-01)"""
    return F.trim(F.regexp_replace(F.replace(F.coalesce(s, F.lit("")), F.lit("\0"), F.lit("")), r"(?U)[\s\x1c-\x1f]+", " "))


def dedup_key(s: Column) -> Column:
    """Lower-cased, trimmed text. (TXT-02)"""
    return F.lower(F.trim(s))


def word_count(cleaned: Column) -> Column:
    """Words of a cleaned text. (TXT-03)"""
    return F.when(cleaned == "", 0).otherwise(F.size(F.split(cleaned, " "))).cast("int")


def is_latin(s: Column, least: float = 0.5) -> Column:
    """Whether at least this share of the letters lies below U+0250; true without letters. (TXT-04)"""
    letters = F.length(F.regexp_replace(s, r"[^\p{L}]", ""))
    latin = F.length(F.regexp_replace(s, r"[^\p{L}]|[^\x{0}-\x{24F}]", ""))
    return F.when(letters == 0, True).otherwise(latin / letters >= least)


def _markup_to_text(decoded: Column) -> Column:
    s = F.regexp_replace(decoded, 'class="quote"|class="deadlink"|class="quoteLink"', "")
    s = F.replace(F.regexp_replace(s, "<[^>]+>", " "), F.lit(" "), F.lit(" "))
    s = F.regexp_replace(F.regexp_replace(s, r"[ \t]+", " "), r"\n\s*\n+", "\n")
    return F.trim(F.regexp_replace(s, r" *\n *", " "))


def html_to_text(s: Column) -> Column:
    """Post markup to plain text, with the common character references. (TXT-05)"""
    s = F.coalesce(s, F.lit(""))
    for name, char in REFERENCES.items():
        s = F.replace(s, F.lit(name), F.lit(char))
    return _markup_to_text(s)


def html_to_text_all(s: Column) -> Column:
    """As ``html_to_text``, with every character reference, decoded in Arrow batches. (TXT-05)"""

    def unescape(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.fillna("").map(html.unescape)

    return _markup_to_text(F.pandas_udf(unescape, "string")(s))


def canonicalize(s: Column) -> Column:
    """Undo lookalikes, full width, case, leet digits, separators and repeats. (TXT-06)"""
    s = F.translate(s, LOOKALIKES + wide(ALNUM), LOOKALIKES_LATIN + ALNUM)
    s = F.translate(F.lower(s), LEET_DIGITS, LEET_LETTERS)
    return F.regexp_replace(F.regexp_replace(s, "[^a-z0-9]+", ""), r"(.)\1+", "$1")


def stem_in(word: Column, targets: list[str]) -> Column:
    """The target that a word is, or is with one known suffix; null if none. (TXT-07)"""
    w = F.lower(word)
    known = lambda c: c.isin(*targets)
    found = F.when(known(w), w)
    for suffix in SUFFIXES:
        cut = F.left(w, F.length(w) - len(suffix))
        found = found.when((F.length(w) > len(suffix) + 2) & w.endswith(suffix) & known(cut), cut)
    return found


def fullwidth(s: Column) -> Column:
    """Printable ASCII to its full-width form. (TXT-10)"""
    printable = "".join(map(chr, range(0x21, 0x7F)))
    return F.translate(s, printable, wide(printable))


def sentences(s: Column) -> Column:
    """Array of sentences, split after a full stop, exclamation or question mark. (TXT-09)"""
    return F.split(F.replace(s, F.lit("\n"), F.lit(" ")), r"(?<=[.!?])(?U)\s+")


def digest(s: Column) -> Column:
    """Content digest by which streams and shards drop repeats. (TXT-11)"""
    return F.md5(s)


def crc_seed(source: Column, text: Column, seed: int, variant: Column) -> Column:
    """Seed of a variant from its row's content. (TXT-12)"""
    return F.lit(seed) + variant * 100_000 + F.crc32(F.concat(source, F.lit("|"), text).cast("binary")) % 97


def token_parts(token: Column) -> dict[str, Column]:
    """A token's leading marks, alphanumeric core and trailing marks; all empty if it has no such form. (TXT-08)"""
    form = "^([^A-Za-z0-9]*)([A-Za-z0-9]+)([^A-Za-z0-9]*)$"
    return {name: F.regexp_extract(token, form, i) for i, name in enumerate(("pre", "core", "post"), 1)}


def timestamp_seconds(raw: Column) -> Column:
    """Epoch seconds of numbers, digit strings and ISO 8601 times; 0 for null and anything else. (SRC-10)"""
    raw = raw.cast("string")
    return F.coalesce(raw.try_cast("double").cast("bigint"), F.unix_timestamp(F.try_to_timestamp(raw)), F.lit(0)).cast("bigint")
