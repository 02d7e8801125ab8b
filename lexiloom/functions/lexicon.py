"""Obfuscation-tolerant lexicon classifier. Word lists are data: files or lists that the user brings.

A strict form allows marks, digits and spaces between all letters of a word; a loose
form also lets vowels go, and counts only where it is long or shows such marks. The
loose form is written so that every run of marks has one way to match, which keeps
matching linear in the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.chance import hashed, unit
from lexiloom.functions.text import clean_text

JUNK = r"[\W_0-9]*"
VOWELS = "aeiouy"
TOKEN = r"[^\W_0-9]+"
CATEGORY = "profanity boolean, insult boolean, attack boolean, category string"


@dataclass(frozen=True)
class Lexicon:
    """Expletives, insults (of persons too), second-person pronouns, attack patterns and patterns of censored words."""

    expletives: tuple[str, ...] = ()
    insults: tuple[str, ...] = ()
    pronouns: tuple[str, ...] = ()
    attacks: tuple[str, ...] = ()
    censored: tuple[str, ...] = ()
    window: int = 6  #: tokens between a hit and a pronoun
    trusted: int = 5  #: characters from which a loose match needs no marks
    _compiled: dict = field(default_factory=dict, compare=False, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_compiled": {}}


def read_words(spark: SparkSession, path: str, least: int = 3) -> list[str]:
    """Words of a list: trimmed, lower-cased, comments and short lines left out. The list is small and goes to the driver. (SRC-21)"""
    line = F.lower(F.trim(F.col("value")))
    rows = spark.read.text(path).select(line.alias("w")).filter((F.length("w") >= least) & ~F.col("w").startswith("#")).distinct()
    return sorted(r.w for r in rows.collect())


def strict_form(word: str) -> str:
    """All letters, with marks between. (CLS-01)"""
    return r"\b" + JUNK.join(map(re.escape, word.lower())) + r"\b"


def loose_form(word: str) -> str:
    """Vowels may go. After the first letter an optional vowel takes the marks after it along, so no two runs of marks meet. (CLS-02)"""
    first, *rest = word.lower()
    out = r"\b" + re.escape(first) + "?" * (first in VOWELS) + JUNK * bool(rest)
    for i, c in enumerate(rest, 1):
        last = i == len(rest)
        if c in VOWELS:
            out += f"{re.escape(c)}?" if last else f"(?:{re.escape(c)}{JUNK})?"
        else:
            out += re.escape(c) + ("" if last else JUNK)
    return out + r"\b"


def _patterns(lexicon: Lexicon) -> dict:
    made = lexicon._compiled
    if not made:
        union = lambda forms: re.compile("|".join(forms), re.IGNORECASE) if forms else None
        made |= {
            "expletives": (union([*map(strict_form, lexicon.expletives)]), union([*map(loose_form, lexicon.expletives)])),
            "insults": (union([*map(strict_form, lexicon.insults)]), union([*map(loose_form, lexicon.insults)])),
            "attacks": union(list(lexicon.attacks)), "censored": union(list(lexicon.censored)), "token": re.compile(TOKEN), "junk": re.compile(r"[\W_0-9]"),
            "pronoun": re.compile(rf"\b(?:{'|'.join(map(re.escape, lexicon.pronouns))})\b", re.IGNORECASE) if lexicon.pronouns else None,
        }
    return made


def _starts(strict, loose, text: str, trusted: int, junk) -> list[int]:
    """Where trusted matches begin. (CLS-06)"""
    if strict is None:
        return []
    spans = {m.span() for m in strict.finditer(text)}
    found = [a for a, _ in spans]
    for m in loose.finditer(text):
        if m.span() not in spans and (len(m[0]) >= trusted or junk.search(m[0])):
            found.append(m.start())
    return found


def classify(text: str | None, lexicon: Lexicon) -> tuple[bool, bool, bool, str]:
    """Profanity, insult, attack and category of one text. (CLS-10)

    An attack pattern comes first, then a hit near a pronoun, then profanity
    (emotional), then insult (grey). A censored word is profanity unless the text
    also has an insult.
    """
    if not text:
        return False, False, False, "clean"
    p = _patterns(lexicon)
    expletive = _starts(*p["expletives"], text, lexicon.trusted, p["junk"])
    insult = _starts(*p["insults"], text, lexicon.trusted, p["junk"])
    censored = [m.start() for m in p["censored"].finditer(text)] if p["censored"] else []
    has_insult = bool(insult)
    profane = bool(expletive) or (bool(censored) and not has_insult)
    if p["attacks"] and p["attacks"].search(text):
        return profane, has_insult, True, "attack"
    hits = expletive + insult + censored
    if hits and p["pronoun"]:
        tokens = [(m.end(), m[0]) for m in p["token"].finditer(text)]
        people = [i for i, (_, w) in enumerate(tokens) if p["pronoun"].match(w)]
        ends = [end for end, _ in tokens]
        for start in hits if people else ():
            # The token that holds or follows the hit's start, and the first person not before its window. (CLS-07)
            at = bisect_right(ends, start)
            near = bisect_left(people, at - lexicon.window)
            if at < len(ends) and near < len(people) and people[near] <= at + lexicon.window:
                return profane, has_insult, True, "attack"
    return profane, has_insult, False, "emotional" if profane else "grey" if has_insult else "clean"


# Python's classes in Java's terms. Java's own, with (?U), count combining marks and joiners among word characters.
_WORD, _SPACE = r"\p{L}\p{N}_", r"\s\x1c-\x1f"
_EDGE = rf"(?:(?<=[{_WORD}])(?![{_WORD}])|(?<![{_WORD}])(?=[{_WORD}]))"
_NO_EDGE = rf"(?:(?<=[{_WORD}])(?=[{_WORD}])|(?<![{_WORD}])(?![{_WORD}]))"
_OUTSIDE = {"w": f"[{_WORD}]", "W": f"[^{_WORD}]", "s": f"[{_SPACE}]", "S": f"[^{_SPACE}]", "d": r"\p{Nd}", "D": r"\P{Nd}", "b": _EDGE, "B": _NO_EDGE}
_INSIDE = {"w": _WORD, "W": f"[^{_WORD}]", "s": _SPACE, "S": f"[^{_SPACE}]", "d": r"\p{Nd}", "D": r"\P{Nd}"}


def java_pattern(pattern: str) -> str:
    """A Python pattern with its classes and word boundaries spelled out as Java means them; all else is common to both."""
    out, i, inside = [], 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            said = (_INSIDE if inside else _OUTSIDE).get(pattern[i + 1], pattern[i : i + 2])
            if said == _EDGE and pattern[i + 2 : i + 3].isalnum() and pattern[i + 3 : i + 4] not in tuple("?*{"):
                said = f"(?<![{_WORD}])"  # a word character follows
            elif said == _EDGE and pattern[i - 1 : i].isalnum() and pattern[i - 2 : i - 1] != "\\":
                said = f"(?![{_WORD}])"  # one came before
            out.append(said)
            i += 2
            continue
        if inside and c in "[&":  # plain characters in Python's classes
            c = "\\" + c
        elif c == "[":
            inside = True
            negated = pattern[i + 1 : i + 2] == "^"
            c += "^" * negated
            i += negated
            if pattern[i + 1 : i + 2] == "]":
                c += r"\]"
                i += 1
        elif c == "]":
            inside = False
        out.append(c)
        i += 1
    return "".join(out)


def skeleton(word: str) -> str:
    """A word's letters without vowels."""
    return "".join(c for c in word.lower() if c not in VOWELS)


def gate(lexicon: Lexicon, text: Column) -> Column | None:
    """Whether a text can have a hit or an attack, without Python; None without words and patterns.

    Whatever matches a word's loose form, which the strict one implies, holds its
    consonants in a row once all but letters, and then vowels, are taken out. The
    user's own patterns are looked for as they are.
    """
    words = sorted({skeleton(w) for w in (*lexicon.expletives, *lexicon.insults)})
    patterns = [java_pattern(f) for f in (*lexicon.attacks, *lexicon.censored)]
    found = []
    if words:
        # The letters that Python takes for an i or an s whatever the case: dotted and dotless i, long s.
        plain = F.regexp_replace(F.translate(F.lower(text), "ſı", "s"), r"[^\p{L}]|[aeiouy]", "")
        found.append(F.exists(F.array(plain), lambda t: reduce(or_, (t.contains(w) for w in words))))
    if patterns:
        found.append(text.rlike("(?iu)" + "|".join(patterns)))
    return reduce(or_, found) if found else None


def classify_column(text: Column, lexicon: Lexicon) -> Column:
    """Struct of ``CATEGORY`` for each text, by an Arrow UDF. (CLS-10)"""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([classify(t, lexicon) for t in b], columns=["profanity", "insult", "attack", "category"])

    return F.pandas_udf(run, CATEGORY)(text)


def with_category(df: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """Add profanity, insult, attack (0/1) and category. Only texts that pass the native gate go through Python."""
    passes = gate(lexicon, F.coalesce(F.col(text), F.lit("")))
    flags = ("profanity", "insult", "attack")
    if passes is None:
        return df.withColumns({f: F.lit(0).cast("tinyint") for f in flags} | {"category": F.lit("clean")})
    shown = F.when(passes, F.col(text))
    held = "_class"
    while held in df.columns:
        held += "_"
    found = df.withColumn(held, classify_column(shown, lexicon))
    return found.withColumns({f: F.col(f"{held}.{f}").cast("tinyint") for f in flags} | {"category": F.col(f"{held}.category")}).drop(held)


def with_token_category(df: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """Category by whole tokens alone, without Python: for lexicons whose words are not disguised. (CLS-08, CLS-09)"""
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"(?U)[\W_0-9]+"), lambda t: t != "")
    placed = lambda words: F.filter(F.transform("_tokens", lambda t, i: F.when(t.isin(*words), i)), lambda i: i.isNotNull()) if words else F.array().cast("array<int>")
    # Each explode of one element makes its value a column, so that it is found once per row however often it is used.
    out = df.withColumn("_tokens", F.explode(F.array(tokens)))
    out = out.withColumn("_m", F.explode(F.array(F.struct(placed(lexicon.expletives).alias("e"), placed(lexicon.insults).alias("i"), placed(lexicon.pronouns).alias("p")))))
    near = F.exists(F.concat("_m.e", "_m.i"), lambda h: F.exists("_m.p", lambda p: F.abs(h - p) <= lexicon.window))
    flags = F.struct((F.size("_m.e") > 0).alias("profanity"), (F.size("_m.i") > 0).alias("insult"), near.alias("attack"))
    out = out.withColumn("_f", F.explode(F.array(flags)))
    category = F.when(F.col("_f.attack"), "attack").when(F.col("_f.profanity"), "emotional").when(F.col("_f.insult"), "grey").otherwise("clean")
    return out.withColumns({f: F.col(f"_f.{f}").cast("tinyint") for f in ("profanity", "insult", "attack")} | {"category": category}).drop("_tokens", "_m", "_f")


def holding_words(df: DataFrame, words: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Keys of the rows of which a token, as it is between spaces and in lower case, is among ``words`` (its first column), a list of any size. (JN-08)"""
    tokens = df.select(*keys, F.explode(F.array_distinct(F.split(F.lower(clean_text(F.col(text))), " "))).alias("_token"))
    return tokens.join(words.select(F.col(words.columns[0]).alias("_word")), F.col("_token") == F.col("_word"), "left_semi").select(*keys).distinct()


def prefilter(df: DataFrame, keys: list[str], clean_share: float) -> DataFrame:
    """All rows that are not clean, and by hash this share of those that are. (CLS-11)"""
    return df.filter((F.col("category") != "clean") | (unit(hashed("prefilter", *(F.col(k) for k in keys))) < clean_share))


def label_by_words(text: Column, words: list[str], pronouns: list[str]) -> Column:
    """1 if the text has one of the words anywhere and one of the pronouns as a word, else 0. (CLS-12)"""
    has = F.lower(text).rlike("|".join(map(re.escape, words))) & F.lower(text).rlike(rf"\b(?:{'|'.join(map(re.escape, pronouns))})\b")
    return F.when(has, 1).otherwise(0)
