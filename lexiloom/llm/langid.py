"""Language identification by a bit-sliced Bloom filter of character n-grams.

Texts are lower-cased, runs of non-letters become one space, and every window of
four characters is hashed. The filter is an array of language bit masks: each of a
language's n-grams sets that language's bit at ``HASHES`` positions, so the AND of
the masks at an n-gram's positions gives all languages that hold it. A text's
language is the one whose share of hits, corrected for the filter's rate of false
positives in that language's slice, is highest; ties go to the first language in
alphabetical order.

The model is fitted on a hash sample of about ``sample_docs`` labelled documents of
each language. An n-gram belongs to a language if it is at least ``least_share`` as
frequent there as in the language that uses it most; each language keeps at most
``most_grams`` n-grams, which bounds the filter. Everything else reads all rows and
whole texts. A worker holds the code points of one batch of texts (1 MB of them, or one
longer text) about six times over, and hashes of a window. Texts that are null, empty or hold no letter are ``und`` with score 0;
a text with letters but no known n-gram gets the most frequent language with score
0; without any labelled document every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import small_batches, stored, temporary, with_fields

GRAM, HASHES, UNKNOWN = 4, 3, "und"
#: Characters that are hashed at once, to bound a worker's memory.
WINDOW = 1 << 16
# Odd multipliers of the n-gram hash.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
FINAL = 0xFF51AFD7ED558CCD


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 600
    most_grams: int = 200_000
    least_share: float = 0.2
    least_count: int = 2


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def spelled(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts one after another, non-letters collapsed to spaces, and the text each belongs to.

    A text starts with two spaces and ends with one, so one letter makes an n-gram.
    """
    padded = [f"  {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), np.uint32)
    owner = np.repeat(np.arange(len(padded), dtype=np.int32), [len(p) for p in padded])
    word = letters()[codes]
    kept = word.copy()
    kept[1:] |= word[:-1]
    starts = np.cumsum([0, *(len(p) for p in padded)])[:-1]
    kept[starts] = True
    kept[starts + 1] = True
    return np.where(word, codes, 32)[kept], owner[kept]


def grams(codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the n-grams that lie within one text and hold a letter, and their texts; in slices."""
    for at in range(0, max(len(codes) - GRAM + 1, 0), WINDOW):
        part, of = codes[at : at + WINDOW + GRAM - 1].astype(np.uint64), owner[at : at + WINDOW + GRAM - 1]
        n = len(part) - GRAM + 1
        x = np.zeros(n, np.uint64)
        for k, m in enumerate(MULTIPLIERS):
            x += part[k : k + n] * np.uint64(m)
        x ^= x >> np.uint64(32)
        x *= np.uint64(FINAL)
        x ^= x >> np.uint64(29)
        inside = (of[:n] == of[GRAM - 1 :]) & ((part[2 : n + 2] != 32) | (part[1 : n + 1] != 32))
        yield x[inside], of[:n][inside]


@dataclass(frozen=True)
class Filter:
    """Masks by position; language i is bit i % 64 of word i // 64."""

    languages: list[str]
    masks: np.ndarray
    false_rates: np.ndarray
    fallback: str

    @staticmethod
    def positions(x: np.ndarray, size: int) -> Iterator[np.ndarray]:
        step = (x >> np.uint64(32)) | np.uint64(1)
        for i in range(HASHES):
            yield ((x + np.uint64(i) * step) & np.uint64(size - 1)).astype(np.int64)

    @classmethod
    def build(cls, languages: list[str], held: list[np.ndarray], fallback: str) -> Filter:
        size = 1 << max(10, int(8 * max(map(len, held), default=1)).bit_length())
        words = max(1, -(-len(languages) // 64))
        kind = np.uint8 if len(languages) <= 8 else np.uint64
        masks = np.zeros((words, size), kind)
        for i, x in enumerate(held):
            for at in cls.positions(x.astype(np.uint64), size):
                np.bitwise_or.at(masks[i // 64], at, kind(1 << (i % 64)))
        filled = [float(((masks[i // 64] >> kind(i % 64)) & kind(1)).mean()) for i in range(len(languages))]
        return cls(languages, masks, np.array(filled) ** HASHES, fallback)

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hits by text and language, and the n-grams of each text."""
        hits, total = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        size = self.masks.shape[1]
        for x, owner in grams(*spelled(texts)):
            total += np.bincount(owner, minlength=len(texts))
            at = list(self.positions(x, size))
            for w, masks in enumerate(self.masks):
                found = masks[at[0]]
                for p in at[1:]:
                    found &= masks[p]
                for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                    hits[:, i] += np.bincount(owner, weights=(found >> masks.dtype.type(i % 64)) & masks.dtype.type(1), minlength=len(texts))
        return hits, total

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (its part of all languages' corrected shares) and coverage (its corrected share) of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        hits, total = self.counts(texts)
        share = np.clip((hits / np.maximum(total, 1)[:, None] - self.false_rates) / (1 - self.false_rates), 0, 1)
        best, every = share.argmax(axis=1), share.sum(axis=1)
        cover = share[np.arange(len(texts)), best]
        named = [UNKNOWN if not n else self.languages[b] if c > 0 else self.fallback for n, b, c in zip(total, best, cover, strict=True)]
        return named, np.where(every > 0, cover / np.where(every > 0, every, 1), 0.0), cover


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Filter:
    """Fit on rows of (text, lang, key): nulls of text and lang are left out; ``key`` drives the sample."""
    labelled = labelled.select("text", "lang", F.col("key").cast("string").alias("key")).dropna(subset=["text", "lang"])
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Filter([], np.zeros((1, 1024), np.uint8), np.zeros(0), UNKNOWN)
    wanted = labelled.sparkSession.createDataFrame([(k, min(1.0, settings.sample_docs / n)) for k, n in sorted(sizes.items())], "lang string, share double")
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("langid"), "key")), 1, 13), 16, 10).cast("double") / 2**52
    sample = labelled.join(F.broadcast(wanted), "lang").filter(draw < F.col("share")).select("lang", "text")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                for x, _ in grams(*spelled(rows["text"].tolist())):
                    found, n = np.unique(x, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": found.view("int64"), "n": n})

    with temporary():
        return _filter(sample.mapInPandas(counted, "lang string, gram long, n long"), sizes, settings)


def _filter(found: DataFrame, sizes: dict[str, int], settings: Settings) -> Filter:
    """The filter of languages by documents (``sizes``) from their n-grams (lang, gram, n)."""
    table = stored(found.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langid-grams")
    total = table.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = table.join(F.broadcast(total), "lang").select("lang", "gram", "n", (F.col("n") / F.col("total")).alias("f"))
    top = shares.groupBy("gram").agg(F.max("f").alias("top"))
    member = shares.join(top, "gram").filter((F.col("f") >= settings.least_share * F.col("top")) & (F.col("n") >= settings.least_count))
    languages = sorted(sizes)
    held = [member.filter(F.col("lang") == name).orderBy(F.desc("n"), "gram").limit(settings.most_grams).select("gram").toPandas()["gram"].to_numpy("int64").view("uint64") for name in languages]
    return Filter.build(languages, held, max(languages, key=lambda k: (sizes[k], k)))


def identify(docs: DataFrame, model: Filter, text: str = "text") -> DataFrame:
    """Add lang_pred, score and coverage to every row; columns of these names are replaced."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def named(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score, cover = shared.value.predict(texts.fillna("").tolist())
            yield pd.DataFrame({"lang_pred": lang, "score": score, "coverage": cover})

    return with_fields(docs, F.pandas_udf(named, "lang_pred string, score double, coverage double")(F.col(text)), {n: n for n in ("lang_pred", "score", "coverage")})
