"""Toxic spans and document scores by a linear-chain conditional random field.

A token is a run of word characters, in lower case; its features are the word, its
prefixes of 3 to 8 characters, and the word together with the one before it, if that
tells more than either word alone. The chain has two states, other and toxic.

Fitting reads a hash sample of at most about ``sample_docs`` labelled documents of
each class. The model's features are those whose document frequency among toxic
documents exceeds that among clean ones by ``feature_odds`` and ``errors`` standard errors, and that occur in
``least_share`` of the sample's toxic documents (so their number is bounded by the
sample). Documents are labelled, tokens are not: their labels are latent. A clean
document says that none of its tokens is toxic, a toxic one that at least one is, and
the weights maximise the likelihood of that: the expectations of a toxic document's
chain are taken by forward-backward under the constraint, which leaves out the one
path without a toxic token. They start from weights fitted with the tokens of toxic
documents counted as toxic if a feature's odds reach ``seed_odds``, and an L2 penalty
holds them near these. Chains are windows of tokens
around all that have a feature of the model, at most ``fit_windows`` of them, by
documents in hash order. A logistic curve maps the chains' scores to the documents'
labels.

Scoring runs forward-backward over the whole chain of a document. Tokens without
any feature of the model share one transition matrix, so a run of them is one power
of it, in closed form; marginals are exact at the tokens with features. The
document's score comes from the odds that any of these is toxic, and tokens whose
marginal is ``span_at`` or more make up the offending spans, by character offsets.

Null and empty texts have no tokens and get the curve's value for none. Without
labelled documents of both classes nothing is toxic and every score is the share of
toxic labels (0 without labels). Copies of a document count once in fitting.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import small_batches, stored, temporary, with_fields

WORD = re.compile(r"\w+")
PREFIXES = range(3, 9)
#: Log odds beyond which documents are alike to the curve, so that wrong labels far out don't bend it.
FAR = (-6.0, 10.0)
#: Distinct words that a task looks up before it starts its table anew.
CACHED = 60_000
FLOOR = 1e-12


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 3000
    seed_odds: float = 4.0  #: log of the ratio of document frequencies
    feature_odds: float = 1.5
    errors: float = 2.0  #: standard errors by which the odds of a feature must be over that
    least_docs: int = 3
    least_share: float = 0.01  #: of the toxic documents of the sample, that hold a feature
    around: int = 3  #: tokens on either side in a fitting window
    fit_windows: int = 12_000  #: windows of the sample's documents that the weights are fitted to
    l2: float = 0.25
    noise: float = 0.1  #: share of documents that are taken to be labelled toxic without a toxic token
    seed_rounds: int = 150
    rounds: int = 50  #: with latent labels
    span_at: float = 0.5


def features(word: str) -> list[str]:
    return [f"w:{word}", *(f"p:{word[:k]}" for k in PREFIXES if len(word) > k)]


def own_features(words: list[str], chosen) -> list[list]:
    """What ``chosen`` (a mapping) says of each token's features, those that it has."""
    known = {w: [chosen[f] for f in features(w) if f in chosen] for w in set(words)}
    return [known[w] + [chosen[f] for f in (f"b:{before} {w}",) if f in chosen] for before, w in zip(["", *words], words, strict=False)]


@dataclass
class Field:
    """Weights of features (toxic against other), the bias of a token, and log transition weights."""

    weights: dict[str, float]
    bias: float
    moves: np.ndarray
    curve: tuple[float, float] = (1.0, 0.0)
    base: float = 0.0
    span_at: float = 0.5
    known: dict[str, float | None] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        #: Weights of two words in a row, by the second and then the first.
        self.after: dict[str, dict[str, float]] = {}
        for name, weight in self.weights.items():
            if name.startswith("b:"):
                first, second = name[2:].split(" ")
                self.after.setdefault(second, {})[first] = weight
        self.steps = self._powers()

    def _powers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """One transition, scaled, and the parts of the k-th power of a featureless token's."""
        a = np.exp(self.moves - self.moves.max())
        values, vectors = np.linalg.eig(a * np.array([1.0, math.exp(self.bias)]))
        order = np.argsort(-values.real)
        values, vectors = values.real[order], vectors.real[:, order]
        inverse = np.linalg.inv(vectors)
        return a, np.outer(vectors[:, 0], inverse[0]), np.outer(vectors[:, 1], inverse[1]), values[1] / values[0]

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def emission(self, word: str) -> float | None:
        """Log weight of toxic at a word with features of the model; None without any."""
        if word in self.known:
            return self.known[word]
        if len(self.known) >= CACHED:
            self.known.clear()
        found = [self.weights[f] for f in features(word) if f in self.weights]
        self.known[word] = value = self.bias + sum(found) if found else None
        return value

    def marginals(self, at: list[int], emissions: list[float], n: int) -> list[float]:
        """Chance of toxic at the positions ``at`` of a chain of n tokens, all others being without features."""
        a, first, second, ratio = self.steps
        gap = lambda k: first + second * ratio**k  # noqa: E731  the k-th power, scaled
        state, seen = np.array([1.0, 0.0]), -1
        forward = []
        for i, e in zip(at, emissions, strict=True):
            state = state @ gap(i - seen - 1) @ a
            state = state * ([1.0, math.exp(e)] if e < 30 else [math.exp(-e), 1.0])
            state /= state.sum()
            forward.append(state)
            seen = i
        back, out = gap(n - seen - 1) @ np.ones(2), []
        for k in range(len(at) - 1, -1, -1):
            both = forward[k] * back
            out.append(float(both[1] / both.sum()))
            e = emissions[k]
            back = a @ (np.array([1.0, math.exp(e)] if e < 30 else [math.exp(-e), 1.0]) * back)
            before = at[k - 1] if k else -1
            back = gap(at[k] - before - 1) @ back
            back /= back.sum()
        return out[::-1]

    def tag(self, text: str | None) -> tuple[float, list[tuple[int, float]]]:
        """Log odds that any token is toxic, and the tokens with features by number, with their marginals."""
        text = text or ""
        words = WORD.findall(text.lower())
        known = self.known
        scored = [known[w] if w in known else self.emission(w) for w in words]
        if after := self.after:
            for i in [i for i, w in enumerate(words) if w in after]:
                if i and (pair := after[words[i]].get(words[i - 1])) is not None:
                    scored[i] = pair + (self.bias if scored[i] is None else scored[i])
        at = [i for i, e in enumerate(scored) if e is not None]
        if not at:
            return math.log(FLOOR), []
        chances = self.marginals(at, [scored[i] for i in at], len(words))
        none = sum(math.log(max(1 - p, FLOOR)) for p in chances)
        return math.log(max(-math.expm1(none), FLOOR)) - max(none, -30.0), list(zip(at, chances, strict=True))

    def spans(self, text: str, tagged: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
        """Runs of neighbouring tokens at or over ``span_at``: start, end (in characters) and the highest marginal."""
        hot = {i: p for i, p in tagged if p >= self.span_at}
        if not hot:
            return []
        out: list[tuple[int, int, float]] = []
        i, last = 0, None
        for m in WORD.finditer(text):
            # Lower-casing may split a token in two; both halves lie in the same place.
            for _ in range(len(WORD.findall(m[0].lower()))):
                if (p := hot.get(i)) is not None:
                    if last == i - 1 and out:
                        out[-1] = (out[-1][0], m.end(), max(out[-1][2], p))
                    else:
                        out.append((m.start(), m.end(), p))
                    last = i
                i += 1
        return out

    def score(self, odds: float) -> float:
        slope, at = self.curve
        odds = max(FAR[0], min(FAR[1], odds))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, slope * odds + at))))


def _forward_backward(emit: np.ndarray, real: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log partition, toxic marginals and expected moves of each of some padded windows (rows) of log weights ``emit``."""
    n, length = emit.shape
    scores = np.stack([np.zeros_like(emit), emit], axis=2)
    ahead = np.full((length, n, 2), 0.0)
    ahead[0] = moves[0] + scores[:, 0]
    for t in range(1, length):
        moved = np.logaddexp(ahead[t - 1][:, :1] + moves[0], ahead[t - 1][:, 1:] + moves[1]) + scores[:, t]
        ahead[t] = np.where(real[:, t, None], moved, ahead[t - 1])
    z = np.logaddexp(ahead[-1][:, 0], ahead[-1][:, 1])
    behind = np.zeros((length, n, 2))
    pairs = np.zeros((n, 2, 2))
    for t in range(length - 1, 0, -1):
        into = scores[:, t] + behind[t]
        both = np.exp(ahead[t - 1][:, :, None] + moves + into[:, None, :] - z[:, None, None])
        pairs += both * real[:, t, None, None]
        moved = np.logaddexp(moves[:, 0] + into[:, :1], moves[:, 1] + into[:, 1:])
        behind[t - 1] = np.where(real[:, t, None], moved, behind[t])
    chance = np.exp(ahead[:, :, 1] + behind[:, :, 1] - z).T
    pairs[:, 0, 0] += 1 - chance[:, 0]
    pairs[:, 0, 1] += chance[:, 0]
    return z, chance * real, pairs


def pulls(z: np.ndarray, lengths: np.ndarray, calm: float, doc: np.ndarray, toxic: np.ndarray, noise: float = 0.0) -> np.ndarray:
    """How far each window's expectations, less those of the path without a toxic token, are to move.

    With P the chance that none of a document's tokens is toxic: in a clean document
    all the way back (-1); in a toxic one, where expectations under the constraint
    are (E - P E0) / (1 - P), by P / (1 - P), or less if a share ``noise`` of such labels is wrong.
    """
    none = np.exp(np.clip(np.bincount(doc, weights=calm * lengths - z), -700, 0))
    return np.where(toxic, ((1 - noise) * none / ((1 - noise) * (1 - none) + noise))[doc], -1.0)


def train(windows: list[tuple[list[list[int]], list[int], int, int]], names: list[str], settings: Settings) -> Field:
    """Fit weights to windows of (features by token, first labels by token, document, label of the document) by Adam."""
    lengths = np.array([len(w[1]) for w in windows])
    length, n = int(lengths.max()), len(windows)
    doc = np.unique([w[2] for w in windows], return_inverse=True)[1]
    toxic = np.array([w[3] == 1 for w in windows])
    real, y = np.arange(length) < lengths[:, None], np.zeros((n, length))
    flat, where = [], []
    for r, (tokens, labels, _, _) in enumerate(windows):
        y[r, : len(labels)] = labels
        for t, own in enumerate(tokens):
            flat += own
            where += [r * length + t] * len(own)
    flat, where = np.array(flat, np.int64), np.array(where, np.int64)
    k = len(names)
    w = np.zeros(k + 5)
    w[k] = -2.0
    was = np.concatenate([np.zeros((n, 1)), y[:, :-1]], axis=1)
    told = np.array([[((was == i) & (y == j) & real).sum() for j in (0, 1)] for i in (0, 1)], float)
    calm = np.zeros((n, 2, 2))
    calm[:, 0, 0] = lengths
    for rounds, latent in ((settings.seed_rounds, False), (settings.rounds, True)):
        m, v, start = np.zeros_like(w), np.zeros_like(w), w * latent
        for step in range(1, rounds + 1):
            emit = np.bincount(where, weights=w[flat], minlength=n * length).reshape(n, length) + w[k]
            z, chance, pairs = _forward_backward(np.where(real, emit, 0), real, w[k + 1 :].reshape(2, 2))
            if latent:
                pull = pulls(z, lengths, w[k + 1], doc, toxic, settings.noise)
                off, moved = (pull[:, None] * chance).ravel(), (pull[:, None, None] * (pairs - calm)).sum(axis=0)
            else:
                off, moved = ((y - chance) * real).ravel(), told - pairs.sum(axis=0)
            slope = np.concatenate([np.bincount(flat, weights=off[where], minlength=k), [off.sum()], moved.ravel()]) - settings.l2 * (w - start) * math.sqrt(n)
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
            w += (0.02 if latent else 0.2) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(dict(zip(names, w[:k].tolist(), strict=True)), float(w[k]), w[k + 1 :].reshape(2, 2), span_at=settings.span_at)


def _curve(odds: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> tuple[float, float]:
    """Logistic curve from odds to labels, by Newton's method with a slight pull to slope 1."""
    x = np.stack([odds, np.ones_like(odds)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        slope = x.T @ (rows * (labels - p)) - 0.1 * (w - [1.0, 0.0])
        bend = (x * (rows * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        move = np.linalg.solve(bend, slope)
        w += np.clip(move, -1, 1)
        if abs(move).max() < 1e-9:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Field:
    """Fit on the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) tells of; rows with a null are left out.

    The sample is drawn from the labels alone, so it is the only side of the join
    with the texts that moves; it has a bounded number of rows.
    """
    with temporary():
        return _fit(docs, labels, settings)


def _fit(docs: DataFrame, labels: DataFrame, settings: Settings) -> Field:
    told = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna().filter("toxic IN (0, 1)")
    sizes = {r.toxic: r.n for r in told.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Field({}, -10.0, np.zeros((2, 2)), (0.0, 40.0 if sizes.get(1) else -40.0))
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("toxicity"), F.col("doc_id").cast("string"))), 1, 13), 16, 10).cast("double") / 2**52
    share = F.when(F.col("toxic") == 1, min(1.0, settings.sample_docs / sizes[1])).otherwise(min(1.0, settings.sample_docs / sizes[0]))
    texts = docs.select("doc_id", "text").dropna().join(F.broadcast(told.filter(draw < share)), "doc_id")
    sample = stored(texts.dropDuplicates(["text", "toxic"]).select("text", "toxic"), "toxicity-sample")
    drawn = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = drawn.get(1, 0), drawn.get(0, 0)
    if not n1 or not n0:
        return Field({}, -10.0, np.zeros((2, 2)), (0.0, -40.0))

    def frequencies(only: set[str] | None):
        """Function for mapInPandas: how many documents hold each feature, of ``only`` those if told."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found: Counter = Counter()
                for t in batch["text"]:
                    words = WORD.findall(t.lower())
                    held = {f for w in set(words) for f in features(w)} | {f"b:{a} {b}" for a, b in zip(words, words[1:], strict=False)}
                    found.update(held if only is None else held & only)
                if found:
                    yield pd.DataFrame({"f": list(found), "n": list(found.values())})

        return run

    def counted(toxic: int, only: set[str] | None) -> DataFrame:
        return sample.filter(F.col("toxic") == toxic).mapInPandas(frequencies(only), "f string, n long").groupBy("f").agg(F.sum("n").alias("n"))

    least = max(settings.least_docs, math.ceil(settings.least_share * n1))
    # Each toxic document of the sample holds so many features, and each feature at least ``least`` of them: the table is bounded.
    d1 = {r.f: r.n for r in counted(1, None).filter(F.col("n") >= least).collect()}
    d0 = {r.f: r.n for r in counted(0, set(d1)).collect()}
    odds = {f: math.log((d1[f] + 0.5) / n1) - math.log((d0.get(f, 0) + 0.5) / n0) for f in d1}

    def tells(f: str) -> bool:
        """Whether a feature's odds are over ``feature_odds``, for two words in a row: over those of either word alone."""
        alone = [odds[g] for w in f[2:].split(" ") for g in features(w) if g in odds] if f.startswith("b:") else []
        error = math.sqrt(1 / (d1[f] + 0.5) + 1 / (d0.get(f, 0) + 0.5))
        return odds[f] - settings.errors * error >= settings.feature_odds + max([0.0, *alone])

    names = sorted(filter(tells, odds))
    index = {f: i for i, f in enumerate(names)}
    seeds = {index[f] for f in names if odds[f] >= settings.seed_odds}
    if not names:
        return Field({}, -10.0, np.zeros((2, 2)), (0.0, math.log(n1 / n0)))
    around = settings.around

    def windows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                own = own_features(WORD.findall(text.lower()), index)
                spans: list[list[int]] = []
                for i in [i for i, x in enumerate(own) if x]:
                    if spans and i - around <= spans[-1][1] and spans[-1][1] - spans[-1][0] < 16:
                        spans[-1][1] = i + around + 1
                    else:
                        spans.append([max(i - around, 0), i + around + 1])
                of = xxhash.xxh64_intdigest(text.encode(), toxic) >> 1
                for place, (a, b) in enumerate(spans):
                    part = own[a:b]
                    rows.append((of, place, toxic, part, [int(toxic == 1 and any(f in seeds for f in x)) for x in part]))
            if rows:
                yield pd.DataFrame(rows, columns=["of", "place", "toxic", "tokens", "labels"])

    found = sample.mapInPandas(windows_of, "of long, place int, toxic int, tokens array<array<int>>, labels array<int>")
    taken = found.orderBy("of", "place").limit(settings.fit_windows).toPandas()
    windows = [([list(map(int, t)) for t in x], list(map(int, y)), of, toxic) for of, toxic, x, y in zip(taken["of"], taken["toxic"], taken["tokens"], taken["labels"], strict=True)]
    field_ = train(windows, names, settings)

    def odds_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"odds": [field_.tag(t)[0] for t in batch["text"]], "toxic": batch["toxic"]})

    told = sample.mapInPandas(odds_of, "odds double, toxic int").toPandas()
    weight = np.where(told["toxic"] == 1, sizes[1] / n1, sizes[0] / n0)
    field_.curve = _curve(told["odds"].clip(*FAR).to_numpy(), told["toxic"].to_numpy(float), weight / weight.mean())
    return field_


def score(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """Add score, predicted (1 at 0.5 and over) and spans (start, end, marginal) to every row; columns of these names are replaced."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        field_ = shared.value
        for texts in batches:
            rows = []
            for t in texts:
                odds, tagged = field_.tag(t)
                value = field_.score(odds)
                rows.append((value, int(value >= 0.5), [{"start": a, "end": b, "marginal": p} for a, b, p in field_.spans(t or "", tagged)]))
            yield pd.DataFrame(rows, columns=["score", "predicted", "spans"])

    found = F.pandas_udf(scored, "score double, predicted int, spans array<struct<start:int,end:int,marginal:double>>")(F.col(text))
    return with_fields(docs, found, {n: n for n in ("score", "predicted", "spans")})
