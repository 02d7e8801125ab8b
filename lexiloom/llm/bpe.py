"""Byte-level BPE encoding and decoding with a given vocabulary.

Each match of the split pattern is encoded by itself: while some pair of live
neighbours has a rank, the leftmost pair of the least rank is merged. A segment
tree over byte positions keeps that pair at its root; a merge changes the pairs
of two live neighbours and clears one position, so it costs three updates of
logarithmic length, whatever the match's length. Matches that recur are looked up, as
words do: a table numbers them, and the ids of all texts of a batch are copied by their
matches' numbers at once. Short matches that are new go through their trees many at a time.

Null and empty texts have no ids. Texts are encoded whole; special tokens' strings
are ordinary text. Ids outside the vocabulary raise ``KeyError`` when decoded.
Other columns pass through; the added ones replace columns of the same name.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, islice, pairwise

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import with_fields

#: Distinct matches in the table that a worker looks up, and in the one before it.
CACHED = 120_000
#: Characters of texts whose matches are held at once; a longer text is held alone.
TEXTS_AT_ONCE = 1 << 17
#: Short matches from which, and up to which, trees are worked on at once.
AT_ONCE, MOST_AT_ONCE = 32, 2048
#: Stands for no rank.
NONE = 1 << 40
#: Ids as they are held and digested.
PACKED = np.dtype("<u4")
#: Runs that are copied at once.
RUNS_AT_ONCE = 1 << 17
#: Characters of the longest match that stays in a table.
LONGEST_KEPT = 64
# Bits of an id that leave room in a 64-bit slot for three, and the odd multiplier that spreads keys.
MOST_ID_BITS = 20
SPREAD = 0x9E3779B97F4A7C15


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match, by a segment tree of leftmost least pair ranks."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    bits = max(1, (n - 1).bit_length())
    size = 1 << bits
    none, mask = 1 << 62, size - 1
    # A node holds the rank and, in its last bits, the position: the least is the leftmost pair of least rank.
    tree = [none] * (2 * size)
    get = ranks.get
    for i in range(n - 1):
        if (r := get(piece[i : i + 2])) is not None:
            tree[size + i] = r << bits | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 2)), list(range(-1, n))

    while (top := tree[1]) < none:
        i = top & mask
        gone = after[i]
        last = after[i] = after[gone]
        tree[size + gone] = tree[size + i] = none
        if last < n:
            before[last] = i
            if (r := get(piece[i : after[last]])) is not None:
                tree[size + i] = r << bits | i
        j = before[i]
        if j >= 0:
            r = get(piece[j:last])
            tree[size + j] = none if r is None else r << bits | j
        else:
            j = i
        # The three positions' ways up, from right to left; where two have met, one is gone.
        x, y, z = size + gone >> 1, size + i >> 1, size + j >> 1
        while x:
            a, b = tree[2 * x], tree[2 * x + 1]
            tree[x] = a if a < b else b
            if y != x:
                a, b = tree[2 * y], tree[2 * y + 1]
                tree[y] = a if a < b else b
            if z != y:
                a, b = tree[2 * z], tree[2 * z + 1]
                tree[z] = a if a < b else b
            x, y, z = x >> 1, y >> 1, z >> 1
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Pairs:
    """Which two tokens in a row make a token: an open-addressed table from both ids to the id, for many look-ups at once.

    A slot holds both ids and, in its last bits, the id that they make. The id
    ``edge`` stands beside a match's ends and makes a token with none.
    """

    def __init__(self, ranks: dict[bytes, int]):
        get, self.edge = ranks.get, max(ranks.values()) + 1
        self.base, self.id_bits = self.edge + 1, self.edge.bit_length()
        slots = array("q")
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                if (a := get(token[:k])) is not None and (b := get(token[k:])) is not None:
                    slots.append((a * self.base + b) << self.id_bits | rank)
        slots = np.array(slots, np.int64)
        self.bits = max(4, int(2 * len(slots)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        at, left = self._place(slots >> self.id_bits), np.arange(len(slots))
        while len(left):
            slot, first = np.unique(at[left], return_index=True)
            taken = left[first[self.slots[slot] < 0]]
            self.slots[at[taken]] = slots[taken]
            left = left[self.slots[at[left]] != slots[left]]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
        #: Id of each two bytes, at 256 times the first and the second.
        self.of_bytes = np.array([get(bytes((x, y)), NONE) for x in range(256) for y in range(256)], np.int64)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(SPREAD)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of each two tokens, ``NONE`` if they make none."""
        keys, mask = a * self.base + b, (1 << self.id_bits) - 1
        at = self._place(keys)
        held = self.slots.take(at)
        hit = held >> self.id_bits == keys
        out = np.where(hit, held & mask, NONE)
        left = np.flatnonzero(~hit & (held >= 0))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            held = self.slots.take(at[left])
            hit = held >> self.id_bits == keys[left]
            out[left[hit]] = held[hit] & mask
            left = left[~hit & (held >= 0)]
        return out


def merge_arrays(pieces: list[bytes], pairs: Pairs, single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``merge`` of matches of up to the same power of two of bytes: one tree each, a merge of all of them at a time. All ids in a row, and how many each match has."""
    n = np.array([len(x) for x in pieces])
    bits = max(1, int(n.max() - 1).bit_length())
    w, size = len(pieces), 1 << bits
    mask, none = size - 1, NONE << bits
    place = np.arange(size)
    inside = place < n[:, None]
    raw = np.zeros((w, size), np.int64)
    raw[inside] = np.frombuffer(b"".join(pieces), np.uint8)
    # A match's ids end with an edge; so do those of the match before it in the array, so there is one on either side.
    ids = np.full((w, size + 1), pairs.edge, np.int64)
    np.copyto(ids[:, :size], single.take(raw), where=inside)
    node = np.full((w, 2 * size), none, np.int64)
    first = pairs.of_bytes.take(raw[:, :-1] << 8 | raw[:, 1:])
    np.copyto(node[:, size:-1], first << bits | place[:-1], where=inside[:, 1:] & (first != NONE))
    for k in range(bits - 1, 0, -1):
        np.minimum(node[:, 2 << k : 4 << k : 2], node[:, (2 << k) + 1 : 4 << k : 2], out=node[:, 1 << k : 2 << k])
    after, before = np.tile(np.arange(1, size + 2), (w, 1)), np.tile(np.arange(-1, size), (w, 1))
    tree, ids, after, before = node.ravel(), ids.ravel(), after.ravel(), before.ravel()
    links, trees = np.arange(w) * (size + 1), np.arange(w) * (2 * size)
    while True:
        # The root is not stored: it is the lesser of the two nodes below it.
        top = np.minimum(tree.take(trees + 2), tree.take(trees + 3))
        going = top < none
        if not going.all():
            links, trees, top = links[going], trees[going], top[going]
            if not len(top):
                break
        k, i = len(top), top & mask
        at = links + i
        gone = after.take(at)
        last = after.take(links + gone)
        after[at] = last
        before[links + last] = i
        made = top >> bits
        ids[at], ids[links + gone] = made, -1
        j = before.take(at)
        has = j >= 0
        found = pairs(np.concatenate((made, ids.take(links + j))), np.concatenate((ids.take(links + last), made)))
        # Leaves of the three positions; without a pair on the left, the unused node 0 stands for its leaf.
        at = np.concatenate((trees + gone, trees + i, trees + j)) + size
        tree[at[:k]] = none
        tree[at[k : 2 * k]] = np.where(found[:k] == NONE, none, found[:k] << bits | i)
        tree[np.where(has, at[2 * k :], trees)] = np.where(found[k:] == NONE, none, found[k:] << bits | j)
        up = np.concatenate((gone, i, np.where(has, j, i))) + size
        base = np.concatenate((trees, trees, trees))
        for _ in range(bits - 1):
            up >>= 1
            at = base + up
            below = at + up
            tree[at] = np.minimum(tree.take(below), tree.take(below + 1))
    live = inside & (ids.reshape(w, size + 1)[:, :size] >= 0)
    return ids.reshape(w, size + 1)[:, :size][live], np.count_nonzero(live, axis=1)


def merge_many(pieces: list[bytes], pairs: Pairs, single: np.ndarray) -> list[tuple[int, ...]]:
    """``merge_arrays`` with the ids of each match by itself."""
    flat, counts = merge_arrays(pieces, pairs, single)
    return [tuple(x.tolist()) for x in np.split(flat, np.cumsum(counts)[:-1])]


def runs(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that ``numbers`` name, one after the other, and where each begins there, with the end of all."""
    bounds = np.zeros(len(numbers) + 1, np.int64)
    np.cumsum(counts.take(numbers), out=bounds[1:])
    out = np.empty(bounds[-1], flat.dtype)
    for k in range(0, len(numbers), RUNS_AT_ONCE):
        some = numbers[k : k + RUNS_AT_ONCE]
        first, last = bounds[k], bounds[k + len(some)]
        at = np.repeat(starts.take(some) - bounds[k : k + len(some)] + first, counts.take(some))
        at += np.arange(len(at))
        out[first:last] = flat.take(at)
    return out, bounds


def split(items: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    return [items[a:b] for a, b in pairwise([0, *ends.tolist()])]


class Table:
    """Matches by number, and the ids of each: a run of ``flat``."""

    def __init__(self):
        self.number: defaultdict[str, int] = defaultdict(count().__next__)
        self.flat, self.starts, self.counts = np.zeros(0, PACKED), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        """Ids of the matches that were numbered last."""
        self.starts = np.concatenate((self.starts, np.cumsum(counts) - counts + len(self.flat)))
        self.counts, self.flat = np.concatenate((self.counts, counts)), np.concatenate((self.flat, flat))


class Codec:
    """Encoder and decoder of one vocabulary, with a bounded table of matches and the one before it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {i: token for token, i in ranks.items()}
        self.now, self.older = Table(), Table()
        self.pairs: Pairs | None = None
        most = max(self.tokens, default=0)
        self.small_ids = most < 1 << MOST_ID_BITS
        self.whole_alphabet = self.small_ids and all(bytes((x,)) in ranks for x in range(256))
        if self.small_ids:
            tokens = [self.tokens.get(i, b"") for i in range(most + 1)]
            self.token_lengths, self.token_bytes = np.array([len(x) for x in tokens]), np.frombuffer(b"".join(tokens), np.uint8)
            self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths

    @property
    def known(self) -> dict[str, int]:
        return self.now.number

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all matches in a row, and how many each has; short ones are merged many at a time, if the vocabulary has all bytes."""
        whole = list(map(self.ranks.get, pieces))
        left = [k for k, r in enumerate(whole) if r is None]
        one = [k for k, r in enumerate(whole) if r is not None]
        # Parts hold the ids of some matches each, whose places follow in ``order``.
        parts, order, counts = [np.array([whole[k] for k in one], PACKED)], one, np.ones(len(pieces), np.int64)
        n = np.array([len(pieces[k]) for k in left], np.int64)
        bits = np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)
        for b in np.unique(bits).tolist():
            places = [left[k] for k in np.flatnonzero(bits == b).tolist()]
            many = len(places) >= AT_ONCE and b <= 6 and self.has_all_bytes()
            for at in range(0, len(places), MOST_AT_ONCE):
                some = places[at : at + MOST_AT_ONCE]
                if many:
                    flat, counts[some] = merge_arrays([pieces[k] for k in some], self.pairs, self.single)
                else:
                    found = [merge(pieces[k], self.ranks) for k in some]
                    flat, counts[some] = list(chain.from_iterable(found)), [len(x) for x in found]
                parts.append(np.array(flat, PACKED))
                order = order + some
        starts, sizes = np.zeros(len(pieces), np.int64), counts[order]
        starts[order] = np.cumsum(sizes) - sizes
        return runs(np.concatenate(parts), starts, counts, np.arange(len(pieces)))[0], counts

    def has_all_bytes(self) -> bool:
        """Whether matches can be merged many at a time: there is a token for each byte, and ids fit the slots of ``Pairs``."""
        if self.whole_alphabet and self.pairs is None:
            self.pairs = Pairs(self.ranks)
            self.single = np.array([self.ranks[bytes((x,))] for x in range(256)], np.int64)
        return self.whole_alphabet

    def encoded(self, texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some texts at a time, ids of all of them in a row and where each text's end; matches that recur are looked up."""
        some, size = [], 0
        for text in texts:
            some.append(text or "")
            size += len(some[-1])
            if size >= TEXTS_AT_ONCE:
                yield self._encoded(some)
                some, size = [], 0
        if some:
            yield self._encoded(some)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        every = [self.pattern.findall(t) for t in texts]
        if len(self.now.counts) >= CACHED:  # what the next texts need again comes back from the older table
            self.now, self.older = Table(), self.now
        ends = np.cumsum([len(x) for x in every])
        try:
            return self._looked_up(chain.from_iterable(every), ends)
        except BaseException:
            self.now = Table()  # it has numbers without ids
            raise

    def _looked_up(self, matches: Iterator[str], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        now, before = self.now, len(self.now.number)
        numbers = np.fromiter(map(now.number.__getitem__, matches), np.int64, ends[-1])
        new = list(islice(reversed(now.number), len(now.number) - before))[::-1]
        flat, counts = self._ids_of(new)
        held = now.flat, now.starts, now.counts
        now.add(flat, counts)
        ids, bounds = runs(now.flat, now.starts, now.counts, numbers)
        if long := [k for k, match in enumerate(new) if len(match) > LONGEST_KEPT]:
            for k in long:
                del now.number[new[k]]
            short = counts.copy()
            short[long] = 0
            now.flat, now.starts, now.counts = held
            now.add(runs(flat, np.cumsum(counts) - counts, short, np.arange(len(new)))[0], short)
        return ids, bounds[ends]

    def _ids_of(self, matches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids in a row of matches that the table lacks, and how many each has; the older table has some."""
        older, get = self.older, self.older.number.get
        at = np.array([get(m, -1) for m in matches], np.int64)
        lacking = np.flatnonzero(at < 0)
        flat, counts = self.merged([matches[k].encode() for k in lacking.tolist()])
        if len(lacking) == len(matches):
            return flat, counts
        starts, sizes, had = np.zeros(len(matches), np.int64), np.zeros(len(matches), np.int64), np.flatnonzero(at >= 0)
        starts[had], sizes[had] = older.starts[at[had]], older.counts[at[had]]
        starts[lacking], sizes[lacking] = np.cumsum(counts) - counts + len(older.flat), counts
        return runs(np.concatenate((older.flat, flat)), starts, sizes, np.arange(len(matches)))[0], sizes

    def encode_many(self, texts) -> list[list[int]]:
        """Ids of each text."""
        return [x.tolist() for ids, ends in self.encoded(texts) for x in split(ids, ends)]

    def encode(self, text: str | None) -> list[int]:
        return self.encode_many([text])[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decoded(self, ids: np.ndarray, ends: np.ndarray) -> list:
        """Bytes of each text, from what ``encoded`` yields."""
        if not self.small_ids:
            return [self.decode(x.tolist()) for x in split(ids, ends)]
        raw, bounds = runs(self.token_bytes, self.token_starts, self.token_lengths, ids)
        return split(raw, bounds[ends])


_codecs: dict[str, Codec] = {}


def _codec(shared, pattern: str) -> Codec:
    """A worker's codec; built once from the broadcast vocabulary file."""
    held = shared.value
    key = hashlib.sha256(held + pattern.encode()).hexdigest()
    if key not in _codecs:
        _codecs[key] = Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, held.splitlines())}, pattern)
    return _codecs[key]


def _shared(df: DataFrame, vocabulary: str):
    """The vocabulary file is of fixed size (under 1 MB here), so it is broadcast whole."""
    with open(vocabulary, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the array of token ids of each text."""
    shared = _shared(df, vocabulary)

    @F.pandas_udf("array<int>")
    def to_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(shared, pattern)
        for texts in batches:
            yield pd.Series([x.astype(np.int32) for ids, ends in codec.encoded(texts) for x in split(ids, ends)], dtype=object)

    return df.withColumn(ids, to_ids(F.col(text)))


def decode(df: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", raw: str = "decoded") -> DataFrame:
    """Add the bytes that each array of ids stands for."""
    shared = _shared(df, vocabulary)

    @F.pandas_udf("binary")
    def to_bytes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(shared, pattern)
        for arrays in batches:
            yield pd.Series([None if a is None else codec.decode(a.tolist()) for a in arrays], dtype=object)

    return df.withColumn(raw, to_bytes(F.col(ids)))


def digests(df: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """Add n_tokens, ids_sha256 and decoded_sha256: each text is encoded and its ids decoded in one pass, and only digests leave the worker."""
    shared = _shared(df, vocabulary)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(shared, pattern)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for texts in batches:
            rows = []
            for ids, ends in codec.encoded(texts):
                for x, raw in zip(split(ids, ends), codec.decoded(ids, ends), strict=True):
                    rows.append((len(x), sha(x), sha(raw)))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return with_fields(df, both(F.col(text)), {n: n for n in ("n_tokens", "ids_sha256", "decoded_sha256")})
