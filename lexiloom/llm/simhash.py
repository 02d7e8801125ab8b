"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's A-Z are lower-cased, its words (runs of characters other than U+0020 and
U+0009 to U+000D) form shingles, and each shingle's XXH64 (seed 42) votes on 64
bits; a bit is 1 if over half of the shingles set it. Texts of fewer words than a
shingle are one shingle; texts without words, null and empty ones included, have
fingerprint 0 and link like any other.

Fingerprints link at ``distance`` or fewer differing bits. The 64 bits are split
into m groups of correlated bits with thresholds t_1 ... t_m that add up to
distance - m + 1 (a threshold of -1 leaves a group out): two fingerprints within
the distance must lie within t_i of one another on some group i. The number of
groups and the thresholds come from a dynamic programme over the expected number
of candidates and signatures, from the bits' joint counts over all fingerprints.
Equal fingerprints are one node. Each node is probed at its own value of a group
and at neighbouring values as far as the group's threshold asks; nodes that meet
at a value are verified on all bits, and a spanning forest of the links goes on
to connected components, so a dense group costs links in proportion to its size.
Values at which more than ``BLOCK`` nodes meet are dealt out by pairs of blocks.
A dense group meets at most of the values that its nodes are filed under, and each
value has links that span it. With a ``similarity``, where these values are many, nodes
first meet at their own values alone; what that joins need not be linked again, so at
all values only links between nodes not joined yet are made: see ``near_roots``.

The programme plans for ``PLANNED`` nodes at least, so that what a node is filed
under does not change with the size of the input up to there.

With a ``similarity``, what fingerprints bring together is only a candidate: within
each component, distinct word sequences link if the Jaccard similarity of their sets
of shingles reaches it, and the components of these links count.

Each distinct shingle then votes once, as it counts once in the similarity. Nodes
that meet are candidates if their fingerprints and as many check bits, a second
fingerprint from the same hashes, lie within ``total`` bits together; the distance
of the first alone decides only where they are sure to meet. Without check bits,
chance links among many texts would join strangers into ever larger candidates.
A candidate group of over ``TEXT_BLOCK`` word sequences is first held against one of
its own, so that a dense group of any size is linked without being dealt by pairs of
blocks: see ``_large_groups``.
Of a set of few shingles one shingle sways many bits, so short texts are also brought
together exactly: two sets that are alike share what is left after leaving out, from
each, as many shingles as the similarity allows.

Repeated rows and ties are linked like other copies. Null ids are ignored when a
component's least id is taken. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate, combinations
from math import ceil, comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.common import small_batches, sorted_groups, sorted_runs, stored, temporary, with_fields
from lexiloom.llm.components import components

SEED, BITS = 42, 64
# Shifts and odd factors of the 64-bit mixer behind the check bits.
MIX = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))
#: Nodes that meet at one value and are compared within one task; more are dealt out by pairs of blocks.
BLOCK = 65536
#: Nodes that the dynamic programme plans for at least.
PLANNED = 10**7
#: Rows, of 24 bytes, up to which the table of full values is broadcast.
BROADCAST_ROWS = 100_000
#: Nodes of a bucket up to which all its pairs are compared at once for many buckets.
SMALL = 64
#: Comparisons of a larger bucket that are made at once.
AT_ONCE = 1 << 20
#: Documents that are compared by shingles within one task; more are dealt out by pairs of blocks.
TEXT_BLOCK = 512
#: Cores of a set of shingles up to which it is filed under all of them; at a similarity of 0.8, all sets of up to 14 shingles.
CORES = 128
#: Cost of writing, moving and sorting a signature, in comparisons of two fingerprints; disk counts as dearer than CPU time.
SIGNATURE_COST = 2500.0


def _hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, ">u8")
    digest = xxhash.xxh64_digest
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.frombuffer(digest(joined, SEED), ">u8")
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends)]
    return np.frombuffer(b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :], strict=False)]), ">u8")


def _votes(hashes: np.ndarray) -> int:
    """Signed 64 bits, each set if over half of the hashes set it."""
    votes = np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes)).view(">i8")[0])


def fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit SimHash of one text."""
    return _votes(_hashes(text, shingle))


def both_prints(text: str | None, shingle: int, distinct: bool = False) -> tuple[int, int]:
    """The fingerprint, and as many check bits: the vote of the same hashes, mixed anew; if ``distinct``, repeats vote once."""
    hashes = _hashes(text, shingle)
    if distinct:
        hashes = np.unique(hashes)
    mixed = hashes.astype(np.uint64)
    for shift, factor in MIX:
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return _votes(hashes), _votes((mixed ^ (mixed >> np.uint64(31))).astype(">u8"))


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", fp: str = "fp", words: str = "words", check: str = "check", distinct: bool = False) -> DataFrame:
    """Add the fingerprint of each whole text and its check bits as signed longs, repeated shingles counted once if ``distinct``, and a 128-bit digest of its word sequence in hex; columns of these names are replaced."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            digest = [xxhash.xxh3_128_hexdigest(b" ".join((t or "").encode().lower().split())) for t in texts]
            prints = np.array([both_prints(t, shingle, distinct) for t in texts], "int64").reshape(-1, 2)
            yield pd.DataFrame({"fp": prints[:, 0], "check": prints[:, 1], "words": digest})

    return with_fields(docs, F.pandas_udf(of, "fp long, check long, words string")(F.col(text)), {fp: "fp", check: "check", words: "words"})


def bit_counts(nodes: DataFrame) -> np.ndarray:
    """How many fingerprints set both of two bits, for all pairs of bits; over all rows, 4,096 sums."""

    def joint(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            bits = np.unpackbits(batch["fp"].to_numpy(">i8").view(np.uint8)).reshape(-1, BITS).astype(np.float32)
            total += bits.T @ bits
        yield pd.DataFrame({"at": np.arange(BITS * BITS), "n": total.ravel().astype("int64")})

    counts = np.zeros(BITS * BITS)
    for row in nodes.select("fp").mapInPandas(joint, "at int, n long").groupBy("at").sum("n").collect():
        counts[row[0]] = row[1]
    return counts.reshape(BITS, BITS)


def group_bits(counts: np.ndarray, n: int, groups: int) -> list[list[int]]:
    """Split the bits into groups of like size, each grown by the bit most correlated with it."""
    p = np.diag(counts) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tied = np.abs((counts / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    left, out = set(range(BITS)), []
    for g in range(groups):
        size = BITS * (g + 1) // groups - BITS * g // groups
        chosen = [min(left)]
        left.discard(chosen[0])
        while len(chosen) < size:
            best = max(sorted(left), key=lambda b: tied[b, chosen].sum())
            chosen.append(best)
            left.discard(best)
        out.append(chosen)
    return out


def near_shares(counts: np.ndarray, n: int, bits: list[int], most: int) -> list[float]:
    """Expected share of pairs that differ on 0, up to 1, ... up to ``most`` of the bits, taken as a Markov chain in the group's order."""
    n = max(n, 1)
    state: dict[tuple[int, int], float] = {}
    for k, b in enumerate(bits):
        p = counts[b, b] / n
        differs = 2 * p * (1 - p)
        if not k:
            state = {(0, 0): 1 - differs, (1, 1): differs}
            continue
        a = bits[k - 1]
        both, one, other = counts[a, b] / n, counts[a, a] / n, p
        cells = np.array([[1 - one - other + both, other - both], [one - both, both]]).clip(0)
        joint = [[float((cells**2).sum()), float(2 * (cells[0, 0] * cells[0, 1] + cells[1, 0] * cells[1, 1]))], [float(2 * (cells[0, 0] * cells[1, 0] + cells[0, 1] * cells[1, 1])), float(2 * (cells[0, 0] * cells[1, 1] + cells[0, 1] * cells[1, 0]))]]
        after: dict[tuple[int, int], float] = {}
        for (d, was), share in state.items():
            total = sum(joint[was]) or 1.0
            for now in (0, 1):
                if d + now <= most:
                    after[d + now, now] = after.get((d + now, now), 0.0) + share * joint[was][now] / total
        state = after
    return [sum(s for (d, _), s in state.items() if d <= t) for t in range(most + 1)]


def signatures_of(size: int, threshold: int) -> float:
    """Values that a node is filed under: its own; for 1, also those with a set bit cleared; for 2, all at one bit's distance."""
    return {-1: 0.0, 0: 1.0, 1: 1 + size / 2, 2: 1.0 + size}[threshold]


def allocate(counts: np.ndarray, n: int, distance: int, planned: int | None = None) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds, at the least expected cost for ``planned`` nodes like the n counted."""
    planned = planned or n
    best: tuple[float, list[tuple[list[int], int]]] = (float("inf"), [])
    for m in range(max(1, -(-(distance + 1) // 3)), distance + 2):
        groups = group_bits(counts, n, m)
        # plans[s]: least cost so far at which thresholds, each plus one, add up to s.
        plans: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for bits in groups:
            shares, after = near_shares(counts, n, bits, 2), {}
            for s, (cost, chosen) in plans.items():
                for t in (-1, 0, 1, 2):
                    filed = signatures_of(len(bits), t)
                    pairs = 0.0 if t < 0 else planned * planned / 2 * shares[t]
                    total = cost + planned * filed * SIGNATURE_COST + pairs
                    if s + t + 1 <= distance + 1 and total < after.get(s + t + 1, (float("inf"),))[0]:
                        after[s + t + 1] = (total, [*chosen, t])
            plans = after
        if distance + 1 in plans and plans[distance + 1][0] < best[0]:
            best = (plans[distance + 1][0], list(zip(groups, plans[distance + 1][1], strict=True)))
    return [(bits, t) for bits, t in best[1] if t >= 0]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def signatures(nodes: DataFrame, plan: list[tuple[list[int], int]], own_only: bool = False) -> DataFrame:
    """One row (part, value and the node's columns) for each value that a fingerprint is filed under, or for its own values alone."""
    filed = []
    for part, (bits, threshold) in enumerate(plan):
        ones = [_signed(1 << (BITS - 1 - b)) for b in bits]
        own = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << (BITS - 1 - b) for b in bits))))
        values = [own]
        if threshold == 1 and not own_only:
            values += [F.when(own.bitwiseAND(F.lit(x)) != 0, own.bitwiseXOR(F.lit(x))) for x in ones]
        elif threshold == 2 and not own_only:
            values += [own.bitwiseXOR(F.lit(x)) for x in ones]
        filed += [F.struct(F.lit(part).alias("part"), v.alias("value")) for v in values]
    return nodes.select("*", F.explode(F.array(*filed)).alias("s")).select("s.part", "s.value", *nodes.columns).filter("value IS NOT NULL")


def _near(a: np.ndarray, b: np.ndarray, distance: int, total: int) -> np.ndarray:
    """Whether unsigned (fingerprint, check) pairs lie within ``total`` bits on both, or within ``distance`` on the first if both may differ everywhere."""
    first = np.bitwise_count(a[..., 0] ^ b[..., 0])
    if total >= 2 * BITS:
        return first <= distance
    return first + np.bitwise_count(a[..., 1] ^ b[..., 1]) <= total


def forest(prints: np.ndarray, distance: int, total: int, roots: np.ndarray | None = None) -> tuple[list[int], list[int]]:
    """Links, by place, that span the components of the bucket; every pair is accounted for. Nodes of one root are joined already."""
    left, right, rest = [], [], np.arange(len(prints))
    if roots is not None:
        while len(rest):
            queue, reached = [], np.array([roots[rest[0]]])
            while True:
                joined = np.isin(roots[rest], reached)
                queue += rest[joined].tolist()
                rest = rest[~joined]
                if not queue or not len(rest):
                    break
                i = queue.pop()
                found = rest[_near(prints[rest], prints[i], distance, total)]
                reached, first = np.unique(roots[found], return_index=True)
                left += [i] * len(first)
                right += found[first].tolist()
        return left, right
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            near = _near(prints[rest], prints[i], distance, total)
            if near.any():
                found = rest[near].tolist()
                left += [i] * len(found)
                right += found
                queue += found
                rest = rest[~near]
    return left, right


def near_pairs(prints: np.ndarray, distance: int, total: int = 2 * BITS, roots: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All links of a bucket, by place, or spanning ones if there are more links than members; none between nodes of one root."""
    left, right, n = [], [], 0
    rows = max(16, AT_ONCE // max(len(prints), 1))
    for at in range(0, len(prints), rows):
        i, j = np.nonzero(_near(prints[at : at + rows, None], prints[None, at:], distance, total))
        i, j = i[j > i] + at, j[j > i] + at
        if (n := n + len(i)) > len(prints):
            return tuple(np.array(x, "int64") for x in forest(prints, distance, total, roots))
        apart = slice(None) if roots is None else roots[i] != roots[j]
        left.append(i[apart])
        right.append(j[apart])
    return np.concatenate(left), np.concatenate(right)


def _verify(key: list[str], distance: int, total: int):
    """Function for mapInPandas over rows sorted by ``key``: links of each bucket; between their roots if the rows have a column own."""

    def linked(frame: pd.DataFrame) -> pd.DataFrame:
        prints = frame[["fp", "check"]].to_numpy("int64").view("uint64")  # counts of bits are of absolute values if signed
        keys = frame[key].to_numpy("int64")
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(keys)))
        roots = frame["own"].to_numpy("int64").view("uint64") if "own" in frame else None
        if roots is not None:  # buckets of one root have nothing to link
            mixed = np.minimum.reduceat(roots, starts) != np.maximum.reduceat(roots, starts)
            rows = np.repeat(mixed, sizes)
            prints, roots, sizes = prints[rows], roots[rows], sizes[mixed]
            starts = np.cumsum(sizes) - sizes
        names = prints[:, 0] if roots is None else roots
        left, right = [], []

        def add(s: int, a: np.ndarray, b: np.ndarray) -> None:
            left.append(names[s + a])
            right.append(names[s + b])

        for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
            add(s, *near_pairs(prints[s : s + n], distance, total, roots if roots is None else roots[s : s + n]))
        few = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
        x, bucket, own = prints[few], np.repeat(np.arange(len(sizes)), sizes)[few], []
        named = names[few]
        for k in range(1, SMALL):
            if len(x) <= k or not (same := bucket[k:] == bucket[:-k]).any():
                break
            own.append(np.flatnonzero(same & _near(x[k:], x[:-k], distance, total)))
        # Buckets with more links than members give a forest instead of all their links.
        tally = sum((np.bincount(bucket[i], minlength=len(sizes)) for i in own), np.zeros(len(sizes), int))
        dense = tally > sizes
        for k, i in enumerate(own, 1):
            i = i[~dense[bucket[i]]]
            i = i[named[i] != named[i + k]]
            left.append(named[i])
            right.append(named[i + k])
        for s, n in zip(starts[dense], sizes[dense], strict=True):
            add(s, *(np.array(p, "int64") for p in forest(prints[s : s + n], distance, total, roots if roots is None else roots[s : s + n])))
        empty = np.zeros(0, "uint64")
        return pd.DataFrame({"u": np.concatenate([empty, *left]).view("int64"), "v": np.concatenate([empty, *right]).view("int64")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in sorted_runs(batches, key):
            yield linked(rows)

    return run


def planned(nodes: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds for nodes (fp)."""
    n = nodes.count()
    return allocate(bit_counts(nodes), n, distance, max(n, PLANNED))


def links(nodes: DataFrame, distance: int, total: int = 2 * BITS) -> DataFrame:
    """Links (u, v) between fingerprints that span all pairs of nodes (fp, check) within the distance, or all that meet and lie within ``total`` bits with the check bits."""
    return links_of(signatures(nodes, planned(nodes, distance)), distance, total)


def near_roots(nodes: DataFrame, distance: int, total: int, more: DataFrame) -> DataFrame:
    """One row (node, root) for each node that is not the root of its component under ``links`` and the links ``more``.

    First from ``more`` and the nodes' own values alone, which join most of a dense
    group; at all values, links between the roots of what these join are enough.
    """
    plan = planned(nodes, distance)
    joined = components(links_of(signatures(nodes, plan, own_only=True), distance, total).unionByName(more)).withColumnRenamed("node", "fp")
    rooted = stored(nodes.join(joined, "fp", "left").select("fp", "check", F.coalesce("root", "fp").alias("own")), "rooted")
    roots = components(links_of(signatures(rooted, plan), distance, total))
    found = rooted.join(roots, F.col("own") == F.col("node"), "left").select(F.col("fp").alias("node"), F.coalesce("root", "own").alias("root"))
    return found.filter("node <> root").distinct().checkpoint()  # one fingerprint may have several check bits


def links_of(filed: DataFrame, distance: int, total: int) -> DataFrame:
    """Links (u, v) that span all near pairs filed under one value (part, value, fp, check); with a column own, the root of what a node is joined with, links between these roots."""
    spark = filed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    full = filed.groupBy("part", "value").count().filter(F.col("count") > BLOCK)
    full = stored(full.select("part", "value", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "full-buckets")
    n_full = full.count()
    # At most one value in BLOCK signatures is full: such a table is broadcast while it is small, and shuffled beyond.
    known = F.broadcast(full) if n_full <= BROADCAST_ROWS else full
    few = filed.join(known, ["part", "value"], "left_anti") if n_full else filed
    order = ["part", "value"]
    found = few.repartition(parts, *order).sortWithinPartitions(*order).mapInPandas(_verify(order, distance, total), "u long, v long")
    if n_full:
        blocked = (
            filed.join(known, ["part", "value"])
            .withColumn("b", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("part", "value", F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"), *filed.columns[2:])
        )
        order = ["part", "value", "i", "j"]
        found = found.unionByName(blocked.repartition(parts, *order).sortWithinPartitions(*order).mapInPandas(_verify(order, distance, total), "u long, v long"))
    return found


@cache
def left_out(n: int, similarity: float) -> np.ndarray | None:
    """The choices of members, by place, that a set of n leaves out for its cores, -1 for none; None if they are over ``CORES``."""
    most, choices = n - ceil(similarity * n - 1e-9), 0
    for k in range(most + 1):
        choices += comb(n, k)
        if choices > CORES:  # binomials of large sets are never worked out
            return None
    return np.array([[*c, *[-1] * (most - k)] for k in range(most + 1) for c in combinations(range(n), k)], int).reshape(choices, most)


@cache
def longest(similarity: float) -> float:
    """The most members of a set that has cores: those that leave out none, or whose choices are few."""
    if similarity >= 1:
        return float("inf")
    return max(n for n in range(1, max(CORES, ceil(1 / (1 - similarity))) + 2) if left_out(n, similarity) is not None)


def cores(text: str | None, shingle: int, similarity: float) -> np.ndarray:
    """Sums of hashes of all that a short text can share with a set that is alike; none for longer texts and those without words."""
    # So many distinct shingles hold up to ``shingle - 1`` distinct words more.
    if len(set((text or "").encode().lower().split())) >= longest(similarity) + shingle:
        return np.zeros(0, "int64")
    hashes = np.unique(_hashes(text, shingle)).astype(np.uint64)
    chosen = left_out(len(hashes), similarity) if len(hashes) else None
    if chosen is None:
        return np.zeros(0, "int64")
    return (hashes.sum() - np.append(hashes, np.uint64(0))[chosen].sum(axis=1, dtype=np.uint64)).view("int64")


def short_links(docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links (u, v) between the fingerprints of short texts that share a core, each to the core's least."""

    def filed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [cores(t, shingle, similarity) for t in batch["text"]]
            prints = [both_prints(t, shingle, True)[0] if len(c) else 0 for t, c in zip(batch["text"], found, strict=True)]
            yield pd.DataFrame({"core": np.concatenate([np.zeros(0, "int64"), *found]), "fp": np.repeat(np.array(prints, "int64"), [len(c) for c in found])})

    # Grouped tables are stored before they are joined back, so that a hot core can be split.
    under = stored(docs.select("text").mapInPandas(filed, "core long, fp long").distinct(), "short-cores")
    least = stored(under.groupBy("core").agg(F.min("fp").alias("v"), F.max("fp").alias("most")).filter("v < most").select("core", "v"), "least-of-cores")
    return under.join(least, "core").filter("fp <> v").select(F.col("fp").alias("u"), "v").distinct()


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; none for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, "int64")
    found = {xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(max(1, len(words) - shingle + 1))}
    return np.sort(np.fromiter(found, np.uint64, len(found)).view("int64"))


class _Index:
    """Which of some sets hold a value: their values in order, each with its owner."""

    def __init__(self, sets: list[np.ndarray], chosen: np.ndarray):
        self.n = len(sets)
        sizes = np.array([len(sets[i]) for i in chosen], int)
        flat = np.concatenate([np.zeros(0, "int64"), *(sets[i] for i in chosen)])
        order = np.argsort(flat, kind="stable")
        self.values, self.owners = flat[order], np.repeat(chosen, sizes)[order]

    def shared(self, own: np.ndarray) -> np.ndarray:
        """How many values each set shares with ``own``; 0 for sets that were not chosen."""
        start, end = np.searchsorted(self.values, own, "left"), np.searchsorted(self.values, own, "right")
        counts = end - start
        at = np.repeat(start - np.append(0, np.cumsum(counts)[:-1]), counts) + np.arange(counts.sum())
        return np.bincount(self.owners[at], minlength=self.n)


def jaccard_forest(sets: list[np.ndarray], similarity: float) -> tuple[list[int], list[int]]:
    """Links that span the components of the sets; every pair is accounted for. Empty sets are alike."""
    sizes = np.array([len(s) for s in sets])
    left, right, open_ = [], [], np.ones(len(sets), bool)
    index, held = _Index(sets, np.arange(len(sets))), len(sets)
    for seed in range(len(sets)):
        if not open_[seed]:
            continue
        open_[seed] = False
        queue = [seed]
        while queue and open_.any():
            i = queue.pop()
            both = index.shared(sets[i])
            found = np.flatnonzero(open_ & (both >= similarity * (sizes + sizes[i] - both) - 1e-9))
            left += [i] * len(found)
            right += found.tolist()
            queue += found.tolist()
            open_[found] = False
            if (still := int(open_.sum())) < 0.7 * held:  # what is linked is not looked up any more
                index, held = _Index(sets, np.flatnonzero(open_)), still
    return left, right


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def across(stars: list[np.ndarray], others: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """For each of ``others`` that is alike some of ``stars``, its place and that of one such star."""
    index, sizes, out = _Index(stars, np.arange(len(stars))), np.array([len(s) for s in stars]), []
    for k, own in enumerate(others):
        both = index.shared(own)
        found = np.flatnonzero(both >= similarity * (sizes + len(own) - both) - 1e-9)
        if len(found):
            out.append((k, int(found[0])))
    return out


LINK = "u string, v string"


def _blocks_linked(sets: DataFrame, n: str, similarity: float) -> DataFrame:
    """Links among the sets (words, candidate, shingles) of each candidate group of ``n``, dealt by pairs of blocks."""
    order = ["candidate", "i", "j"]
    dealt = (
        sets.withColumn("blocks", F.ceil(F.col(n) / TEXT_BLOCK).cast("int"))
        .withColumn("b", F.pmod(F.xxhash64("words"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("candidate", F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"), "words", "shingles")
        .repartition(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
        .sortWithinPartitions(*order)
    )

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in sorted_groups(batches, order):
            rows = rows.drop_duplicates("words")
            names = rows["words"].to_numpy(object)
            left, right = jaccard_forest([np.asarray(x, "int64") for x in rows["shingles"]], similarity)
            if left:
                yield pd.DataFrame({"u": names[left], "v": names[right]})

    return dealt.mapInPandas(linked, LINK)


def _large_groups(members: DataFrame, similarity: float) -> DataFrame:
    """Links within candidate groups of any size, from their stored sets (words, candidate, leader, shingles).

    Jaccard distance is a metric. With d = 1 - similarity, a group's sets are stars
    (within d of its leader: linked to it), a ring (within 2 d) or outside. A star
    can link with a star, which the leader already joins, or with the ring, not with
    those outside. So the ring is held against the stars, and all but the stars
    against one another, by pairs of blocks; where all are stars, nothing is left.
    """
    near, far = similarity - 1e-9, 1 - 2 * (1 - similarity) - 1e-9
    leaders = members.filter("words = leader").select(F.col("candidate").alias("of"), F.col("shingles").alias("lead"))
    leaders = stored(leaders.dropDuplicates(["of"]), "leaders")

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            alike = np.array([jaccard(np.asarray(a), np.asarray(b)) for a, b in zip(batch["shingles"], batch["lead"], strict=True)])
            yield batch[["words", "candidate", "leader", "shingles"]].assign(place=np.where(alike >= near, 0, np.where(alike >= far, 1, 2)))

    rings = members.join(leaders, F.col("candidate") == F.col("of")).drop("of").mapInPandas(placed, "words string, candidate long, leader string, shingles array<long>, place int")
    rings = stored(rings, "rings")
    found = rings.filter("place = 0 AND words <> leader").select(F.col("words").alias("u"), F.col("leader").alias("v"))
    sizes = rings.groupBy(F.col("candidate").alias("of")).agg(F.count_if(F.col("place") == 0).alias("stars"), F.count_if(F.col("place") == 1).alias("ring"), F.count_if(F.col("place") > 0).alias("rest"))
    sizes = stored(sizes.filter("rest > 0"), "ring-sizes")
    if sizes.isEmpty():
        return found
    sized = rings.join(sizes, F.col("candidate") == F.col("of")).drop("of")
    rest = _blocks_linked(sized.filter("place > 0").select("words", "candidate", "shingles", "rest"), "rest", similarity)
    order = ["candidate", "i", "j"]
    blocks = lambda n: F.ceil(F.col(n) / TEXT_BLOCK).cast("int")
    own = F.when(F.col("place") == 0, blocks("stars")).otherwise(blocks("ring"))
    other = F.when(F.col("place") == 0, blocks("ring")).otherwise(blocks("stars"))
    met = (
        sized.filter("place < 2 AND ring > 0")
        .withColumn("b", F.pmod(F.xxhash64("words"), own).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), other - 1)))
        .select("candidate", F.when(F.col("place") == 0, F.col("b")).otherwise(F.col("other")).alias("i"), F.when(F.col("place") == 0, F.col("other")).otherwise(F.col("b")).alias("j"), "place", "words", "shingles")
        .repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
        .sortWithinPartitions(*order)
    )

    def crossed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in sorted_groups(batches, order):
            stars, others = rows[rows["place"] == 0], rows[rows["place"] == 1]
            if len(stars) and len(others):
                links_ = across([np.asarray(x, "int64") for x in stars["shingles"]], [np.asarray(x, "int64") for x in others["shingles"]], similarity)
                yield pd.DataFrame({"u": [others["words"].iloc[a] for a, _ in links_], "v": [stars["words"].iloc[b] for _, b in links_]}, dtype=object)

    return found.unionByName(rest).unionByName(met.mapInPandas(crossed, LINK))


def _alike(docs: DataFrame, classes: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links (u, v) between word sequences (words, candidate, first) of one candidate group whose sets of shingles are alike."""
    # Grouped tables are stored before they are joined back, so that both sides are plain and a hot group can be split.
    sizes = stored(classes.groupBy("candidate").agg(F.count("*").alias("n"), F.min("words").alias("leader")).filter("n > 1"), "candidate-sizes")
    wanted = stored(classes.join(sizes, "candidate").select(F.col("first").alias("_first"), F.col("words").alias("_words"), "candidate", "leader", "n"), "candidates")

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [xxhash.xxh3_128_hexdigest(b" ".join((t or "").encode().lower().split())) for t in batch["text"]]
            kept = batch[np.array(own, object) == batch["words"].to_numpy(object)]
            yield kept[["words", "candidate", "leader", "n"]].assign(shingles=[shingle_set(t, shingle) for t in kept["text"]])

    def sets(only: str) -> DataFrame:
        some = wanted.filter(only)
        some = F.broadcast(some) if some.count() <= BROADCAST_ROWS else some
        texts = docs.select("doc_id", "text").join(some, F.col("doc_id") == F.col("_first")).select("text", F.col("_words").alias("words"), "candidate", "leader", "n")
        return texts.mapInPandas(sets_of, "words string, candidate long, leader string, n long, shingles array<long>")

    found = _blocks_linked(sets(f"n <= {TEXT_BLOCK}"), "n", similarity)
    if wanted.filter(F.col("n") > TEXT_BLOCK).isEmpty():
        return found
    return found.unionByName(_large_groups(stored(sets(f"n > {TEXT_BLOCK}").drop("n"), "large-groups"), similarity))


def near_duplicates(docs: DataFrame, shingle: int = 5, distance: int = 14, similarity: float | None = 0.8, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, fp (signed), fingerprint (16 hex digits), words (digest), component_id (least id reachable) and group (its component's key).

    By default five-word shingles that are at least 0.8 alike. At 0.8, 9.7 of 64 bits
    differ on average, with a standard deviation of 2.9: all texts within 14 bits meet,
    those further apart meet if they are near on some group of bits, and those that
    meet within 34 of 128 bits are verified; short texts also meet by a core. Without
    a ``similarity`` the fingerprints' links alone count. With one, documents whose
    ids are all null link only to their equals.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    fps = stored(fingerprints(docs, shingle, distinct=similarity is not None).select("doc_id", "fp", "check", "words"), "fingerprints")
    if similarity is None:
        nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")).withColumn("check", F.lit(0).cast("long")), "nodes")
        total = 2 * BITS
    else:
        nodes, total = stored(fps.select("fp", "check").distinct(), "nodes"), 2 * distance + 6
    with temporary():
        if similarity is None:
            roots = components(links(nodes, distance, total))
        else:
            roots = near_roots(nodes, distance, total, short_links(docs, shingle, similarity))
        roots = roots.withColumnRenamed("node", "fp")
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    if similarity is None:
        named = nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("group"))
        least = stored(named.groupBy("group").agg(F.min("first").alias("component_id")), "least")
        return fps.join(named.select("fp", "group").join(least, "group"), "fp").select("doc_id", "fp", shown, "words", "component_id", F.col("group").cast("string").alias("group"))
    classes = fps.groupBy("fp", "words").agg(F.min("doc_id").alias("first")).join(roots, "fp", "left")
    classes = stored(classes.select("fp", "words", "first", F.coalesce("root", "fp").alias("candidate")), "word-classes")
    with temporary():
        alike = components(_alike(docs, classes, shingle, similarity)).withColumnRenamed("node", "words")
    named = classes.join(alike, "words", "left").select("words", "first", F.coalesce("root", "words").alias("group"))
    least = stored(named.groupBy("group").agg(F.min("first").alias("component_id")), "least")
    return fps.join(named.select("words", "group").join(least, "group"), "words").select("doc_id", "fp", shown, "words", "component_id", "group")


def keep_one(docs: DataFrame, shingle: int = 5, distance: int = 14, similarity: float | None = 0.8) -> DataFrame:
    """The document of least id of each group of near-duplicates; of repeated rows of that id, one stays. Columns stay as they are.

    A group whose ids are all null keeps one of its rows.
    """
    every = stored(
        near_duplicates(docs, shingle, distance, similarity).select(F.col("doc_id").alias("__kept_id"), F.col("words").alias("__kept_of"), F.col("group").alias("__kept_group"), F.col("doc_id").eqNullSafe(F.col("component_id")).alias("__kept")),
        "kept",
    )
    removed = stored(every.filter("NOT __kept").select("__kept_id").distinct(), "removed")
    several = stored(every.groupBy("__kept_id").count().filter("count > 1 OR __kept_id IS NULL").select("__kept_id"), "several")
    known = F.broadcast(removed) if removed.count() <= BROADCAST_ROWS else removed
    at = F.col("doc_id") == F.col("__kept_id")
    single = docs.filter(F.col("doc_id").isNotNull()).join(known, at, "left_anti")
    if several.isEmpty():
        return single
    same = F.col("doc_id").eqNullSafe(F.col("__kept_id"))
    again = fingerprints(docs.join(several, same, "left_semi"), shingle, fp="__kept_fp", words="__kept_words", check="__kept_check")
    again = again.join(every.filter("__kept").distinct(), same & (F.col("__kept_words") == F.col("__kept_of")))
    rank = F.row_number().over(Window.partitionBy("doc_id", "__kept_group").orderBy(*docs.columns))
    return single.join(several, at, "left_anti").unionByName(again.withColumn("__kept_rank", rank).filter("__kept_rank = 1").select(*docs.columns))
