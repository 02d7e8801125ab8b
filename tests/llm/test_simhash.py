import os
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lexiloom.llm import simhash
from lexiloom.llm.common import shared_dir
from lexiloom.llm.components import components

SCHEMA = "doc_id long, text string, fp string, words string, _id string"


def frame(spark, texts):
    """Documents with extra columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts)], SCHEMA)


def grouped(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def slow_fingerprint(text, k):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    parts = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components_against_brute_force(spark, prose):
    found = {r.doc_id: r for r in simhash.near_duplicates(frame(spark, prose), 4, 4, None).collect()}
    prints = [slow_fingerprint(t, 4) for t in prose]
    assert [found[i].fingerprint for i in range(len(prose))] == [f"{p:016x}" for p in prints]
    assert [found[i].component_id for i in range(len(prose))] == grouped(len(prose), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)


def shingles(text, k):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def alike(a, b):
    return not (a | b) or len(a & b) >= 0.8 * len(a | b)


def test_similar_texts_against_brute_force(spark, prose):
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, prose)).collect()}
    sets = [shingles(t, 5) for t in prose]
    assert [simhash.both_prints(t, 5)[0] & (1 << 64) - 1 for t in prose] == [slow_fingerprint(t, 5) for t in prose]
    assert [found[i] for i in range(len(prose))] == grouped(len(prose), lambda i, j: alike(sets[i], sets[j]))


def test_texts_at_the_least_similarity_are_found(spark):
    """Pairs at 0.8 or just over, of many lengths, against plain Jaccard: at least 0.99 of them link, and no stranger does."""
    rng = np.random.default_rng(11)
    texts, n = [], 0
    for size in (6, 10, 15, 20, 25, 30, 40, 60, 100, 250):
        for _ in range(60):
            text = [f"w{n + k}" for k in range(size + 4)]
            n += size + 4
            cut = size - int(np.ceil(0.8 * size - 1e-9))
            texts += [" ".join(text), " ".join(text[: len(text) - cut] if rng.random() < 0.5 else text[cut:])]
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, texts)).collect()}
    sets = [shingles(t, 5) for t in texts]
    pairs = range(0, len(texts), 2)
    assert all(alike(sets[i], sets[i + 1]) for i in pairs)
    assert {found[i] for i in pairs} == set(pairs) and all(found[i + 1] in (i, i + 1) for i in pairs)
    assert sum(found[i + 1] == i for i in pairs) >= 0.99 * len(pairs)


def test_large_groups_against_brute_force(spark, monkeypatch):
    """A dense group, a ring around it and a chain that leads away, all one candidate group of several blocks."""
    monkeypatch.setattr(simhash, "TEXT_BLOCK", 16)
    rng = np.random.default_rng(12)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(90):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(1, 5)):
            words[at] = f"x{k}-{at}"
        texts.append(" ".join(words))
    for k in range(1, 40):
        texts.append(" ".join(base[5 * min(k, 20) :] + [f"y{j}" for j in range(5 * k)]))
    docs = frame(spark, texts)
    classes = docs.selectExpr("doc_id AS first", "1L AS candidate").join(simhash.fingerprints(docs.select("doc_id", "text"), 5).selectExpr("doc_id AS first", "words"), "first")
    found = simhash._alike(docs, classes, 5, 0.8)
    sets = [shingles(t, 5) for t in texts]
    want = grouped(len(texts), lambda i, j: alike(sets[i], sets[j]))
    assert 1 < len(set(want)) < len(want)
    named = {r.first: r.words for r in classes.collect()}
    at = {w: i for i, w in named.items()}
    links = {(at[r.u], at[r.v]) for r in found.collect()}
    assert all(alike(sets[i], sets[j]) for i, j in links)
    assert grouped(len(texts), lambda i, j: (i, j) in links or (j, i) in links) == want
    named = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert [named[i] for i in range(len(texts))] == want


def test_repeated_passages_and_short_texts_against_brute_force(spark):
    rng = np.random.default_rng(5)
    say = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    texts = []
    for _ in range(8):
        text, line = say(104), say(10)
        texts += [" ".join(text + line), " ".join(text + line * 12)]
    for n in range(5, 19):
        for _ in range(15):
            text = say(n)
            texts += [" ".join(text), " ".join(text[:-1]), " ".join([*text[:-1], "changed"]), " ".join(text[2:])]
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, texts)).collect()}
    sets = [shingles(t, 5) for t in texts]
    assert [found[i] for i in range(len(texts))] == grouped(len(texts), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))


def test_keep_one(spark, prose):
    df = frame(spark, prose)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {r.component_id for r in simhash.near_duplicates(df).collect()}
    assert simhash.keep_one(kept).count() == kept.count()


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "x y z"), (None, "x y z"), (None, "q r s t")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in simhash.keep_one(df).collect()) == [(0, "q r s t"), (0, "x y z"), (1, "a b c d e f g")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df, 4, 4, None).count() == simhash.near_duplicates(df).count() == simhash.keep_one(df).count() == 0


@pytest.mark.parametrize("n", [10, 10_000, 10_000_000_000])
@pytest.mark.parametrize("distance", [0, 1, 4, 8, 11, 14])
def test_thresholds_cover_every_pair(n, distance):
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (500, 64)).astype(float)
    plan = simhash.allocate(bits.T @ bits * n / 500, n, distance)
    assert sum(t + 1 for _, t in plan) == distance + 1
    assert len({b for g, _ in plan for b in g}) == sum(len(g) for g, _ in plan)


def test_links_of_a_dense_ball_span_it(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62)
    prints = {int(base) ^ sum(1 << int(b) for b in rng.choice(10, rng.integers(0, 3), replace=False)) for _ in range(300)} | {int(x) for x in rng.integers(0, 1 << 62, 300)}
    prints = sorted(prints)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    nodes = spark.createDataFrame([(p, 0) for p in prints], "fp long, check long")
    links = simhash.links(nodes, 4)
    roots = {r.node: r.root for r in components(links).collect()}
    want = grouped(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert [roots.get(p, p) for p in prints] == [prints[w] for w in want]
    assert all((r.u ^ r.v).bit_count() <= 4 for r in links.collect())


def test_a_dense_group_is_linked_once(spark, monkeypatch):
    """Fingerprints of one group meet at many values; what is joined is not linked again at each of them."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2, 128)
    near = [np.where(rng.random(128) < 0.06, 1 - base, base) for _ in range(400)] + list(rng.integers(0, 2, (200, 128)))
    prints = np.packbits(np.array(near, np.uint8), axis=1).view(">i8").tolist()
    prints += [[prints[0][0], prints[1][1]]]  # one fingerprint with other check bits
    nodes = spark.createDataFrame(prints, "fp long, check long")
    joined = []
    monkeypatch.setattr(simhash, "components", lambda links: joined.append(links.distinct().count()) or components(links))
    none = spark.createDataFrame([], "u long, v long")
    linked = simhash.links(nodes, 14, 34).distinct().collect()
    fps = sorted({p for p, _ in prints})
    pairs = {(r.u, r.v) for r in linked} | {(r.v, r.u) for r in linked}
    want = [fps[w] for w in grouped(len(fps), lambda i, j: (fps[i], fps[j]) in pairs)]
    assert len(set(want)) < 250
    for block in (simhash.BLOCK, 16):
        monkeypatch.setattr(simhash, "BLOCK", block)
        joined.clear()
        rows = simhash.near_roots(nodes, 14, 34, none).collect()
        roots = {r.node: r.root for r in rows}
        assert len(roots) == len(rows) and [roots.get(p, p) for p in fps] == want
        assert 2 * sum(joined) < len(linked) or block == 16
    with_more = spark.createDataFrame([(prints[-2][0], prints[0][0])], "u long, v long")
    roots = {r.node: r.root for r in simhash.near_roots(nodes, 14, 34, with_more).collect()}
    assert roots.get(prints[-2][0], prints[-2][0]) == roots.get(prints[0][0], prints[0][0])


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(1, 300)] + [(7, 7), (None, 3), (900, 901), (901, 900)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert {roots[i] for i in range(101)} == {0} and {roots[500 + i] for i in range(300)} == {500} and roots[901] == roots[900] == 900
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("spread", [2, 12, 40])
def test_pairs_of_a_large_bucket(spread):
    rng = np.random.default_rng(4)
    x = np.unique(np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, spread), replace=False)) for _ in range(700)], dtype=np.uint64))
    a, b = simhash.near_pairs(np.stack([x, x], axis=1), 4)
    assert (np.bitwise_count(x[a] ^ x[b]) <= 4).all() and not (a == b).any()
    pairs = set(zip(a.tolist(), b.tolist(), strict=True))
    assert grouped(len(x), lambda i, j: (i, j) in pairs or (j, i) in pairs) == grouped(len(x), lambda i, j: int(x[i] ^ x[j]).bit_count() <= 4)


def test_jaccard_forest_accounts_for_every_pair():
    rng = np.random.default_rng(3)
    base = [np.sort(rng.choice(10_000, 50, replace=False)) for _ in range(5)]
    sets = [np.unique(np.concatenate([b[: 50 - d], rng.choice(10_000, d)])) for b in base for d in (0, 1, 2, 3, 8, 20)] + [np.zeros(0, int)] * 2
    left, right = simhash.jaccard_forest(sets, 0.8)
    alike = lambda a, b: not len(a) + len(b) or len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
    assert all(alike(sets[i], sets[j]) for i, j in zip(left, right, strict=True))
    want = grouped(len(sets), lambda i, j: alike(sets[i], sets[j]))
    pairs = set(zip(left, right, strict=True))
    assert grouped(len(sets), lambda i, j: (i, j) in pairs or (j, i) in pairs) == want


def test_hashing_matches_the_engine(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] == np.int64(np.uint64(xxhash.xxh64_intdigest(b"a b c d", 42)).astype(np.int64))


def test_tables_on_the_way_are_removed(spark, prose):
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    out = simhash.near_duplicates(frame(spark, prose))
    left = {m[1] for name in set(os.listdir(folder)) - before if (m := re.fullmatch("([a-z-]+)-[0-9a-f]{32}", name))}
    assert left == {"fingerprints", "nodes", "word-classes", "least"} and out.count() == len(prose)
