"""URL rules, mixing, embeddings, chat formatting, the queries with SQL and the pipeline."""

import hashlib
import math
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from lexiloom.llm import chat, embed_dedup, mixing, queries, simhash, url_rules

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in os.listdir(DATA):
        con.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{table}'")
    said = con.execute(queries.ORACLES[name])
    names = [c[0] for c in said.description]
    df = queries.QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, said.fetchall()))


@needs_data
def test_registered_under_the_contract_names():
    found = entry.queries()
    assert "pipeline" in found and all(sum(q.startswith(f"op{n}_") for q in found) == 1 for n in range(1, 11))


def slow_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fit = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_url_rules_against_brute_force(spark):
    rng = random.Random(1)
    rules = [*queries.URL_RULES, ("b.com", "", "allow"), ("b.com", "", "block"), ("x.b.com", "/ab", "allow")]
    hosts, paths = ["example.com", "EXAMPLE.net", "a.b.com", "x.b.com", "b.com", "xb.com", "com", "org", "a..com", ""], ["", "/", "/en/", "/en/7", "/en/77?x", "/de/8#y", "/es/", "/ab/c", "?/en/", "#/en/"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(200)] + [None, "", "no scheme", "http://", "x://y://z/en/", "http://a.com/" + "p" * 5000]
    df = spark.createDataFrame([(u, 1, "h", "r", "q") for u in urls], "url string, hit int, host string, _h string, rule string")
    found = url_rules.judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert sorted(found.columns) == ["_h", "hit", "host", "path", "rule", "url", "verdict"] and found.count() == len(urls)
    for r in found.collect():
        assert (r.host, r.path, r.rule, r.verdict) == slow_verdict(r.url, rules), r.url
    none = url_rules.judge_urls(df, spark.createDataFrame([], "host string, path string, verdict string"))
    assert {(r.rule, r.verdict) for r in none.collect()} == {(None, "allow")}
    assert url_rules.judge_urls(df.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


def test_op5_judges_by_the_rules_of_the_contract(spark, tmp_path):
    """The words are written out here, so that the query, its SQL and the brute force cannot share a wrong one."""
    said = {"http://a.com/en/1": "block", "http://example.com/en/70": "allow", "http://a.net/de/1": "allow", "http://net/de/": "allow", "http://www.example.net/de/8": "block", "http://example.net/de/7": "allow", "http://a.org/es/1": "block", "http://a.org/en/1": "allow", "none": "allow"}
    spark.createDataFrame(list(enumerate(said)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.page_id: r.verdict for r in queries.op5_url_rules(spark, str(tmp_path)).collect()} == dict(enumerate(said.values()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert dict(con.execute(f"SELECT page_id, verdict FROM ({queries.ORACLES['op5_url_rules']})").fetchall()) == dict(enumerate(said.values()))


def test_a_very_common_url(spark):
    urls = ["http://example.com/en/7"] * 3000 + [None] * 500 + [f"http://h{i}.org/es/{i}" for i in range(40)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string").repartition(9)
    found = url_rules.judge_urls(df, spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string"))
    assert sorted((r.page_id, r.rule, r.verdict) for r in found.collect()) == sorted((i, *slow_verdict(u, queries.URL_RULES)[2:]) for i, u in enumerate(urls))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan  # what is joined back to the rows is a written table


def mixing_docs(spark, sizes, tokens=lambda i: 5 + i % 7):
    rows = [(f"{s}-{i}", s if s != "null" else None, " ".join(["w"] * tokens(i)), 1, 2) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id string, source string, text string, passes int, row int")


def test_mixing_meets_budgets(spark):
    df = mixing_docs(spark, {"big": 600, "mid": 150, "small": 30, "null": 20})
    mix = mixing.Mix(entropy_share=0.9, max_repeats=3.0, block_docs=20)
    out = mixing.mixed(df, mix).withColumn("t", mixing.tokens_of(F.col("text")))
    assert out.columns[:5] == df.columns
    total = {r.source: r.t for r in df.groupBy("source").agg(F.sum(mixing.tokens_of(F.col("text"))).alias("t")).collect()}
    drawn = {r.source: r.t for r in out.groupBy("source").agg(F.sum("t").alias("t")).collect()}
    whole = sum(total.values())
    p = {s: t / whole for s, t in total.items()}

    def weights(a):
        z = sum(x**a for x in p.values())
        return {s: x**a / z for s, x in p.items()}

    entropy = lambda a: -sum(w * math.log(w) for w in weights(a).values())
    repeats = lambda a: max(weights(a)[s] / p[s] for s in p)
    a = max(x / 10_000 for x in range(10_001) if entropy(x / 10_000) >= 0.9 * math.log(4))
    if repeats(a) > 3:
        a = min(x / 10_000 for x in range(10_001) if repeats(x / 10_000) <= 3)
    for s, w in weights(a).items():
        assert -2 <= w * whole - drawn[s] <= 13  # the exponents tried here are 1e-4 apart; a document has up to 11 tokens
    for r in out.groupBy("doc_id", "epoch").count().collect():
        assert r["count"] == 1
    times = out.groupBy("source", "doc_id").count().groupBy("source").agg(F.min("count").alias("a"), F.max("count").alias("b")).collect()
    assert all(r.b - r.a <= 1 for r in times)
    again = mixing.mixed(df.repartition(7), mix)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, out.drop("t").collect()))


@pytest.mark.parametrize("broadcast", [True, False])
def test_mixing_takes_blocks_in_order(spark, monkeypatch, broadcast):
    """Whole blocks of a source in hash order while they fit, then documents of the next one, by plain sums."""
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 10 if broadcast else 0)
    df = mixing_docs(spark, {"big": 900, "mid": 200, "small": 40, "null": 25})
    mix = mixing.Mix(entropy_share=0.97, max_repeats=2.5, block_docs=10)
    out = mixing.mixed(df, mix).collect()
    md5 = lambda *x: hashlib.md5("|".join(map(str, x)).encode()).hexdigest()
    times, block_of, tokens = {}, {}, {r.doc_id: len(r.text.split()) for r in df.collect()}
    for r in out:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
        block_of[r.doc_id] = r.block
    for source in ("big", "mid", "small", "null"):
        docs = [d for d in tokens if d.rsplit("-", 1)[0] == source]
        h = {d: md5("mix", d, hashlib.md5(" ".join(["w"] * tokens[d]).encode()).hexdigest()) for d in docs}
        passes, key = min(times.get(d, 0) for d in docs), "n" if source == "null" else f"s{source}"
        if max(times.get(d, 0) for d in docs) == passes:
            continue
        blocks = {}
        for d in docs:
            blocks.setdefault(h[d][:2], []).append(d)
            assert block_of.get(d, h[d][:2]) == h[d][:2]
        rest = sum(tokens[d] for d in docs if times.get(d, 0) > passes)
        order = sorted(blocks, key=lambda b: (md5("mix", "block", passes, key, b), b))
        whole = [b for b in order if all(times.get(d, 0) > passes for d in blocks[b])]
        assert whole == order[: len(whole)]
        partly = [b for b in order if b not in whole and any(times.get(d, 0) > passes for d in blocks[b])]
        assert partly in ([], [order[len(whole)]])
        for b in partly:
            drawn = [times[d] > passes if d in times else False for d in sorted(blocks[b], key=lambda d: (md5("mix", "doc", passes, h[d]), h[d]))]
            assert drawn == sorted(drawn, reverse=True)
        assert rest > 0


def test_mixing_edges(spark):
    assert mixing.mixed(mixing_docs(spark, {"a": 3}).limit(0)).count() == 0
    assert mixing.mixed(mixing_docs(spark, {"a": 3, "b": 2}, lambda i: 0)).count() == 5
    assert mixing.mixed(mixing_docs(spark, {"a": 3})).count() == 3
    odd = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "a", "x y"), (None, "b", "x"), (None, "b", "x")], "doc_id int, source string, text string")
    assert mixing.mixed(odd, mixing.Mix(entropy_share=0.0)).count() == 5


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 24))
    near = [b + rng.standard_normal(24) * s for b in base[:10] for s in (0.02, 0.1, 0.2, 0.3)]
    vectors = [list(map(float, v)) for v in [*base, *near, base[0], base[0], base[1] * 3]]
    bad = [None, [], [0.0] * 24, [math.nan] * 24, [math.inf] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0], [5.0]]
    rows = [(i, v, "x") for i, v in enumerate([*vectors, *bad])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cls string")
    x = [np.array([np.float32(np.nan if c is None else c) for c in v], np.float64) if v else None for _, v, _ in rows]
    ok = [v is not None and np.isfinite(v).all() and v.any() for v in x]
    unit = [v / np.linalg.norm(v) if o else None for v, o in zip(x, ok, strict=True)]
    n = len(rows)
    linked = lambda i, j: i != j and ok[i] and ok[j] and len(x[i]) == len(x[j]) and unit[i] @ unit[j] >= 0.95
    root = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in range(n):
                if linked(i, j) and root[j] < root[i]:
                    root[i] = root[j]
    found = {r.vec_id: r for r in embed_dedup.near_duplicates(df).collect()}
    for i in range(n):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (sum(linked(i, j) for j in range(n)), root[i], root[i] == i), i
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_double_embeddings_stay_doubles(spark):
    a = [1.0, 0.0, 1e-300]
    b = [1.0, math.tan(math.acos(0.95)) * (1 + 1e-12), 0.0]  # just under the least cosine in doubles, at it in floats
    c = [1.0, math.tan(math.acos(0.95)) * (1 - 1e-12), 0.0]
    tiny = [1e-200, 0.0, 0.0]
    df = spark.createDataFrame(list(enumerate([a, b, c, tiny])), "vec_id long, embedding array<double>")
    assert {r.vec_id: r.n_links for r in embed_dedup.near_duplicates(df).collect()} == {0: 2, 1: 1, 2: 3, 3: 2}


def test_large_groups_of_embeddings_are_dealt_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(16)
    vectors = [list(map(float, centre + rng.standard_normal(16) * 0.02)) for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    assert {(r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df).collect()} == {(99, 0)}


def test_rotations_keep_lengths():
    x = np.random.default_rng(1).standard_normal((5, 64))
    assert np.allclose(np.linalg.norm(embed_dedup.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert embed_dedup.buckets(x / 9, 0, 3).shape == (5, embed_dedup.PROBES + 1)


TURNS = [
    (1, 0, "system", "be <nice> & [kind]"), (1, 1, "user", "</s>[INST] hi"), (1, 2, "assistant", "&l &amp; ok]"), (1, 3, "user", "more"), (1, 4, "assistant", ""), (1, 5, "user", "end"),
    (2, 0, "user", None), (2, 1, None, "who"), (3, 0, "assistant", "a\nb"), (3, 0, "assistant", "a\nb"), (None, 1, "user", "x"), (None, 0, "assistant", "y"), (None, None, "assistant", "first"),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*t, "z", 1) for t in TURNS], "conv_id long, turn long, role string, text string, piece string, position int")
    turns = chat.render_turns(df)
    found = {r.conv_id: r for r in chat.read_back(turns, chat.expand_targets(turns)).collect()}
    groups = {}
    for c, t, r, x in TURNS:
        groups.setdefault(c, []).append(((-1 if t is None else t), r or "", x or ""))
    assert set(found) == set(groups)
    for c, own in groups.items():
        own.sort()
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert found[c].n_turns == len(own) and found[c].loss_chars == len(loss)
        assert found[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert found[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    empty = chat.render_turns(df.limit(0))
    assert chat.read_back(empty, chat.expand_targets(empty)).count() == 0


def test_chat_contexts_are_read_back(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    turns = chat.render_turns(df)
    right = {r.conv_id: r.contexts_sha256 for r in chat.read_back(turns, chat.expand_targets(turns)).collect()}
    pieces = {}
    for r in sorted(turns.collect(), key=lambda r: r.position):
        pieces.setdefault(r.conv_id, []).append((r.piece, r.trainable))
    for c, own in pieces.items():
        said, last = "", max((k for k, (_, t) in enumerate(own) if t), default=-1)
        for k, (piece, trainable) in enumerate(own[: last + 1]):
            said += (f"|{sum(len(p) for p, _ in own[:k])}|" if trainable else "") + (piece if k < last else "")
        assert right[c] == hashlib.sha256(said.encode()).hexdigest()
    for wrong in ("context_turns", "context_chars"):
        examples = chat.expand_targets(turns).withColumn(wrong, F.greatest(F.col(wrong) - 1, F.lit(0)))
        found = {r.conv_id: r.contexts_sha256 for r in chat.read_back(turns, examples).collect()}
        assert found[1] != right[1] and found[2] == right[2]


def test_chat_targets_are_expanded_with_their_prefix(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    turns = chat.render_turns(df)
    pieces = {}
    for r in sorted(turns.collect(), key=lambda r: r.position):
        pieces.setdefault(r.conv_id, []).append(r.piece)
    examples = chat.expand_targets(turns)
    made = examples.collect()
    assert len(made) == sum(r == "assistant" for _, _, r, _ in TURNS)
    assert all(r.context == "".join(pieces[r.conv_id][: r.position - 1]) and r.context_chars == len(r.context) for r in made)
    right = {r.conv_id: r.contexts_sha256 for r in chat.read_back(turns, examples).collect()}
    # A wrong character at any place of the last prefix shows, also where the example before it has the right one.
    last = max((r for r in made if r.conv_id == 1), key=lambda r: r.position)
    for at in (0, last.known_chars, last.context_chars - 1):
        wrong = F.overlay("context", F.lit("\x01"), F.lit(at + 1), F.lit(1))
        changed = examples.withColumn("context", F.when((F.col("conv_id") == 1) & (F.col("position") == last.position), wrong).otherwise(F.col("context")))
        found = {r.conv_id: r.contexts_sha256 for r in chat.read_back(turns, changed).collect()}
        assert found[1] != right[1] and found[3] == right[3]


def test_chat_examples_hold_their_prefix(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    turns = chat.render_turns(df)
    pieces = {}
    for r in sorted(turns.collect(), key=lambda r: r.position):
        pieces.setdefault(r.conv_id, []).append(r.piece)
    made = chat.materialise(turns).collect()
    assert len(made) == sum(r == "assistant" for _, _, r, _ in TURNS)
    for r in made:
        assert r.text == "".join(pieces[r.conv_id][: r.position])
        assert r.text[r.mask_start + r.mask_chars :] == chat.END and "</s>" not in r.text[r.mask_start : r.mask_start + r.mask_chars]


@needs_data
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, kept, DATA)
        assert after.columns == names
        before = {r.doc_id: tuple(r) for r in kept.collect()}
        rows = after.collect()
        assert all(before[r.doc_id] == tuple(r) for r in rows) and len({r.doc_id for r in rows}) == len(rows)
        if name == "simhash_near_dedup":
            assert {r.doc_id for r in rows} == {r.component_id for r in simhash.near_duplicates(kept).collect()}
        kept = after
    drawn = corpus_pipeline.STAGES[3][1](spark, kept, DATA)
    assert drawn.columns == names and {r.doc_id for r in drawn.collect()} <= {r.doc_id for r in kept.collect()}
    final = corpus_pipeline.STAGES[4][1](spark, drawn, DATA)
    assert final.count() == drawn.count()
    assert sorted(map(repr, corpus_pipeline.run(spark, DATA).collect())) == sorted(map(repr, final.collect()))


def test_pipeline_rejects_only_what_it_should(spark):
    said = [(1, "the cat sat on the mat", "en", "s", 1), (2, None, "en", "s", 0), (3, "123 456", "en", "s", 7), (4, "the cat ate the rat", "en", "s", 1), (5, "日本語", None, None, 3)]
    docs = spark.createDataFrame(said, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.language(spark, docs, DATA).collect()} == {1, 4}


def test_pipeline_stages_take_nulls_repeats_and_clashing_names(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(200)]
    texts = [" ".join(rng.choices(words, k=rng.randint(20, 60))) for _ in range(30)] + [None, "", "  ", "the", "the", "日本語", "the word " * 20_000]
    rows = [(None if i % 11 == 0 else i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", None, "a", "b", "c", "d", None) for i, t in enumerate([*texts, *texts[:4]])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, lang_pred string, score string, words string, _found int"
    docs = spark.createDataFrame(rows, schema)
    told = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, DATA)
            if name != "byte_level_bpe":
                assert out.columns == docs.columns
                assert {tuple(r) for r in out.collect()} <= told
            assert table is docs or out.count() == 0
    kept = corpus_pipeline.STAGES[2][1](spark, docs, DATA)
    same = lambda f: f.select("text").distinct().count()
    assert same(kept) == kept.select(F.coalesce(F.trim("text"), F.lit(""))).distinct().count()


@needs_data
def test_pipeline_stages_against_plain_forms(spark):
    """Toxicity by the operator's own scores, and the mix by its SQL, over what the stages before kept."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    scores = {r.doc_id: r.predicted for r in queries.op9_toxicity(spark, DATA).collect()}
    assert {r.doc_id for r in corpus_pipeline.STAGES[1][1](spark, docs, DATA).collect()} == {i for i, p in scores.items() if not p}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = con.execute("WITH RECURSIVE " + queries.mixing_sql("documents", "doc_id, source").lstrip()).fetchall()
    found = corpus_pipeline.STAGES[3][1](spark, docs, DATA).select("doc_id", "source").collect()
    assert sorted(map(tuple, found)) == sorted(want)


@pytest.mark.parametrize("sizes", [[2] * 40, [1, 3, 16, 17, 1, 60, 2], [1], [200]])
def test_links_of_buckets_span_what_is_near(sizes):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.standard_normal((1, 6)) + rng.standard_normal((n, 6)) * rng.choice([0.1, 0.3, 1.0], (n, 1)) for n in sizes])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    keys = np.repeat(np.arange(len(sizes)) * 7, sizes)[:, None]
    a, b = embed_dedup.bucket_links(x, keys, 0.95)
    near = (x @ x.T >= 0.95) & (keys == keys.T)
    assert all(near[i, j] and i != j for i, j in zip(a, b, strict=True))

    def roots(linked):
        root = np.arange(len(x))
        for _ in x:
            for i, j in linked:
                root[[i, j]] = min(root[i], root[j])
        return root.tolist()

    assert roots(list(zip(a, b, strict=True))) == roots(list(zip(*np.nonzero(near), strict=True)))
