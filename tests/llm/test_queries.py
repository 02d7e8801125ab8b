"""The registered queries as they are, over a whole small scale: contract columns, brute force, and nothing learned from what is held out."""

import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from lexiloom.llm import bpe, html_text, langid, ogg, queries, simhash, toxicity
from tests.llm.test_simhash import grouped, slow_fingerprint

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


def kept_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def test_op1_against_brute_force(spark, documents):
    found = {r.doc_id: r for r in queries.op1_simhash(spark, DATA).collect()}
    ids = sorted(documents)
    prints = [slow_fingerprint(documents[i].text, 4) for i in ids]
    roots = grouped(len(ids), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert [(found[i].fingerprint, found[i].component_id) for i in ids] == [(f"{p:016x}", ids[r]) for p, r in zip(prints, roots, strict=True)]


def test_op2_against_wrappers_of_all_pages_of_a_host(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    hosts = {}
    for p in pages:
        hosts.setdefault(p.url.split("://", 1)[1].split("/")[0].lower(), []).append(p.html)
    wrappers = {h: html_text.infer(sorted(set(x))) for h, x in hosts.items()}
    found = {r.page_id: r for r in queries.op2_html(spark, DATA).collect()}
    for p in pages:
        text = html_text.main_text(p.html, wrappers[p.url.split("://", 1)[1].split("/")[0].lower()])
        r = found[p.page_id]
        assert (r.url, r.text, r.n_chars) == (p.url, text, len(text)) and text


def test_op3_against_the_library(spark, documents):
    ranks = bpe.load_ranks(public_tokenizers.path(queries.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in queries.op3_bpe(spark, DATA).collect():
        text = documents[r.doc_id].text or ""
        ids = library.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_op4_against_the_payload(spark, documents):
    for r in queries.op4_ogg(spark, DATA).collect():
        raw = (documents[r.doc_id].text or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or 576 * (not raw))
        media = ogg.write(documents[r.doc_id].text)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())


def test_op6_and_op9_learn_nothing_from_what_is_held_out(spark, tmp_path):
    """Languages and labels of held-out rows, and the columns that are no inputs, can be anything."""
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    out = queries.held_out(F.col("doc_id"))
    docs.withColumn("lang", F.when(out, "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic"))).write.parquet(f"{tmp_path}/labels.parquet")
    for query in (queries.op6_langid, queries.op9_toxicity):
        told, changed = (sorted(map(tuple, query(spark, at).collect())) for at in (DATA, str(tmp_path)))
        assert told == changed and all(r[1] == kept_out(r[0]) for r in told)


def test_op6_is_right_on_what_is_held_out(spark, documents):
    found = [r for r in queries.op6_langid(spark, DATA).collect() if r.held_out]
    assert sum(r.lang_pred == documents[r.doc_id].lang for r in found) >= 0.95 * len(found) and all(0 <= r.score <= 1 for r in found)


def test_op8_against_brute_force(spark):
    rows = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect())
    x = np.array([np.asarray(v, np.float32) for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    roots = grouped(len(rows), lambda a, b: near[a, b])
    found = {r.vec_id: r for r in queries.op8_embed_dedup(spark, DATA).collect()}
    for k, (i, _) in enumerate(rows):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (near[k].sum(), rows[roots[k]][0], roots[k] == k)


def test_op9_returns_scores_and_offsets(spark, documents):
    for r in queries.op9_toxicity(spark, DATA).collect():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        spans = [tuple(map(int, s.split("-"))) for s in r.offsets.split()]
        assert len(spans) == r.n_spans and all(0 <= a < b <= len(documents[r.doc_id].text or "") for a, b in spans)


def test_languages_against_exact_sets():
    """The filter's prediction against the languages' n-grams held as plain sets, where nothing is a false positive."""
    rng = random.Random(4)
    sounds = {"xx": ["ka", "to", "mi", "ra", "shu"], "yy": ["sch", "ung", "ein", "ber", "ka"], "zz": ["ció", "que", "los", "ñ", "to"]}
    said = lambda k, n: " ".join("".join(rng.choices(sounds[k], k=rng.randint(1, 4))) for _ in range(n))
    windows = lambda t: [w for w in (("  " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " ")[i : i + 4] for i in range(len(t) + 8)) if len(w) == 4 and w[1:].strip()]
    grams = lambda t: np.concatenate([x for x, _ in langid.grams(*langid.spelled([t]))] or [np.zeros(0, np.uint64)])
    names = sorted(sounds)
    texts = {k: [said(k, 30) for _ in range(20)] for k in names}
    held = {k: {w for t in texts[k] for w in windows(t)} for k in names}
    model = langid.Filter.build(names, [np.unique(np.concatenate([grams(t) for t in texts[k]])) for k in names], "xx")
    asked = [said(k, rng.randint(1, 12)) for k in names for _ in range(60)]
    found, _, cover = model.predict(asked)
    for t, name, share in zip(asked, found, cover, strict=True):
        own = windows(t)
        shares = {k: sum(w in held[k] for w in own) / len(own) for k in names}
        assert abs(shares[name] - share) < 0.12
        assert shares[name] >= max(shares.values()) - 0.12


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, _lang string, _toxic string, _found int")
    media = docs.select("doc_id", ogg.write_column(F.col("text")).alias("media")).select("doc_id", ogg.read_column(F.col("media")).alias("m"))
    assert media.count() == 0
    model = langid.fit(docs.select("text", "lang", F.col("doc_id").alias("key")))
    named = langid.identify(docs, model)
    assert named.count() == 0 and set(docs.columns) < set(named.columns)
    field = toxicity.fit(docs.select("doc_id", "text"), spark.createDataFrame([], "doc_id long, toxic int"))
    scored = toxicity.score(docs, field)
    assert scored.count() == 0 and set(docs.columns) < set(scored.columns)


def test_columns_of_clashing_names_pass_through(spark):
    df = spark.createDataFrame([(1, "some text here", "a", "b", "c", "d", "e")], "doc_id long, text string, _lang string, _toxic string, _digests string, _print string, _found string")
    path = public_tokenizers.path(queries.VOCABULARY)
    field = toxicity.fit(df.limit(0).select("doc_id", "text"), df.limit(0).select("doc_id", F.lit(1).alias("toxic")))
    for found in (langid.identify(df, langid.Filter([], np.zeros((1, 1024), np.uint8), np.zeros(0), "und")), toxicity.score(df, field), bpe.digests(df, path, public_tokenizers.PATTERN), simhash.fingerprints(df, 4)):
        r = found.first()
        assert (r["_lang"], r["_toxic"], r["_digests"], r["_print"], r["_found"]) == ("a", "b", "c", "d", "e")
