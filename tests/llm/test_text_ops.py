"""HTML extraction, byte-level BPE, Ogg media, language ID and toxicity."""

import hashlib
import math
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.llm import bpe, html_text, langid, ogg, toxicity

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
CODEC = bpe.Codec(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("ab é\n's0日", max_size=200))
def test_bpe_matches_the_library(text):
    ids = CODEC.encode(text)
    assert ids == LIBRARY.encode_ordinary(text) and CODEC.decode(ids) == text.encode()


@pytest.mark.parametrize("most", [2, 4, 7, 16, 33, 64])
def test_bpe_of_many_matches_at_once(most):
    rng = random.Random(most)
    words = [w.encode() for w in ("the", " hello", "über", "日本語", "aaaa", "zq", "ing", "tion", " a", "\n\n", "0123")]
    pieces = [(b"".join(rng.choices(words, k=8)) + rng.randbytes(2 * most))[rng.randint(0, 6) :][: rng.randint(max(2, most // 2 + 1), most)] for _ in range(700)] + [b"a" * most] * 40
    pieces = [x for x in pieces if (len(x) - 1).bit_length() == (most - 1).bit_length()]
    assert CODEC.has_all_bytes() and len(pieces) > 60
    assert bpe.merge_many(pieces, CODEC.pairs, CODEC.single) == [tuple(plain_merge(x)) for x in pieces]
    assert all(bpe.merge(x, RANKS) == plain_merge(x) for x in pieces if x not in RANKS)


def plain_merge(piece):
    """The definition: of all pairs that make a token, the leftmost of least rank is merged, until none does."""
    parts = [bytes([x]) for x in piece]
    while True:
        found = [(RANKS[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in RANKS]
        if not found:
            return [RANKS[p] for p in parts]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_bpe_of_many_texts_matches_the_library():
    rng = random.Random(1)
    said = lambda: " ".join("".join(rng.choices(["ka", "sch", "é", "x", "tion", "日", "'s", "12", "\n", "  "], k=rng.randint(1, 12))) for _ in range(rng.randint(0, 60)))
    texts = [said() for _ in range(300)] + ["", None, "ab" * 5000]
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    want = [LIBRARY.encode_ordinary(t or "") for t in texts]
    assert codec.encode_many(texts) == want == [codec.encode(t) for t in texts]
    assert not any(len(m) > 64 for m in codec.known)


class Counted(str):
    """Counts how often a match's place in a table is worked out."""

    __slots__ = ()
    hashed = 0

    def __hash__(self):
        Counted.hashed += 1
        return super().__hash__()


def test_bpe_looks_up_each_match_once():
    codec, text = bpe.Codec(RANKS, public_tokenizers.PATTERN), "katschion schkax, über 12 " * 400
    matches = codec.pattern.findall(text)

    class Pattern:
        def findall(self, text):
            return [Counted(m) for m in matches]

    codec.pattern, Counted.hashed = Pattern(), 0
    assert codec.encode_many([text]) == [LIBRARY.encode_ordinary(text)]
    assert len(matches) <= Counted.hashed <= len(matches) + 5 * len(set(matches))


def test_bpe_tables_that_fill_up_and_texts_that_fail(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 40)
    monkeypatch.setattr(bpe, "TEXTS_AT_ONCE", 300)
    monkeypatch.setattr(bpe, "RUNS_AT_ONCE", 7)
    rng = random.Random(2)
    words = ["".join(rng.choices(["ka", "sch", "é", "日", "tion", "x"], k=rng.randint(1, 9))) for _ in range(120)] + ["ab" * 60, "日x" * 40]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(200)]
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for _ in range(2):
        assert codec.encode_many(texts) == [LIBRARY.encode_ordinary(t) for t in texts]
        assert [bytes(raw) for some in codec.encoded(texts) for raw in codec.decoded(*some)] == [t.encode() for t in texts]
        assert len(codec.known) < 120 and not any(len(m) > 64 for m in codec.known)
        with pytest.raises(UnicodeEncodeError):
            codec.encode("neverseen \ud800 neither")


def test_bpe_of_vocabularies_with_large_ids_or_without_some_bytes():
    texts = ["abab ba aab bb " * 20, "", "a"] + [f"{a}{b}{a}{a}{b}" for a in ("ab", "ba", "aa") for b in ("b", "aab", "ba")]
    ranks = {b"a": 0, b"b": 1, b" ": 2, b"ab": 3, b"aa": 4, b" a": 5, b"aba": 7}
    codec, large = bpe.Codec(ranks, public_tokenizers.PATTERN), bpe.Codec({x: r << 28 for x, r in ranks.items()}, public_tokenizers.PATTERN)
    want = [[i for m in codec.pattern.findall(t) for i in bpe.merge(m.encode(), ranks)] for t in texts]
    assert codec.encode_many(texts) == want and large.encode_many(texts) == [[i << 28 for i in x] for x in want]
    for c in (codec, large):
        assert [bytes(raw) for some in c.encoded(texts) for raw in c.decoded(*some)] == [t.encode() for t in texts]
        with pytest.raises(KeyError):
            c.encode("abc")
        assert c.encode_many(texts[-1:]) == c.encode_many(texts)[-1:]


def test_bpe_of_one_very_long_match():
    text = "ab" * 20_000
    assert CODEC.encode(text) == LIBRARY.encode_ordinary(text)


def test_bpe_on_frames(spark):
    path, texts = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), ["Hello, world", None, "", "<|endoftext|>", "Hello, world"]
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id int, text string, n_tokens int")
    back = bpe.decode(bpe.encode(df, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN).collect()
    assert [bytes(r.decoded) for r in back] == [(t or "").encode() for t in texts]
    assert [r.ids for r in back] == [LIBRARY.encode_ordinary(t or "") for t in texts]
    for r in bpe.digests(df, path, public_tokenizers.PATTERN).collect():
        ids = LIBRARY.encode_ordinary(r.text or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.digests(df.limit(0), path, public_tokenizers.PATTERN).count() == 0


def slow_checksum(data):
    crc = 0
    for x in data:
        crc ^= x << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if crc >> 31 else crc << 1
    return crc


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=80))
def test_ogg_checksum(data):
    assert ogg.page_checksum(data) == slow_checksum(data)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 5), st.lists(st.binary(max_size=600) | st.integers(0, 70_000).map(lambda n: b"x" * n), min_size=1, max_size=5), min_size=1, max_size=3))
def test_ogg_streams_round_trip(streams):
    media = ogg.mux({k: [(p, i) for i, p in enumerate(v)] for k, v in streams.items()})
    assert {k: [p for p, _ in v] for k, v in ogg.demux(media).items()} == streams


def test_ogg_notices_damage():
    media = bytearray(ogg.write("some text " * 1000))
    for at in (3, 40, len(media) // 2, len(media) - 1):
        damaged = media.copy()
        damaged[at] ^= 1
        with pytest.raises(ValueError):
            ogg.demux(bytes(damaged))
    with pytest.raises(ValueError):
        ogg.demux(bytes(media[:-9]))


def test_ogg_on_frames(spark):
    texts = ["abc", None, "", "é" * 700, "x" * 576, "abc", "long " * 40_000]
    df = spark.createDataFrame([(i, t, b"z") for i, t in enumerate(texts)], "doc_id int, text string, media binary")
    rows = df.select("doc_id", ogg.write_column(F.col("text")).alias("media")).select("doc_id", "media", ogg.read_column(F.col("media")).alias("m")).orderBy("doc_id").collect()
    for t, r in zip(texts, rows, strict=True):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or 576 * (not raw))
        assert (r.m.n_bytes, r.m.payload_bytes, r.m.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.m.tail_crc32 == zlib.crc32(payload[-32:]) and r.m.media_sha256 == hashlib.sha256(r.media).hexdigest()
        assert f"seconds={len(payload) / 8000:.6f}" in r.m.feature
    assert rows[0].media == rows[5].media and struct.unpack_from("<4s", rows[0].media)[0] == b"OggS"
    nothing = spark.createDataFrame([(None,)], "media binary").select(ogg.read_column(F.col("media")).alias("m")).first()
    assert nothing.m is None or nothing.m.n_bytes is None


def page(title, paragraphs, menu="Home"):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f'<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href=/>{menu}</a></ul></nav><!-- x --><div class="ad">buy</div><article><h1>{title}</h1>{body}</article><div class="comments"><p>first!</p></div><footer>&copy; me</footer></body></html>'


def test_html_article():
    pages = [page(f"T{i}", [f"para {i} &amp; more", "  two \n lines "] * (i + 1)) for i in range(4)]
    wrapper = html_text.infer(pages)
    for i, p in enumerate(pages):
        assert html_text.main_text(p, wrapper) == "\n".join([f"T{i}", *[f"para {i} & more", "two lines"] * (i + 1)]) == html_text.main_text(p, None)
    body = next(x for x in wrapper[html_text.INSIDE] if x[html_text.LABEL] == "body")
    article = next(x for x in body[html_text.INSIDE] if x[html_text.LABEL] == "article")
    assert [(x[html_text.LABEL], x[html_text.QUANT]) for x in article[html_text.INSIDE]] == [("h1", ""), ("p", "+")]


def test_html_optional_and_repeated_groups():
    wrapper = html_text.infer(["<div><h2>a</h2><p>b</p></div>", "<div><p>c</p><p>d</p></div>", "<div><h2>e</h2></div>"])
    assert [(x[0], x[1]) for x in wrapper[2][0][2]] == [("h2", "?"), ("p", "*")]
    folded = html_text.infer(["<dl><dt>a<dd>b<dt>c<dd>d</dl>"])[2][0][2]
    assert [(x[0], x[1]) for x in folded] == [("dt", "+"), ("dd", "+")]


def test_html_without_semantic_tags():
    page_ = """<div id="header"><a href=/>Home</a> Site</div><div class="top-menu"><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div><div class="layout"><div class="sidebar"><p>side text</p></div>
    <div class="content"><h1>Title &lt;b&gt;</h1><p>First<br>second &nbsp; x</p><div class="cookie-notice">We use cookies</div><ul><li>point one<li>point two</ul><form>email <button>Go</button></form><script>if (a<b) "</p>"</script><p>Last</div>
    <div class="comments"><p>nice post!</p></div></div><div class="footer">(c)</div>"""
    assert html_text.main_text(page_, None) == "Title <b>\nFirst second x\npoint one\npoint two\nLast"


@pytest.mark.parametrize(("said", "text"), [(None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<article><p>cut &am", "cut &am"), ("<article><p>cut</p><di", "cut"), ("<<>><", "<<>><"), ("<!-- only", ""), ("<p>x" + "<b>" * 300 + "deep", "xdeep")])
def test_html_edges(said, text):
    assert html_text.main_text(said, None) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class=ad>", "</div>", "<li>", "<ul>", "text ", "&amp;", "<script>", "</script>", "<br>", "<td>", "<!--", "-->", "<"]), max_size=25).map("".join))
def test_html_never_fails(said):
    html_text.main_text(said, html_text.infer([said, "<p>a</p>"]))


def test_html_lists_of_links_within_articles_stay():
    linked, plain = (f"<article><p>a</p><ul><li>{x}</ul></article>" for x in ("<a href=x>see the other page</a>", "a plain point"))
    assert html_text.main_text(plain, html_text.infer([linked])) == "a\na plain point"


def test_html_wrappers_see_every_page(spark):
    rows = [(f"http://h.org/{i % 40}", f"<body><div><p>text {i % 40}</p></div><h{1 + i % 4}>t</h{1 + i % 4}><b class={'abcdefghij'[i % 10]}>x</b></body>") for i in range(120)]
    (packed,) = [r.wrapper for r in html_text.wrappers(spark.createDataFrame(rows, "url string, html string")).collect()]
    assert {f"b {x}" for x in "abcdefghij"} <= {x[html_text.LABEL] for x in html_text._unpacked(packed)[html_text.INSIDE][0][html_text.INSIDE]}


def test_html_template_texts_are_found_by_alignment():
    """The wrapper changes the result: what all pages say at a place is the template's, in runs and out of them."""
    pages = [f"<body><div><p>Read more on this site.</p><h2>head {i}</h2><p>story {i}{' goes on' * 20}</p>{'<p>extra</p>' * (i % 3)}<p>All rights reserved</p></div></body>" for i in range(6)]
    wrapper = html_text.infer(pages)
    for i, p in enumerate(pages):
        assert html_text.main_text(p, wrapper) == "\n".join([f"head {i}", f"story {i}" + " goes on" * 20] + ["extra"] * (i % 3))
        assert "All rights reserved" in html_text.main_text(p, None)
    few = html_text.infer(pages[: html_text.TEMPLATE_PAGES - 1])
    assert "All rights reserved" in html_text.main_text(pages[0], few)
    copies = [f"<article><h1>one story</h1><p>the same long paragraph</p><p>and another one</p><p>{i}</p></article>" for i in range(8)]
    assert html_text.main_text(copies[3], html_text.infer(copies)) == "one story\nthe same long paragraph\nand another one\n3"


@pytest.mark.parametrize("name", ["sidebar-layout", "side-by-side", "notice-board", "ad-free", "with-sidebar", "commentary"])
def test_html_names_of_layouts_keep_their_articles(name):
    said = f'<div class="{name}"><div class="content"><p>first words</p><p>second</p></div></div><div class="cookie-notice">ok</div><div class="ad-slot">buy</div>'
    assert html_text.main_text(said, None) == "first words\nsecond"
    assert html_text.main_text(f'<article><p>first</p><div class="{name}"><p>second</p></div></article>', None) == "first\nsecond" or name == "with-sidebar"
    assert html_text.main_text(f'<div class="{name}"><article><p>first</p></article></div>', None) == "first"


def test_html_deep_and_long_pages():
    deep = "<div>" * 100_000 + "deep text" + "</b></div>" * 100_000
    spans = "<span>" * 50_000 + "<li></li>" * 50_000 + "<p>" * 50_000 + "last"
    unlike = "<div>" + "".join(f"<p class=c{'abcdefghij'[k % 10]}{chr(97 + k // 10 % 26)}{chr(97 + k // 260 % 26)}{chr(97 + k // 6760)}>{k}</p>" for k in range(50_000)) + "</div>"
    mixed = "".join(random.Random(3).choices(["<p>a</p>", "<h3>b</h3>", "<ul><li>c</ul>", "<pre>d</pre>"], k=50_000))
    pages = [deep, spans, unlike, mixed, deep[:500_000], unlike[::1][: len(unlike) // 2]]
    wrapper = html_text._unpacked(html_text._packed(html_text.infer(pages)))
    assert html_text.main_text(deep, wrapper) == "deep text" == html_text.main_text(deep, None)
    assert html_text.main_text(spans, None).endswith("last")
    assert html_text.main_text(unlike, wrapper) == "\n".join(map(str, range(50_000))) == html_text.main_text(unlike, None)
    assert html_text.main_text(mixed, None).count("\n") == 49_999


def test_html_alignment_is_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([[rng.choice("abcde")] for _ in range(rng.randint(0, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        found = html_text.pairs(a, b)
        assert len(found) == best[-1][-1] and all(a[i] == b[j] for i, j in found) and all(x < y for (x, _), (y, _) in zip(found, found[1:]))


def test_html_on_frames(spark):
    rows = [(i, f"http://h{i % 2}.org/{i}", page(f"T{i}", [f"p{i}"]), "w") for i in range(9)] + [(9, None, page("N", ["n"]), "w"), (10, "http://h0.org/x", None, "w"), (10, "http://h0.org/x", None, "w")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, wrapper string")
    found = html_text.extract_pages(df)
    assert found.columns == [*df.columns, "text"]
    assert sorted((r.page_id, r.text) for r in found.collect()) == sorted([(i, f"T{i}\np{i}") for i in range(9)] + [(9, "N\nn"), (10, ""), (10, "")])
    assert html_text.extract_pages(df.limit(0)).count() == 0


def language_rows(n, seed):
    rng = random.Random(seed)
    sounds = {"xx": ["ka", "to", "mi", "ra"], "yy": ["sch", "ung", "ein", "ber"], "zz": ["ció", "que", "los", "ñ"]}
    return [(i, " ".join("".join(rng.choices(sounds[k], k=3)) for _ in range(rng.randint(1, 30))), k) for i, k in enumerate(rng.choices(list(sounds), k=n))]


def test_language_accuracy_and_edges(spark):
    schema = "key int, text string, lang string"
    model = langid.fit(spark.createDataFrame([*language_rows(300, 1), (900, None, "xx"), (901, "ka", None)], schema))
    held = spark.createDataFrame(language_rows(200, 2), schema).withColumn("score", F.lit("clash"))
    found = langid.identify(held, model).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 195 and all(0 <= r.score <= 1 for r in found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "日本"), (5, "ka" * 300_000)], "key int, text string")
    said = {r.key: (r.lang_pred, r.score) for r in langid.identify(odd, model).collect()}
    assert said[1] == said[2] == said[3] == ("und", 0.0) and said[4][0] in model.languages and said[5][0] == "xx"
    none = langid.fit(held.limit(0).select("key", "text", "lang"))
    assert {r.lang_pred for r in langid.identify(held, none).collect()} == {"und"}


def test_language_filter_has_no_false_negatives():
    rng = np.random.default_rng(0)
    held = [rng.integers(0, 1 << 63, 3000).astype(np.uint64) for _ in range(70)]
    model = langid.Filter.build([f"l{i}" for i in range(70)], held, "l0")
    size = model.masks.shape[1]
    for i in (0, 1, 63, 64, 69):
        at = list(model.positions(held[i], size))
        assert all(((model.masks[i // 64][p] >> np.uint64(i % 64)) & np.uint64(1)).all() for p in at)
    assert model.false_rates.max() < 0.1


def toxic_rows(n, seed):
    rng = random.Random(seed)
    plain, bad = [f"word{c}{d}" for c in "abcdefgh" for d in "ijklmnop"], ["grumbol", "snarkit", "vexowl"]
    out = []
    for i in range(n):
        words, hot = rng.choices(plain, k=rng.randint(5, 40)), rng.random() < 0.3
        if hot:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "ing", "s"]))
        out.append((i, " ".join(words), int(hot)))
    return out


@pytest.fixture(scope="module")
def toxic_model(spark):
    df = spark.createDataFrame([*toxic_rows(500, 1), (900, None, 1), (901, "x", None)], "doc_id int, text string, toxic int")
    return toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))


def test_toxicity_accuracy_and_spans(spark, toxic_model):
    held = spark.createDataFrame(toxic_rows(300, 2), "doc_id int, text string, toxic int").withColumn("predicted", F.lit("clash"))
    for r in toxicity.score(held, toxic_model).collect():
        assert r.predicted == r.toxic and 0 <= r.score <= 1
        said = [r.text[s.start : s.end] for s in r.spans]
        assert all(w.startswith(("grumbol", "snarkit", "vexowl")) for part in said for w in part.split())
        assert bool(said) == bool(r.toxic)


def test_toxicity_by_context_and_not_the_word(spark):
    """Two words are toxic in a row and clean apart; every document holds both."""
    rng = random.Random(9)
    plain = [f"word{c}{d}" for c in "abcdefgh" for d in "ijklmnop"]

    def said(hot):
        words = rng.choices(plain, k=rng.randint(8, 30))
        if hot:
            words[4:4] = ["plain", "owl"]
        else:
            words[2:2], words[6:6] = ["owl"], ["plain"]
        return " ".join(words)

    rows = [(i, said(hot := int(i % 3 == 0)), hot) for i in range(900)]
    df = spark.createDataFrame(rows[:600], "doc_id int, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    held = spark.createDataFrame(rows[600:], "doc_id int, text string, toxic int")
    for r in toxicity.score(held, model).collect():
        assert r.predicted == r.toxic
        assert [r.text[s.start : s.end] for s in r.spans] == (["owl"] if r.toxic else []) or [r.text[s.start : s.end] for s in r.spans] == ["plain owl"]


def test_expectations_under_the_constraint():
    """Pulls of a toxic document of two windows, against all its label paths with at least one toxic token."""
    rng = np.random.default_rng(3)
    emit, moves = rng.normal(size=(2, 3)), rng.normal(size=(2, 2))
    lengths = np.array([3, 2])
    real = np.arange(3) < lengths[:, None]
    z, chance, _ = toxicity._forward_backward(np.where(real, emit, 0), real, moves)
    pull = toxicity.pulls(z, lengths, moves[0, 0], np.zeros(2, int), np.array([True, True]))
    total, held = 0.0, np.zeros(5)
    for bits in range(1, 32):
        path = np.array([bits >> k & 1 for k in range(5)])
        score = 0.0
        for window, own in ((0, path[:3]), (1, path[3:])):
            for t, state in enumerate(own):
                score += moves[own[t - 1] if t else 0, state] + state * emit[window, t]
        total += math.exp(score)
        held += math.exp(score) * path
    flat = np.concatenate([chance[0], chance[1, :2]])
    assert np.allclose(held / total - flat, np.concatenate([pull[0] * chance[0], pull[1] * chance[1, :2]]))


def test_toxicity_edges(spark, toxic_model):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "İ grumbol"), (4, "word " * 50_000)], "doc_id int, text string")
    found = {r.doc_id: r for r in toxicity.score(df, toxic_model).collect()}
    assert found[1].score == found[2].score < 0.5 and found[4].predicted == 0
    assert found[3].predicted == 1 and [df.filter("doc_id = 3").first().text[s.start : s.end] for s in found[3].spans] == ["grumbol"]
    nothing = toxicity.fit(df, df.select("doc_id", F.lit(0).alias("toxic")))
    assert {r.predicted for r in toxicity.score(df, nothing).collect()} == {0}
    assert toxicity.fit(df.limit(0), df.limit(0).select("doc_id", F.lit(1).alias("toxic"))).weights == {}


def test_marginals_match_the_full_chain(toxic_model):
    """Powers of the featureless transition against a plain forward-backward over every token."""
    words = ["a", "b", "grumbol", "c", "d", "e", "snarkits", "vexowl", "f"] * 3
    scored = [toxic_model.emission(w) for w in words]
    at = [i for i, e in enumerate(scored) if e is not None]
    a = np.exp(toxic_model.moves)
    weights = [np.array([1.0, np.exp(toxic_model.bias if e is None else e)]) for e in scored]
    ahead, state = [], np.array([1.0, 0.0])
    for w in weights:
        state = state @ a * w
        ahead.append(state := state / state.sum())
    behind, back = [None] * len(words), np.ones(2)
    for i in range(len(words) - 1, -1, -1):
        behind[i] = back
        back = a @ (weights[i] * back)
        back /= back.sum()
    exact = [float((f * b)[1] / (f * b).sum()) for f, b in zip(ahead, behind, strict=True)]
    assert np.allclose(toxic_model.marginals(at, [scored[i] for i in at], len(words)), [exact[i] for i in at], atol=1e-9)
