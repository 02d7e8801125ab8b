import html
import os
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.functions import chance, lexicon, mutation, text

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


def many(spark, values, f):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string").select("i", f(F.col("x")).alias("y")).collect()
    return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]


def test_clean_text(spark):
    said = many(spark, [" a  b\0\n c ", None, "", "a  b", "\x1c x"], text.clean_text)
    assert said == ["a b c", "", "", "a b", "x"]


def test_word_count(spark):
    assert many(spark, ["", "a", "a b c"], text.word_count) == [0, 1, 3]


def test_is_latin(spark):
    assert many(spark, ["123", "abжд", "abжде", ""], text.is_latin) == [True, True, False, True]


def test_canonicalize(spark):
    alike = ["please", "p.l.e.a.s.e", "pleeease", "PLEASE", text.wide("please"), "plеase", "pl3as3"]
    assert set(many(spark, alike, text.canonicalize)) == {"please"}
    other = many(spark, ["p1ease", "p*****", "pl**s*", "pl@@s@", "!!! ???"], text.canonicalize)
    assert "please" not in other and other[-1] == ""


def test_html(spark):
    page = 'a<br>b &amp; c<span class="quote">&gt;d</span>'
    assert one(spark, page, text.html_to_text) == one(spark, page, text.html_to_text_all) == "a b & c >d"
    assert many(spark, [None, "", "&eacute;"], text.html_to_text_all) == ["", "", html.unescape("&eacute;")]


def test_stems(spark):
    f = lambda c: text.stem_in(c, ["work", "is", "play"])
    assert many(spark, ["workers", "Worked", "work", "iss", "played", "plays", "other"], f) == ["work", "work", "work", None, "play", "play", None]


def test_timestamps(spark):
    assert many(spark, [None, "12", "2024-01-01T00:00:00Z", "junk", "3.7"], text.timestamp_seconds) == [0, 12, 1704067200, 0, 3]


def test_running_totals_do_not_depend_on_partitions(spark):
    rows = spark.range(500).select(F.col("id"), (F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("v"))
    found = []
    for n in (1, 7):
        df = chance.running(rows.repartition(n).withColumn("h", chance.hashed("t", F.col("id"))), ["g"], ["h", "id"], F.col("v"), "before")
        found.append({r["id"]: (r["h"], r["g"], r["v"], r["before"]) for r in df.collect()})
    assert found[0] == found[1]
    for g in range(3):
        total = 0
        for i, (h, _, v, before) in sorted(((i, x) for i, x in found[0].items() if x[1] == g), key=lambda p: (p[1][0], p[0])):
            assert before == total
            total += v


@pytest.mark.parametrize("style", ["sep", "repeat", "case", "fullwidth", "homoglyph"])
def test_styles_that_keep_the_canonical_form(spark, style):
    words = ["please", "hello", "water", "a", "to", "mississippi"]
    f = (lambda w: text.fullwidth(w)) if style == "fullwidth" else (lambda w: getattr(mutation, style)(w, F.md5(w)))
    assert many(spark, words, lambda w: text.canonicalize(f(w))) == many(spark, words, text.canonicalize)


def test_styles(spark):
    words = ["please", "hello", "xx", "rhythm"]
    for w, done in zip(words, many(spark, words, lambda w: mutation.censor(w, F.md5(w))), strict=True):
        assert len(done) == len(w) and (len(w) <= 2 or done != w)
    for w, done in zip(words, many(spark, words, lambda w: mutation.leet(w, F.md5(w))), strict=True):
        back = str.maketrans(dict(zip(mutation.LEET_TO, mutation.LEET_FROM, strict=True)))
        assert len(done) == len(w) and re.sub("l", "i", done.translate(back).lower()) == re.sub("l", "i", w)
    assert many(spark, words, lambda w: mutation.mutate_word(w, F.md5(w))) == many(spark, words, lambda w: mutation.mutate_word(w, F.md5(w)))


def test_mutate_text_changes_stems_only(spark):
    df = spark.createDataFrame([("we were working, (Works) and work at rest",)], "x string")
    hits = df.withColumn("h", F.explode(F.array(mutation.hits_of(F.col("x"), ["work"], 2))))
    row = hits.select("h", mutation.mutate_text(F.col("x"), F.col("h"), F.md5("x")).alias("y")).first()
    assert [h["stem"] for h in row["h"]] == ["work", "work"] and [h["core"] for h in row["h"]] == ["working", "Works"]
    assert row["y"].startswith("we were ") and row["y"].endswith(" and work at rest") and "ing," in row["y"]


def reference_loose(word):
    """The obvious form: vowels optional, marks between all letters. Slow on long runs of marks."""
    return r"\b" + lexicon.JUNK.join(re.escape(c) + "?" * (c in lexicon.VOWELS) for c in word) + r"\b"


@settings(max_examples=300, deadline=None)
@given(st.text("bfhloe.-_ 1x", max_size=14), st.sampled_from(["hello", "foe", "eel", "oboe", "be", "hll"]))
def test_loose_form_matches_what_the_obvious_form_does(said, word):
    spans = lambda p: [m.span() for m in re.finditer(p, said, re.I)]
    assert spans(lexicon.loose_form(word)) == spans(reference_loose(word))


LEXICON = lexicon.Lexicon(("darn", "blast"), ("oaf", "dolt"), ("you", "your"), (r"\bgo away\b",), (r"\bd[^\w\s]{1,4}n\b",))


@pytest.mark.parametrize(
    ("said", "category"),
    [
        ("", "clean"), (None, "clean"), ("a quiet day", "clean"), ("darn this rain", "emotional"), ("d.a.r.n this rain", "emotional"), ("d**n it", "emotional"),
        ("that oaf again", "grey"), ("you are an oaf", "attack"), ("you one two three four five oaf", "attack"), ("you one two three four five six oaf", "grey"), ("please go away", "attack"),
    ],
)
def test_classify(spark, said, category):
    assert lexicon.classify(said, LEXICON)[3] == category
    assert lexicon.with_category(spark.createDataFrame([(said,)], "text string"), LEXICON).first()["category"] == category


def test_native_and_span_classifiers_agree_on_plain_tokens(spark):
    plain = lexicon.Lexicon(("darn",), ("dolt",), ("you",))
    said = ["you darn", "darn", "dolt here", "nothing", "you and a dolt", "darn dolt", "you a b c d e f g dolt"]
    rows = spark.createDataFrame([(s,) for s in said], "text string")
    a = {r.text: r.category for r in lexicon.with_category(rows, plain).collect()}
    assert a == {r.text: r.category for r in lexicon.with_token_category(rows, plain).collect()}


def test_loose_form_is_linear(spark):
    assert not re.search(lexicon.loose_form("beoeoeb"), "b" + "." * 20_000)


ODD = ["́", "⃣", "²", "½", "ſ", "K", "ı", "İ", ".", "*", "-", "_", "1", "é", "‿", "‍", "\x1c", " ", " ", " ", "\n"]


def test_the_gate_lets_through_all_that_the_classifier_finds(spark):
    rng = random.Random(5)
    pieces = ["darn", "blast", "oaf", "dolt", "you", "your", "go away", "d", "a", "r", "n", "o", "f", "b", "l", "st", "x", "k", "s", *ODD]
    said = ["d́áŕn this", "d⃣arn it", "you d.ár.n oaf"] + ["".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(4000)]
    found = lexicon.with_category(spark.createDataFrame([(s, 1) for s in said], "text string, _class int"), LEXICON).collect()
    assert sum(r.category != "clean" for r in found) > 400 and all(r["_class"] == 1 for r in found)
    for r in found:
        assert (bool(r.profanity), bool(r.insult), bool(r.attack), r.category) == lexicon.classify(r.text, LEXICON), repr(r.text)


def test_patterns_in_terms_of_the_engine(spark):
    rng = random.Random(6)
    patterns = [r"\bab\b", r"a\Wb", r"a[^\w\s]b", r"a[\W_0-9]*b", r"\Ba\B", r"a\sb", r"a\Db", r"[]a]b", r"a[[&&]b", r"a\S\db"]
    said = ["".join(rng.choices(["a", "b", "&", "[", "]", "2", *ODD], k=rng.randint(1, 6))) for _ in range(1500)]
    df = spark.createDataFrame([(s,) for s in said], "x string")
    for p in patterns:
        found = {r.x: r.y for r in df.select("x", F.col("x").rlike(lexicon.java_pattern(p)).alias("y")).collect()}
        assert found == {s: bool(re.search(p, s)) for s in said}, p


def slow_class(said, lex):
    """All hits by the obvious forms, and every hit held against every pronoun."""
    hits = {}
    for name, words in (("e", lex.expletives), ("i", lex.insults)):
        strict = [m.span() for m in re.finditer("|".join(r"\b" + lexicon.JUNK.join(w) + r"\b" for w in words), said, re.I)]
        loose = [m for m in re.finditer("|".join(map(reference_loose, words)), said, re.I) if m.span() not in strict and (len(m[0]) >= 5 or re.search(r"[\W_0-9]", m[0]))]
        hits[name] = [a for a, _ in strict] + [m.start() for m in loose]
    censored = [m.start() for p in lex.censored for m in re.finditer(p, said, re.I)]
    tokens = list(re.finditer(r"[^\W_0-9]+", said))
    place = lambda at: next((k for k, t in enumerate(tokens) if t.end() > at), None)
    people = [k for k, t in enumerate(tokens) if re.match(rf"\b(?:{'|'.join(lex.pronouns)})\b", t[0], re.I)]
    near = any(place(a) is not None and abs(place(a) - k) <= lex.window for a in hits["e"] + hits["i"] + censored for k in people)
    if any(re.search(p, said, re.I) for p in lex.attacks) or near:
        return "attack"
    return "emotional" if hits["e"] or (censored and not hits["i"]) else "grey" if hits["i"] else "clean"


@needs_data
def test_categories_of_all_documents_against_brute_force(spark):
    from lexiloom.plans import catalog, views

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    found = {r.doc_id: r.category for r in catalog.QUERIES["cls_category"](spark, DATA).collect()}
    assert found == {i: slow_class(t or "", views.LEXICON) for i, t in texts.items()} and len(set(found.values())) > 2


@needs_data
def test_seeds_and_references_against_brute_force(spark):
    from lexiloom.plans import catalog

    rows = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    found = {r.doc_id: r.seed for r in catalog.QUERIES["txt_crc_seed"](spark, DATA).collect()}
    assert found == {i: 42 + 100_000 + zlib.crc32(f"{r.source}|{r.text}".encode()) % 97 for i, r in rows.items()}
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    for r in catalog.QUERIES["txt_html_clean_all"](spark, DATA).collect():
        said = re.sub(r"<[^>]+>", " ", re.sub(r'class="(quote|deadlink|quoteLink)"', "", html.unescape(pages[r.page_id] or ""))).replace("\xa0", " ")
        assert r.plain == re.sub(r" *\n *", " ", re.sub(r"\n[ \t\n\x0b\f\r]*\n+", "\n", re.sub(r"[ \t]+", " ", said))).strip(" ")


def test_words_of_any_length_are_changed_whole(spark):
    w = "abcdefghij" * ((1 << 20) // 10 + 6)
    sep, star = spark.createDataFrame([(w,)], "w string").select(mutation.sep(F.col("w"), F.md5(F.lit("x"))).alias("a"), mutation.censor(F.col("w"), F.md5(F.lit("x"))).alias("b")).first()
    assert len(sep) == 2 * len(w) - 1 and sep[::2] == w and len(star) == len(w)


@pytest.mark.parametrize(("style", "letters", "forms", "low", "high"), [("leet", mutation.LEET_FROM, mutation.LEET_TO, 0.3, 0.8), ("homoglyph", mutation.LOOK_FROM, mutation.LOOK_TO, 0.2, 0.5)])
def test_draws_follow_a_draw_of_places(spark, style, letters, forms, low, high):
    """How many letters change, and how often each does, as with a plain draw of places without replacement."""
    word, n = "mississippitaboo", 4000
    df = spark.range(n).select(F.lit(word).alias("w"), F.md5(F.col("id").cast("string")).alias("h"))
    found = [r.y for r in df.select(getattr(mutation, style)(F.col("w"), F.col("h")).alias("y")).collect()]
    rng, table = random.Random(1), dict(zip(letters, forms, strict=True))
    pool = [c for c in word if c in table]
    drawn = [set(rng.sample(pool, max(1, round(len(pool) * rng.uniform(low, high))))) for _ in range(n)]
    for c in set(pool):
        share = sum(table[c] in y for y in found) / n
        assert abs(share - sum(c in d for d in drawn) / n) < 0.04, c
    changed = [sum(a != b for a, b in zip(word, y, strict=True)) for y in found]
    assert abs(sum(changed) / n - sum(sum(word.count(c) for c in d) for d in drawn) / n) < 0.25
