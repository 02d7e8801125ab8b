import json

import pytest
import zstandard
from pyspark.sql import functions as F

from lexiloom import cli
from lexiloom.functions import lexicon
from lexiloom.operators import curate, scoring
from lexiloom.plans import flow
from lexiloom.sources import adapters, apis, files
from lexiloom.streaming import ingest
from tests import fake_api


def test_known_corpora(spark):
    flags = spark.createDataFrame([("a b", 1, 0, 1, 0, 0, 0), ("c d", 0, 0, 0, 0, 0, 0), (" ", 1, 0, 0, 0, 0, 0), ("e", None, None, 1, None, None, None)], "comment_text string, " + ", ".join(f"{f} int" for f in adapters.FLAGS))
    assert {tuple(r)[:4] for r in adapters.from_flags(flags, "f").collect()} == {("a b", 1, "f", "toxic+obscene"), ("c d", 0, "f", "clean"), ("e", 1, "f", "obscene")}
    scores = spark.createDataFrame([("a", "3.5"), ("b", "3.4"), ("c", "n/a"), ("d", None)], "text string, toxicity_human string")
    assert {(r.text, r.label, r.origin_label) for r in adapters.from_score(scores, "s").collect()} == {("a", 1, "3.5"), ("b", 0, "3.4"), ("c", 0, "0.0"), ("d", 0, "0.0")}
    prompts = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", "0")], "generation string, prompt_label string")
    assert {(r.text, r.label) for r in adapters.from_prompt(prompts, "p").collect()} == {("a", 1), ("c", 0)}
    tokens = spark.createDataFrame([('["a", "b"]', "hate"), ("[oops", "0"), ("x", "7")], "text string, label string")
    assert {(r.text, r.label, r.split_origin) for r in adapters.from_tokens(tokens, "t").collect()} == {("a b", 1, "test"), ("[oops", 0, "test")}
    articles = spark.createDataFrame([(1, "One two three four. Five! Six seven eight nine ten?")], "id int, text string")
    assert [r.text for r in adapters.from_articles(articles, "w", ["id"]).collect()] == ["One two three four.", "Six seven eight nine ten?"]


def test_column_map(spark):
    df = spark.createDataFrame([("hi there", "x", "2024-01-01T00:00:00Z", "5")], "body string, who string, at string, points string")
    row = adapters.adapt(df, adapters.ColumnMap("body", "who", "at", "points", "none")).first()
    assert (row.text, row.subreddit, row.created_utc, row.score, row.id) == ("hi there", "x", 1704067200, 5, "")
    with pytest.raises(ValueError):
        adapters.adapt(df, adapters.ColumnMap("nope"))


def test_dumps(spark, tmp_path):
    lines = [json.dumps({"body": f"b{i}", "subreddit": "s", "created_utc": i, "score": "2", "id": str(i)}) for i in range(5)] + ["{broken"]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "b.jsonl.zst").write_bytes(zstandard.compress("\n".join(lines).encode()))
    blocks = b"".join(zstandard.compress((x + "\n").encode()) for x in lines)
    (tmp_path / "c.zst_blocks").write_bytes(blocks)
    assert files.read_dump(spark, str(tmp_path / "a.jsonl")).count() == 5
    assert {r.id for r in files.read_dump(spark, str(tmp_path / "b.jsonl.zst")).collect()} == set("01234")
    read = files.read_block_dump(spark, str(tmp_path / "c.zst_blocks"))
    assert {r.body for r in read.collect()} == {f"b{i}" for i in range(5)}
    assert {r.text for r in adapters.from_comments(read).collect()} == {f"b{i}" for i in range(5)}


def test_shards_resume(spark, tmp_path):
    path = str(tmp_path / "shards")
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "text string, id string")
    files.append_shards(df, path)
    files.append_shards(df.unionByName(spark.createDataFrame([("c", "4")], df.schema)), path, 1)
    assert sorted(r.text for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]


def test_reviews_lines_and_lists(spark, tmp_path):
    rows = spark.createDataFrame([('say "hi",\nthere', "grey", -1), ("ok", "grey", 1)], "text string, origin_label string, label int")
    files.write_review(rows, str(tmp_path / "r"))
    back = spark.read.csv(str(tmp_path / "r"), header=True, multiLine=True, escape='"').collect()
    assert [r.text for r in back] == ['say "hi",\nthere']
    assert files.read_review(spark, str(tmp_path / "r")).count() == 0
    (tmp_path / "l.txt").write_text("one\n\n  \ntwo\n")
    assert [r.text for r in files.read_lines(spark, str(tmp_path / "l.txt")).collect()] == ["one", "two"]
    with pytest.raises(ValueError):
        files.read_many(spark, " , ")


def test_many_rows_for_review_are_spread_over_files(spark, tmp_path):
    """As a CSV can't be split, one file would be written, and read, by one task."""
    said = F.concat_ws("\n", *(F.sha2(F.concat_ws("|", "id", F.lit(i)), 512) for i in range(16)))
    rows = spark.range(0, 4000, 1, 3).select(said.alias("text"), F.lit("grey").alias("origin_label"), F.when(F.col("id") % 4 == 0, 1).otherwise(-1).alias("label"))
    files.write_review(rows, str(tmp_path / "r"))
    written = [p.stat().st_size for p in (tmp_path / "r").glob("part-*")]
    assert len(written) > 2 and max(written) < sum(written) / 2
    back = spark.read.csv(str(tmp_path / "r"), schema="text string, origin_label string, label int", **files.REVIEW)
    assert back.count() == 3000 and back.exceptAll(rows.filter("label = -1")).isEmpty()
    files.write_review(rows.limit(40).repartition(8), str(tmp_path / "few"))
    assert len(list((tmp_path / "few").glob("part-*"))) == 1


def test_replace_table_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    files.replace_table(spark.read.parquet(path).filter("id > 2"), path)
    assert spark.read.parquet(path).count() == 2


@pytest.mark.parametrize(("kind", "transport", "n"), [("comments", "comments", 7), ("archive", "archive", 3), ("videos", "videos", 3), ("board", "board", 4)])
def test_paged_apis(spark, kind, transport, n):
    apis.register(spark)
    read = spark.read.format("paged_api").options(kind=kind, channels="x,y", transport=f"tests.fake_api:{transport}", maxRows=7, pageSize=2 if kind != "comments" else 3).load()
    found = read.collect()
    assert len(found) == 2 * n and {r.channel for r in found} == {"x", "y"}
    if kind == "videos":
        done = adapters.from_video_comments(read.withColumnRenamed("channel", "c")).collect()
        assert {(r.text, r.created_utc, r.score) for r in done} == {(f"nice & {i}", 1704067200, i) for i in range(3)}


def test_requests_are_tried_again():
    fake_api.CALLS["n"] = 0
    assert apis.fetch(fake_api.flaky, "", {}, tries=4, pause=0) == {"data": []} and fake_api.CALLS["n"] == 3
    fake_api.CALLS["n"] = 0
    with pytest.raises(ConnectionError):
        apis.fetch(fake_api.flaky, "", {}, tries=2, pause=0)


def test_ingest_takes_each_text_once(spark, tmp_path):
    source, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")
    schema = "text string, id string"
    for batch in (["a", "b", "a"], ["b", "c"]):
        spark.createDataFrame([(t, "0") for t in batch], schema).write.mode("append").json(source)
        ingest.ingest(ingest.first_seen(spark.readStream.schema(schema).json(source)), out, marks, {"run": 1}).awaitTermination(60)
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
    assert ingest.signature({"a": 1, "b": 2}) == ingest.signature({"b": 2, "a": 1}) != ingest.signature({"a": 2})


def test_rescans_of_a_live_board(spark, tmp_path):
    apis.register(spark)
    stream = spark.readStream.format("paged_api").options(kind="board", channels="x", transport="tests.fake_api:board", repeat=2, pageSize=2).load()
    posts = ingest.first_seen(stream.select(F.get_json_object("value", "$.com").alias("text")))
    query = posts.writeStream.format("memory").queryName("posts").option("checkpointLocation", str(tmp_path / "m")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("posts").count() == 4


def test_steps():
    assert flow.resolve("export,core") == ["download", "normalize", "mutate", "dedup", "split", "export"] and flow.resolve("") == []
    with pytest.raises(ValueError):
        flow.resolve("nope")


def test_build(spark, tmp_path):
    raw = spark.range(60).select(F.concat(F.lit("some people work on item "), F.col("id")).alias("text"), (F.col("id") % 2).cast("tinyint").alias("label"), F.lit("s").alias("source"), F.lit("o").alias("origin_label"), F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split_origin"))
    raw.write.parquet(str(tmp_path / "raw"))
    build = flow.Build(spark, flow.Settings(str(tmp_path), ["work"], test_target=16, val_target=8))
    assert build.run("all")[-1] == "export: done" and build.log[0] == "download: skipped" and "curate: skipped" in build.log
    done = files.read_split(spark, str(tmp_path / "dataset"))
    assert done.groupBy("cluster").agg(F.countDistinct(F.when(F.col("split") != "test_obfuscated", F.col("split"))).alias("n")).filter("n > 1").isEmpty()
    assert {"train", "validation", "test", "test_obfuscated"} == {r.split for r in done.select("split").distinct().collect()}
    sizes = {r.label: r.n for r in done.filter("split = 'train'").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert abs(sizes[0] - sizes[1]) <= 4
    report = json.loads(spark.read.json(str(tmp_path / "report")).first().stats)
    assert report["total_rows"] == done.count() > report["distinct_rows"]


WORDS = lexicon.Lexicon(("darn",), ("oaf",), ("you",))
SAID = ["darn this rain again today", "you are such an oaf today", "what an oaf that was today", "some oaf went by just now", "an oaf of the first order", "a quiet day in the park"]


def candidates(spark, path):
    rows = [(t, "comments", "c", 1, 1, str(i)) for i, t in enumerate(SAID)]
    spark.createDataFrame(rows, "text string, source string, subreddit string, created_utc bigint, score bigint, id string").write.parquet(f"{path}/candidates")


def labels(spark, path):
    return {r.text: (r.label, r.origin_label) for r in spark.read.parquet(f"{path}/community").collect()}


def test_grey_rows_end_in_a_bank_or_in_review(spark, tmp_path):
    work = str(tmp_path)
    candidates(spark, work)
    chances = {SAID[2]: 0.9, SAID[3]: 0.1, SAID[4]: 0.5}
    build = flow.Build(spark, flow.Settings(work, lexicon=WORDS, scorer=lambda: lambda texts: [chances.get(t, 0.5) for t in texts]))
    log = build.run("curate,review,merge")
    assert log[0] == "curate: done" and log[1].startswith("review: waiting for labels") and len(log) == 2
    (open_,) = spark.read.parquet(f"{work}/manual").collect()
    assert (open_.text, open_.label) == (SAID[4], -1) and abs(open_.conf - 0.5) < 1e-6
    banked = {r.text: (r.bank, r.label) for r in spark.read.parquet(f"{work}/banks").collect()}
    assert banked == {SAID[0]: ("B", 0), SAID[1]: ("A", 1), SAID[2]: ("A", 1), SAID[3]: ("C", 0), SAID[5]: ("C", 0)}
    spark.createDataFrame([(SAID[4], "grey", 1)], "text string, origin_label string, label int").coalesce(1).write.mode("overwrite").csv(f"{work}/review", header=True)
    assert build.run("review,merge")[-2:] == ["review: done", "merge: done"]
    assert labels(spark, work) == {SAID[0]: (0, "emotional"), SAID[1]: (1, "attack"), SAID[2]: (1, "grey->attack"), SAID[3]: (0, "grey->clean"), SAID[4]: (1, "grey"), SAID[5]: (0, "clean")}


def test_build_without_a_model(spark, tmp_path):
    work = str(tmp_path)
    candidates(spark, work)
    assert "review: waiting" in flow.Build(spark, flow.Settings(work, lexicon=WORDS)).run("comments")[-1]
    assert spark.read.parquet(f"{work}/manual").count() == 3
    flow.Build(spark, flow.Settings(work, lexicon=WORDS, by_lexicon=True)).run("review,merge")
    assert set(labels(spark, work)) == {SAID[0], SAID[1], SAID[5]}


def test_verification_scores_a_sample_only(spark):
    rows = spark.createDataFrame([(str(i), "A" if i % 2 else "C") for i in range(200)], "text string, bank string").withColumns({"label": F.lit(1).cast("tinyint"), "origin_label": F.lit("x")})
    asked = spark.sparkContext.accumulator(0)

    def scorer():
        def score(texts):
            asked.add(len(texts))
            return [0.0] * len(texts)

        return score

    out = curate.verify(rows, ["text"], grey=curate.Grey(verify_share=0.1), score=lambda df: scoring.score_with(df, scorer))
    assert {(r.bank, r.n) for r in out.groupBy("bank").agg(F.count("*").alias("n")).collect()} == {("A", 90), ("C", 100), ("manual", 10)}
    assert 0 < asked.value <= 40


def test_feeds_and_tables(spark, tmp_path):
    work = str(tmp_path)
    spark.createDataFrame([(f"one two three four {i}", i) for i in range(9)], "body string, n int").write.json(f"{work}/other")
    feeds = {"fetch": {"channels": "a,b", "transport": "tests.fake_api:comments", "maxPages": 1, "pageSize": 5}, "fetch-videos": {"kind": "video-search", "channels": "q", "transport": "tests.fake_api:video_search"}}
    table = flow.Table(f"{work}/other", "json", adapters.ColumnMap(text="body", id="n"))
    build = flow.Build(spark, flow.Settings(work, feeds=feeds, tables=(table,), scorer=lambda: lambda texts: [int(t[-1]) / 10 for t in texts], most_rows=9))
    assert build.run("fetch,fetch-tables,fetch-videos") == ["fetch: done", "fetch-tables: done", "fetch-videos: done"]
    assert spark.read.parquet(f"{work}/candidates").groupBy("source").count().count() >= 1
    assert {r.id: r.label for r in spark.read.parquet(f"{work}/labelled").collect()} == {str(i): 0 if i <= 3 else 1 if i >= 7 else -1 for i in range(9)}
    before = spark.read.parquet(f"{work}/labelled").count()
    assert build.run("fetch-tables")[-1] == "fetch-tables: done" and spark.read.parquet(f"{work}/labelled").count() == before


def test_titles_of_searched_videos():
    found = list(apis.video_search(lambda params: fake_api.video_search("", params), "q", 5, 100, 10))
    assert [(r["videoId"], r["title"]) for r in found] == [("v0", "title 0")] * 3 + [("v1", "title 1")] * 3


def test_a_replaced_table_is_recovered(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_table(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / "t.old")
    files.replace_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and not (tmp_path / "t.old").exists()
    (tmp_path / "t").rename(tmp_path / "t.old")
    files.recover(spark, path)
    assert spark.read.parquet(path).count() == 5


def test_model_steps(spark, tmp_path):
    work = str(tmp_path)
    rows = spark.range(200).select(F.concat(F.when(F.col("id") % 2 == 0, "good thing number ").otherwise("bad stuff number "), F.col("id")).alias("text"), (F.col("id") % 2).cast("tinyint").alias("label"), F.lit("s").alias("source"), F.lit("o").alias("origin_label"), F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split_origin"))
    rows.write.parquet(f"{work}/in")
    build = flow.Build(spark, flow.Settings(work, ["stuff"], downloads=(flow.Table(f"{work}/in"),), test_target=40, val_target=10))
    assert build.run("core,model")[-2:] == ["train: done", "finalize: done"]
    (overall,) = spark.read.parquet(f"{work}/evaluation").filter("slice = 'overall'").collect()
    assert overall.accuracy > 0.8


def test_command_line_and_environment(spark, tmp_path, monkeypatch, capsys):
    raw = spark.range(60).select(F.concat(F.lit("some people work on item "), F.col("id")).alias("text"), (F.col("id") % 2).cast("tinyint").alias("label"), F.lit("s").alias("source"), F.lit("o").alias("origin_label"), F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split_origin"))
    raw.write.parquet(str(tmp_path / "raw"))
    (tmp_path / "words.txt").write_text("work\n# comment\n")
    (tmp_path / "everyday.txt").write_text("people\n")
    for name, value in (("VARIANTS", "2"), ("TEST_TARGET", "16"), ("CLEAN_SHARE", "1.0")):
        monkeypatch.setenv(f"LEXILOOM_{name}", value)
    cli.main([str(tmp_path), "--steps", "core", "--targets", str(tmp_path / "words.txt"), "--clean-targets", str(tmp_path / "everyday.txt"), "--val-target", "8", "--test-target", "12"])
    assert "export: done" in capsys.readouterr().out
    done = spark.read.parquet(str(tmp_path / "split"))
    assert done.agg(F.max("variant")).first()[0] == 2 and done.filter("label = 0 AND mutated = 1").count() > 0
    assert 0 < done.filter("split = 'test' AND mutated = 0").count() <= 12


def test_replayed_scans_give_the_same_rows(spark, tmp_path):
    from lexiloom.sources.apis import RescanReader, Scan

    options = {"kind": "board", "channels": "x,y", "transport": "tests.fake_api:board_of_now", "pageSize": "1", "keep": str(tmp_path / "kept")}
    reader = RescanReader(options)
    assert [(s.channel, s.number) for s in reader.partitions({"scan": 0}, {"scan": 2})] == [("x", 2), ("y", 2)] and reader.partitions({"scan": 2}, {"scan": 2}) == []
    first = list(reader.read(Scan("x", 1)))
    assert list(RescanReader(options).read(Scan("x", 1))) == first != list(reader.read(Scan("x", 2)))
