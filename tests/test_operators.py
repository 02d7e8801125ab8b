import pytest
from pyspark.sql import functions as F

from lexiloom.operators import cluster, curate, dedup, fanout, metrics, sampling, scoring, split, stats
from lexiloom.schemas import BANK, EXPORT, UNIFIED, conform, fields


def rows(spark, n=240):
    return spark.range(n).select(
        F.concat(F.lit("word number "), (F.col("id") % 200).cast("string"), F.lit(" and more")).alias("text"), (F.col("id") % 3 == 0).cast("int").alias("label"),
        F.concat(F.lit("s"), F.col("id") % 4).alias("source"), F.lit("x").alias("origin_label"), F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split_origin"), F.col("id").alias("ord"),
    )


def same(a, b):
    return sorted(map(repr, map(tuple, a.collect()))) == sorted(map(repr, map(tuple, b.collect())))


def test_keep_first_follows_order_and_is_idempotent(spark):
    df = spark.createDataFrame([("Same ", 1, "b", 2), ("same", 0, "a", 3), ("other", 1, "b", 1), (None, 0, "a", 9)], "text string, label int, source string, ord int")
    once = dedup.dedup_exact(df, ["source", "ord"])
    assert {(r.text, r.source) for r in once.collect()} == {("same", "a"), ("other", "b"), (None, "a")}
    assert same(once, dedup.dedup_exact(once, ["source", "ord"]))


def test_keep_first_does_not_depend_on_partitions(spark):
    df = rows(spark)
    assert same(dedup.dedup_text(df.repartition(1), ["ord"]), dedup.dedup_text(df.repartition(7), ["ord"]))


def test_normalize_bounds(spark):
    df = spark.createDataFrame([("a b", 1), ("a b c", 2), (" ".join(["x"] * 512), 3), (" ".join(["y"] * 513), 4)], "text string, ord int")
    assert {r.ord for r in dedup.normalize(df, ["ord"]).collect()} == {2, 3}


def test_union_first_and_added(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "text string, ord int")
    new = spark.createDataFrame([("b", 2), ("c", 2), ("c", 3)], "text string, ord int")
    assert {(r.text, r.ord) for r in dedup.union_first(old, new, order=["ord"]).collect()} == {("a", 1), ("b", 1), ("c", 2)}
    assert {(r.text, r.ord) for r in dedup.added(old, new, ["ord"]).collect()} == {("c", 2)}


def test_clusters(spark):
    df = spark.createDataFrame([("please", 0), ("p.l.e.a.s.e", 1), ("other", 2), ("!!!", 3), ("???", 4)], "text string, ord int")
    ids = {r.ord: r.cluster for r in cluster.assign_clusters(df, ["ord"], dense=True).collect()}
    assert ids == {0: 0, 1: 0, 2: 1, 3: 2, 4: 2}
    apart = {r.ord: r.cluster for r in cluster.assign_clusters(df, ["ord"], split_empty=True).collect()}
    assert apart[0] == apart[1] and apart[3] != apart[4]


def test_cluster_label_tie_is_the_smaller(spark):
    df = spark.createDataFrame([(1, 1, "a", "t", 0), (1, 0, "b", "u", 1)], "cluster int, label int, source string, split_origin string, ord int")
    r = cluster.cluster_table(df, ["ord"]).first()
    assert (r["size"], r.label, r.first_label, r.source) == (2, 0, 1, "a")


def test_split_keeps_clusters_together_and_bounds_overshoot(spark):
    df = rows(spark).withColumn("cluster", F.col("ord") % 60)
    parted = split.assign_split(df, ["ord"], 40, 30).cache()
    assert parted.count() == df.count()
    assert parted.groupBy("cluster").agg(F.countDistinct("split").alias("n")).filter("n > 1").isEmpty()
    table = cluster.cluster_table(df, ["ord"])
    most = table.agg(F.max("size")).first()[0]
    for target, name in ((20, "test"), (15, "validation")):
        picked = table.join(parted.filter(F.col("split") == name).select("cluster").distinct(), "cluster").groupBy("label").agg(F.sum("size").alias("n")).collect()
        assert all(r.n < target + most for r in picked)
    assert same(parted.select("ord", "split"), split.assign_split(df.repartition(7), ["ord"], 40, 30).select("ord", "split"))


def test_greedy_overshoot(spark):
    table = spark.createDataFrame([("a", 3, 1), ("b", 3, 1), ("c", 3, 1)], "cluster string, size long, label int")
    assert split.pick(table, 5, "t").count() == 2


def test_rebalance(spark):
    df = rows(spark).withColumn("cluster", F.col("ord")).withColumn("split", F.when(F.col("ord") % 10 == 0, "test").otherwise("train"))
    done = split.rebalance(df, ["ord"])
    n = {r.label: r.n for r in done.filter("split = 'train'").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert n[0] == n[1] and done.filter("split = 'test'").count() == 24
    assert same(done, split.rebalance(done, ["ord"]))


def test_samples(spark):
    df = rows(spark)
    assert sampling.sample_n(df, ["ord"], 17).count() == 17 and sampling.sample_n(df, ["ord"], 999).count() == 240
    assert sampling.sample_fraction(df, ["ord"], 0.33).count() == 79 and sampling.sample_fraction(df, ["ord"], 0.0, 1).count() == 1
    capped = {(r.source, r.label): r.n for r in sampling.cap_per_source(df, ["ord"], 5, 0).groupBy("source", "label").agg(F.count("*").alias("n")).collect()}
    assert all(n == 5 for (_, y), n in capped.items() if y == 1) and all(n == 40 for (_, y), n in capped.items() if y == 0)
    ratio = {r.label: r.n for r in sampling.keep_ratio(df, ["ord"], 50).groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert ratio == {1: 17, 0: 33}


def test_largest_remainder(spark):
    df = spark.range(10).select(F.when(F.col("id") < 7, 0).otherwise(1).alias("label"), "id")
    assert {r.label: r.quota for r in sampling.quotas(df, 5).collect()} in ({0: 4, 1: 1}, {0: 3, 1: 2})
    assert sampling.stratified(df, ["id"], 5).count() == 5 and sampling.stratified(df, ["id"], 50).count() == 10


def test_caps():
    assert sampling.parse_caps(" a=1, b=c=2,") == {"a": 1, "b=c": 2} and sampling.parse_caps("") == {}
    with pytest.raises(ValueError):
        sampling.parse_caps("oops")


def test_empty_tables(spark):
    df = rows(spark).limit(0)
    assert dedup.dedup_exact(df, ["ord"]).count() == sampling.sample_n(df, ["ord"], 5).count() == sampling.stratified(df, ["ord"], 5).count() == 0
    assert split.assign_split(df.withColumn("cluster", F.lit(1)), ["ord"], 4, 4).count() == 0
    assert metrics.metrics(df.withColumn("pred", F.lit(1))).first().asDict() == {"rows": 0, "accuracy": 0.0, "precision": 0.0, "recall": 0.0, "f1": 0.0}


def test_metrics(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 0, "b"), (0, 0, "a")], "label int, pred int, source string")
    r = metrics.metrics(df).first()
    assert (r.rows, r.precision, r.recall, r.f1) == (3, 0.0, 0.0, 0.0) and abs(r.accuracy - 1 / 3) < 1e-9
    sliced = {(r.slice, r.value): r.rows for r in metrics.sliced_metrics(df, ["source"]).collect()}
    assert sliced == {("overall", "all"): 3, ("source", "a"): 2, ("source", "b"): 1}


def test_label_map(spark):
    names = spark.createDataFrame([("OK", 9), ("H", 9), ("1", 2), ("odd", 2), ("Toxic", 2), ("mine", 2)], "name string, n int")
    found = {r.name: r.y for r in names.select("name", metrics.reduce_label(F.col("name"), F.col("n"), {"mine": 0}).alias("y")).collect()}
    assert found == {"OK": 0, "H": 1, "1": 1, "odd": None, "Toxic": 1, "mine": 0}


def test_checkpoints_and_logs(spark):
    log = spark.createDataFrame([("checkpoint-9", 1, 0.9), ("checkpoint-9", 2, 0.5), ("checkpoint-10", 3, 0.6), ("checkpoint-2", 4, 0.6)], "checkpoint string, step int, f1 double")
    assert metrics.best_checkpoint(log).first().checkpoint == "checkpoint-10" and metrics.latest_checkpoint(log).first().checkpoint == "checkpoint-10"
    lines = spark.createDataFrame([("  t1: f1=0.5 accuracy=0.75",), ("noise",)], "value string")
    assert {tuple(r) for r in metrics.parse_metric_log(lines).collect()} == {("t1", "f1", 0.5), ("t1", "accuracy", 0.75)}
    assert metrics.parse_metric_log(lines, True).first().value == 50.0


def test_grey_zone_and_banks(spark):
    df = spark.createDataFrame([("grey", 0.70, 1), ("grey", 0.30, 2), ("grey", 0.31, 3), ("attack", 0.1, 4), ("clean", 0.95, 5), ("emotional", 0.5, 6)], "category string, p double, id int")
    done = curate.assign_grey(curate.banks(df))
    assert {r.id: (r.bank, r.label) for r in done.collect()} == {1: ("A", 1), 2: ("C", 0), 3: ("manual", -1), 4: ("A", 1), 5: ("C", 0), 6: ("B", 0)}
    checked = curate.verify(done, ["id"], grey=curate.Grey(verify_share=1.0))
    assert {r.id for r in checked.filter("origin_label = 'verify-disagree'").collect()} == {4, 5}
    assert {r.id for r in curate.combine_banks(checked, ["id"], {"A": 9, "B": 9, "C": 9}).collect()} == {1, 2, 6}
    labelled = {r.id: (r.label, r.origin_label) for r in curate.model_labels(df, "p").collect()}
    assert labelled[3] == (-1, "model_0.310") and labelled[1][0] == 1 and labelled[2][0] == 0


def test_review(spark):
    df = spark.createDataFrame([("a", -1, "attack"), ("b", -1, "grey"), ("c", 1, "clean"), ("d", -1, "clean")], "text string, label int, category string")
    fixes = spark.createDataFrame([("a", 1), ("c", 0), ("d", 7)], "text string, label int")
    assert {r.text: r.label for r in curate.apply_fixes(df, fixes).collect()} == {"a": 1, "b": -1, "c": 1, "d": -1}
    assert {r.text: r.label for r in curate.fallback_labels(df).collect()} == {"a": 1, "c": 1, "d": 0}


def test_fan_out(spark):
    df = spark.createDataFrame([("we work and work with work here", "s", 1), ("nothing to be", "s", 2), ("a b", "s", 3)], "text string, source string, ord int")
    done = fanout.fan_out_offensive(df, ["work"], 3).collect()
    assert len(done) == 12 and all(r.text == r.base_text for r in done if r.variant == 0)
    for r in done:
        if r.ord == 1 and r.variant:
            assert r.text != r.base_text and r.text.endswith("with work here")
        if r.ord == 3 and r.variant in (1, 2):
            assert r.text == "a b"
    clean = fanout.fan_out_clean(df, ["ord"], ["work"], 1.0).collect()
    assert len(clean) == 4 and sum(r.mutated for r in clean) == 1
    whole = fanout.mutate(df.withColumn("label", F.when(F.col("ord") == 1, 1).otherwise(0)), ["ord"], ["work"], ["work"])
    assert whole.count() == whole.select("text").distinct().count()


def test_lineage_keeps_variants_with_their_base(spark):
    df = spark.createDataFrame([("we work and work with people", "s", 1)], "text string, source string, ord int")
    assert cluster.lineage_clusters(fanout.fan_out_offensive(df, ["work"], 3)).select("cluster").distinct().count() == 1


def test_scoring(spark):
    df = rows(spark)
    model = scoring.train(df.select(F.when(F.col("label") == 1, "bad thing").otherwise("good thing").alias("text"), "label"), 1 << 10)
    said = {r.text: r.label for r in scoring.predict(model, spark.createDataFrame([("bad thing",), ("good thing",), ("  ",)], "text string")).collect()}
    assert said == {"bad thing": 1, "good thing": 0}
    scored = scoring.score_with(df, lambda: lambda texts: [len(t) / 100 for t in texts])
    assert scored.count() == 240 and scored.filter("abs(p - length(text) / 100) > 1e-6").isEmpty()


def test_report_counts_obfuscated_as_a_split_of_its_own(spark):
    df = rows(spark).withColumn("split", F.when(F.col("ord") < 100, "test").otherwise("train")).withColumn("mutated", (F.col("ord") % 2).cast("int"))
    found = {(r.split): r.n for r in stats.report(split.with_obfuscated(df)).filter("kind = 'splits'").collect()}
    assert found == {"test": 100, "train": 140, "test_obfuscated": 50}


def test_conform(spark):
    df = conform(spark.createDataFrame([("a", 1)], "text string, extra int"), UNIFIED)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == fields(UNIFIED) and df.first().label is None
    assert "cluster" in dict(fields(EXPORT)) and "conf" in dict(fields(BANK))


def test_score_baseline_trains_with_the_operators_defaults(spark, monkeypatch):
    from lexiloom.operators import scoring
    from lexiloom.plans import catalog

    used, train = [], scoring.train
    monkeypatch.setattr(scoring, "train", lambda *a, **b: used.append(train(*a, **b)) or used[0])
    assert catalog.QUERIES["score_baseline"](spark, "/root/testdata/sf0.001").count() > 0
    stages = used[0].stages
    assert (stages[1].getNumFeatures(), stages[2].getMaxIter()) == (1 << 18, 20)
