"""Steps, presets and the run of a corpus build from raw tables to an export.

Stages are lazy and chained; what is expensive or read several times (mutated rows,
split rows) is written once. Steps run in a fixed order, whatever order they are
named in; steps whose input is missing are skipped and reported. (EXT-01 to EXT-04)

Rows that neither lexicon nor model decides go to ``manual`` with label -1 and are
never dropped unseen: the step ``review`` writes them to CSV files and the run stops
there; the next run takes the labels that were filled in and goes on without the rest.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.chance import SEED
from lexiloom.functions.lexicon import Lexicon, prefilter, with_category
from lexiloom.functions.text import clean_text
from lexiloom.operators import curate, dedup, fanout, metrics, sampling, scoring, split, stats
from lexiloom.operators.cluster import assign_clusters, lineage_clusters
from lexiloom.schemas import LABELLED, SPLIT, UNIFIED, conform
from lexiloom.sources import adapters, apis, files

STEPS = ["download", "fetch", "fetch-boards", "fetch-tables", "fetch-videos", "curate", "review", "merge", "merge-labelled", "subsample", "normalize", "mutate", "dedup", "split", "balance", "export", "train", "finalize"]
PRESETS = {
    "core": "download,normalize,mutate,dedup,split,export",
    "comments": "fetch,curate,review,merge,subsample,core",
    "community": "comments,fetch-boards,fetch-tables,fetch-videos,merge-labelled",
    "balanced": "core,balance",
    "all": "community,balance",
    "model": "train,finalize",
}
#: Stands for an empty word list; no word is this.
NO_WORDS = ["\0"]
#: The channels' records of each fetching step as candidates.
RECORDS = {"fetch": adapters.comment_records, "fetch-boards": adapters.post_records, "fetch-videos": adapters.from_video_comments}


def resolve(steps: str) -> list[str]:
    """Steps of a comma-separated list of steps and presets, each once, in the fixed order. (EXT-02)"""
    found: set[str] = set()
    for name in filter(None, (s.strip() for s in steps.split(","))):
        if name in PRESETS:
            found |= set(resolve(PRESETS[name]))
        elif name in STEPS:
            found.add(name)
        else:
            raise ValueError(f"unknown step {name!r}; choose from {', '.join([*STEPS, *PRESETS])}")
    return [s for s in STEPS if s in found]


@dataclass(frozen=True)
class Table:
    """A table to read: its path and format, and how its columns are named (candidates) or labelled (an adapter of unified rows)."""

    path: str
    form: str = "parquet"
    columns: adapters.ColumnMap | None = None
    adapter: Callable[[DataFrame], DataFrame] | None = None


class ReviewNeeded(Exception):
    """Undecided rows were written for review; run the same steps again once they are labelled."""


@dataclass
class Settings:
    work: str
    targets: list[str] = field(default_factory=list)
    clean_targets: list[str] = field(default_factory=list)  #: everyday words that clean rows may have changed
    lexicon: Lexicon = field(default_factory=Lexicon)
    downloads: tuple[Table, ...] = ()  #: labelled tables for ``raw``
    tables: tuple[Table, ...] = ()  #: tables of candidates that a model labels
    feeds: dict[str, dict] = field(default_factory=dict)  #: options of the paged API for each fetching step
    scorer: scoring.Scorer | None = None  #: decides grey rows and tables of candidates
    grey: curate.Grey = field(default_factory=curate.Grey)
    by_lexicon: bool = False  #: label undecided rows by category instead of asking for a review
    clean_kept: float = 1.0  #: share of clean candidates that a table keeps
    most_rows: int = 0  #: rows that a table is read up to; 0 is all
    least_words: int = 3
    most_words: int = 512
    variants: int = 3
    clean_share: float = 0.4
    most_pos: int = 0
    most_neg: int = 0
    test_target: int = 30_000
    val_target: int = 20_000
    held_out: tuple[str, ...] = split.HELD_OUT
    source_caps: str = ""
    bank_targets: dict[str, int] = field(default_factory=lambda: {"A": 200_000, "B": 200_000, "C": 200_000})
    lineage: bool = True  #: clusters by the text a variant was made from, so that none leaks
    seed: int = SEED


class Build:
    """A run over one working folder: ``raw`` (unified tables), ``candidates``, then a folder per stage."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.s = spark, settings
        self.log: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.s.work}/{name}"

    def has(self, name: str) -> bool:
        files.recover(self.spark, self.path(name))
        return files.has_files(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def write(self, df: DataFrame, name: str) -> None:
        files.replace_table(df, self.path(name))

    def run(self, steps: str) -> list[str]:
        for step in resolve(steps):
            try:
                done = getattr(self, step.replace("-", "_"))()
            except ReviewNeeded as e:
                self.log.append(f"{step}: {e}")
                break
            self.log.append(f"{step}: {'done' if done else 'skipped'}")
        return self.log

    def scored(self, df: DataFrame) -> DataFrame:
        """Rows with the model's chance of label 1 as ``p``."""
        return scoring.score_with(df, self.s.scorer)

    def load(self, table: Table) -> DataFrame:
        rows = self.spark.read.format(table.form).load(table.path)
        return rows.limit(self.s.most_rows) if self.s.most_rows else rows

    def download(self) -> bool:
        if not self.s.downloads:
            return False
        self.write(dedup.union_all(*(conform(t.adapter(self.load(t)) if t.adapter else self.load(t), UNIFIED) for t in self.s.downloads)), "raw")
        return True

    def _fetch(self, step: str) -> bool:
        if step not in self.s.feeds:
            return False
        apis.register(self.spark)
        rows = adapters.usable(RECORDS[step](self.spark.read.format("paged_api").options(**self.s.feeds[step]).load()))
        files.append_shards(rows, self.path("candidates"))
        return True

    def fetch(self) -> bool:
        return self._fetch("fetch")

    def fetch_boards(self) -> bool:
        return self._fetch("fetch-boards")

    def fetch_videos(self) -> bool:
        return self._fetch("fetch-videos")

    def fetch_tables(self) -> bool:
        """Candidates of other tables, labelled by the model; shards of rows already written are not written again. (MDL-01, MDL-02, CLS-11)"""
        if not self.s.tables or self.s.scorer is None:
            return False
        for table in self.s.tables:
            rows = with_category(adapters.usable(adapters.adapt(self.load(table), table.columns or adapters.ColumnMap())), self.s.lexicon)
            kept = prefilter(rows, ["id", "text"], self.s.clean_kept)
            files.append_shards(conform(curate.model_labels(self.scored(kept), "p", self.s.grey), LABELLED + ", category string"), self.path("labelled"))
        return True

    def curate(self) -> bool:
        """Banks by category; the model decides grey rows and checks a sample of the banks, what it leaves open goes to ``manual``."""
        if not self.has("candidates"):
            return False
        rows = with_category(self.read("candidates").select("text", "source", "subreddit", "created_utc", "score", "id"), self.s.lexicon)
        banked = curate.banks(dedup.dedup_text(rows, ["id"])).withColumn("split_origin", F.lit("train"))
        grey, told = banked.filter("bank = 'grey'"), banked.filter("bank <> 'grey'").withColumn("conf", F.lit(None).cast("float"))
        if self.s.scorer is None:
            grey = grey.withColumns({"bank": F.lit("manual"), "label": F.lit(-1).cast("tinyint"), "conf": F.lit(None).cast("float")})
        else:
            grey = curate.assign_grey(self.scored(grey), grey=self.s.grey).drop("p")
            told = curate.verify(told, ["text"], grey=self.s.grey, seed=self.s.seed, score=self.scored)
        self.write(told.unionByName(grey), "curated")
        every = self.read("curated")
        self.write(every.filter("bank = 'manual'"), "manual")
        self.write(curate.combine_banks(every, ["id", "text"], self.s.bank_targets, self.s.seed), "banks")
        return True

    def review(self) -> bool:
        """Decide rows with label -1: by category if asked, else by a review of the CSV files that are written for it. (MRG-03, JN-05, JN-09, AGG-13)"""
        open_ = {n: self.read(n) for n in ("manual", "labelled") if self.has(n)}
        undecided = {n: stats.undecided_by_file(df) for n, df in open_.items() if not df.filter("label = -1").isEmpty()}
        if not undecided:
            return False
        if not self.s.by_lexicon and not self.has("review"):
            files.write_review(dedup.union_all(*(open_[n].select("text", "origin_label", "label") for n in undecided)), self.path("review"))
            each = ", ".join(f"{n}/{r.file} {r.n}" for n, df in undecided.items() for r in df.orderBy("file").limit(100).collect())
            raise ReviewNeeded(f"waiting for labels in {self.path('review')} ({each})")
        for n in undecided:
            rows = open_[n]
            if self.s.by_lexicon:
                self.write(curate.fallback_labels(rows), n)
            else:
                self.write(curate.apply_fixes(rows, files.read_review(self.spark, self.path("review"))), n)
        return True

    def merge(self) -> bool:
        if not self.has("banks"):
            return False
        found = [self.read(n) for n in ("banks", "manual") if self.has(n)]
        self.write(conform(curate.merge_banks(*found, order=["id"]), UNIFIED), "community")
        return True

    def merge_labelled(self) -> bool:
        if not self.has("labelled"):
            return False
        new = conform(self.read("labelled"), UNIFIED)
        old = self.read("community") if self.has("community") else new.limit(0)
        self.write(curate.merge_labelled(old, new, ["source", "text"])[0], "community")
        return True

    def subsample(self) -> bool:
        if not self.s.source_caps or not self.has("community"):
            return False
        self.write(sampling.subsample_sources(self.read("community"), sampling.parse_caps(self.s.source_caps), ["text"], ["text"], self.s.seed), "community")
        return True

    def normalize(self) -> bool:
        found = [self.read(n) for n in ("raw", "community") if self.has(n)]
        if not found:
            return False
        rows = dedup.union_all(*(conform(f, UNIFIED) for f in found)).withColumn("text", clean_text(F.col("text"))).filter("text <> ''")
        self.write(dedup.normalize(rows, ["source", "text"], self.s.least_words, self.s.most_words), "normalized")
        return True

    def mutate(self) -> bool:
        if not self.has("normalized"):
            return False
        rows = sampling.cap_per_source(self.read("normalized"), ["text"], self.s.most_pos, self.s.most_neg, self.s.seed) if self.s.most_pos or self.s.most_neg else self.read("normalized")
        keyed = rows.withColumn("key", F.md5(F.concat_ws("|", "source", "text")))
        self.write(fanout.mutate(keyed, ["key"], self.s.targets or NO_WORDS, self.s.clean_targets or NO_WORDS, variants=self.s.variants, clean_share=self.s.clean_share, seed=self.s.seed).drop("key"), "mutated")
        return True

    def dedup(self) -> bool:
        if not self.has("mutated"):
            return False
        rows = self.read("mutated")
        kept = lineage_clusters(dedup.dedup_exact(rows, ["label", "mutated", "source", "variant"])) if self.s.lineage else assign_clusters(rows, ["label", "mutated", "source", "variant"])
        self.write(kept, "deduped")
        return True

    def split(self) -> bool:
        if not self.has("deduped"):
            return False
        parted = split.assign_split(self.read("deduped"), ["mutated", "source", "text"], self.s.test_target, self.s.val_target, self.s.held_out, self.s.seed)
        self.write(conform(parted, SPLIT), "split")
        return True

    def balance(self) -> bool:
        if not self.has("split"):
            return False
        self.write(split.rebalance(self.read("split"), ["mutated", "source", "text"], self.s.seed), "split")
        return True

    def export(self) -> bool:
        if not self.has("split"):
            return False
        rows = self.read("split")
        files.export(rows, self.path("dataset"))
        found = files.statistics(rows)
        self.spark.createDataFrame([(json.dumps(found, sort_keys=True), files.card(found))], "stats string, card string").coalesce(1).write.mode("overwrite").json(self.path("report"))
        return True

    def train(self) -> bool:
        """Fit the baseline on the train split. (TRN-01)"""
        if not self.has("dataset"):
            return False
        scoring.train(files.read_split(self.spark, self.path("dataset")).filter("split = 'train'")).write().overwrite().save(self.path("model"))
        return True

    def finalize(self) -> bool:
        """Measure the model on both test splits, in all and by slice. (EVL-01, AGG-09)"""
        if not self.has("model"):
            return False
        rows = files.read_split(self.spark, self.path("dataset")).filter("split IN ('test', 'test_obfuscated')")
        said = scoring.predict(PipelineModel.load(self.path("model")), rows.withColumnRenamed("label", "told"))
        said = said.select(F.col("told").cast("int").alias("label"), F.col("label").alias("pred"), F.col("split").alias("benchmark_split"), "source", "mutated")
        self.write(metrics.sliced_metrics(said), "evaluation")
        return True
