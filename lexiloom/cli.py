"""Command line of the corpus build: ``python -m lexiloom.cli WORK --steps core --targets words.txt``."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from lexiloom.functions.lexicon import Lexicon, read_words
from lexiloom.plans.flow import PRESETS, STEPS, Build, Settings, Table


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("work", help="folder with raw/ (unified tables) or candidates/")
    ap.add_argument("--steps", default="core", help=f"of {', '.join(STEPS)} or {', '.join(PRESETS)}")
    ap.add_argument("--targets", help="file of words to vary in offensive rows")
    ap.add_argument("--clean-targets", help="file of everyday words to vary in clean rows")
    ap.add_argument("--expletives", help="file of expletives")
    ap.add_argument("--insults", help="file of insults")
    ap.add_argument("--pronouns", default="you,your,yours,u", help="second-person words")
    ap.add_argument("--source-caps", default="", help="source=n,source=n")
    for name, kind in (("variants", int), ("clean-share", float), ("least-words", int), ("most-words", int), ("most-pos", int), ("most-neg", int), ("test-target", int), ("val-target", int), ("seed", int)):
        ap.add_argument(f"--{name}", type=kind)
    ap.add_argument("--by-lexicon", action="store_true", help="label undecided rows by category instead of stopping for a review")
    ap.add_argument("--keep-ratio-of-clean", dest="clean_kept", type=float, help="share of clean candidates that tables keep")
    ap.add_argument("--most-rows", type=int, help="rows that a table is read up to")
    ap.add_argument("--feed", action="append", default=[], metavar="STEP:KEY=VALUE,...", help="options of the paged API for a fetching step")
    ap.add_argument("--table", action="append", default=[], metavar="FORMAT:PATH", help="a table of candidates")
    ap.add_argument("--held-out", help="sources whose clusters may go to test, by commas")
    # Settings that the environment gives, as LEXILOOM_TEST_TARGET=100, hold where the command line says nothing.
    given = {k.removeprefix("LEXILOOM_").lower(): v for k, v in os.environ.items() if k.startswith("LEXILOOM_")}
    ap.set_defaults(**{k: v for k, v in given.items() if k not in ("feed", "table")})
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("lexiloom").getOrCreate()
    words = lambda path: tuple(read_words(spark, path)) if path else ()
    given = {k: v for k in ("variants", "clean_share", "least_words", "most_words", "most_pos", "most_neg", "test_target", "val_target", "seed", "by_lexicon", "clean_kept", "most_rows") if (v := getattr(a, k)) is not None}
    lexicon = Lexicon(words(a.expletives), words(a.insults), tuple(filter(None, a.pronouns.split(","))))
    feeds = {step: dict(o.split("=", 1) for o in said.split(",")) for step, _, said in (f.partition(":") for f in a.feed)}
    tables = tuple(Table(path, form) for form, _, path in (t.partition(":") for t in a.table))
    if a.held_out:
        given["held_out"] = tuple(a.held_out.split(","))
    settings = Settings(a.work, targets=list(words(a.targets)), clean_targets=list(words(a.clean_targets)), lexicon=lexicon, source_caps=a.source_caps, feeds=feeds, tables=tables, **given)
    print("\n".join(Build(spark, settings).run(a.steps)))


if __name__ == "__main__":
    main()
