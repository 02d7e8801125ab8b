"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step is a grouped minimum, written to the shared folder, and an equi-join of the
links with it. Grouping merges a hub's links before they move; the join's two sides
are plain shuffles, so a hub's partition can be split. No task gathers a node's
neighbours. Every round ends in a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import discard, shared_dir, stored


def _least(pairs: DataFrame) -> DataFrame:
    """Least neighbour of each left node, or the node itself if that is less."""
    return stored(pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("u", "m").alias("m")), "least")


def _large_star(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both)
    return both.join(least, F.col("u") == F.col("of")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), least


def _small_star(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("of").alias("u"), F.col("m").alias("v"))), least


def _settled(links: DataFrame) -> tuple[DataFrame, tuple]:
    done = links.filter("u <> v").distinct().checkpoint()
    return done, tuple(done.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (u, v of one orderable type); root is the least node reachable.

    Repeated links, links both ways and links of a node with itself are allowed;
    links with a null end are ignored. Without links the result is empty. A root is
    listed with itself; nodes that occur only in links with themselves are not listed.
    """
    shared_dir(links.sparkSession)
    now, state = _settled(links.dropna(subset=["u", "v"]))
    while state[0]:
        larger, first = _large_star(now)
        smaller, second = _small_star(larger)
        now, after = _settled(smaller)
        discard(first, second)
        if after == state:
            break
        state = after
    named = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return named.unionByName(named.select(F.col("root").alias("node"), "root").distinct())
