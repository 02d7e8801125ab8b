"""Mixing sources to target weights by temperature, in DataFrame functions only.

Source token shares p become weights p^a / sum of p^a. The exponent a is bisected
in [0, 1] to the greatest at which the weights' entropy reaches ``entropy_share``
of its maximum, log of the number of sources, and again to the least at which no
source is read more than ``max_repeats`` times; the greater of both holds, so the
limit on repeats wins. Entropy falls and repeats fall as a grows.

The weights are realised exactly in documents: a source's budget of tokens is some
whole passes over all its documents and a rest. Documents fall by hash into blocks
of about ``block_docs``; each pass orders blocks, and documents in them, by a hash
of their own. The rest takes whole blocks in the order of the last pass while they
fit, then documents of the next block, the cut one, while they fit. As blocks come in
the order of a hash, a source needs one row to say what is drawn: its whole passes and
its cut block. The cut is found by sums over buckets of the hash, then within one
bucket, and only the documents of cut blocks are put in order; so a source of any size
is spread over tasks, and texts stay where they are.

Tokens are runs of characters other than U+0020 and U+0009 to U+000D. Null source
is a source of its own; null and empty texts hold no tokens and come with each
whole pass. Repeated rows count and are drawn as often as they occur; ties in the
hash order are between equal rows. An empty table, or one without tokens, gives
weights of none and every row once. Columns of other names pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.common import stored, temporary

#: Hex digits of a block's hash that name its bucket.
BUCKET_HEX = 3
#: Sources up to which the table of what is drawn is broadcast.
BROADCAST_SOURCES = 20_000
#: Halvings of the exponent's interval; each job evaluates the exponents of four.
HALVINGS, PER_JOB = 48, 4


@dataclass(frozen=True)
class Mix:
    entropy_share: float = 0.95
    max_repeats: float = 4.0
    budget_share: float = 1.0  #: tokens to draw, as a share of all tokens
    block_docs: int = 128
    seed: str = "mix"


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _hash(*parts) -> Column:
    """MD5 of parts joined by bars; nulls stand as a sign of their own."""
    return F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("∅")) if isinstance(p, Column) else F.lit(p) for p in parts)))


def _key(source: Column) -> Column:
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source))


def _evaluated(shares: DataFrame, exponents: list[float], budget_share: float) -> list[tuple[float, float]]:
    """Entropy of the weights and most repeats, for each exponent: one job of sums over the shares."""
    p = F.col("p")
    sums = [F.struct(F.sum(F.pow(p, a)).alias("z"), F.sum(F.pow(p, a) * F.ln(p)).alias("s"), F.max(F.pow(p, a - 1)).alias("r")) for a in exponents]
    found = shares.agg(F.array(*sums).alias("x")).first()["x"]
    return [(math.log(x["z"]) - a * x["s"] / x["z"], budget_share * x["r"] / x["z"]) for a, x in zip(exponents, found, strict=True)]


def exponent(shares: DataFrame, n_sources: int, mix: Mix) -> float:
    """Bisect the exponent over the shares ``p`` of the sources that hold tokens."""
    target = mix.entropy_share * math.log(n_sources)
    flat, plain = _evaluated(shares, [0.0, 1.0], mix.budget_share)
    ranges = {"entropy": (1.0, 1.0) if plain[0] >= target else (0.0, 1.0), "repeats": (0.0, 0.0) if flat[1] <= mix.max_repeats else (0.0, 1.0)}
    # At the low end entropy reaches its target; at the high end repeats keep to their limit, or nothing does.
    for _ in range(HALVINGS // PER_JOB):
        inner = {k: [lo + (hi - lo) * j / 2**PER_JOB for j in range(2**PER_JOB + 1)] for k, (lo, hi) in ranges.items() if lo < hi}
        if not inner:
            break
        asked = sorted({a for xs in inner.values() for a in xs})
        said = dict(zip(asked, _evaluated(shares, asked, mix.budget_share), strict=True))
        for k, xs in inner.items():
            lo, hi = 0, len(xs) - 1
            while hi - lo > 1:
                mid = (lo + hi) // 2
                low = said[xs[mid]][0] >= target if k == "entropy" else said[xs[mid]][1] > mix.max_repeats
                lo, hi = (mid, hi) if low else (lo, mid)
            ranges[k] = (xs[lo], xs[hi])
    return max(ranges["entropy"][0], ranges["repeats"][1])


def _block(digits: int) -> Column:
    return F.substring("_h", 1, digits) if digits else F.lit("")


def _turn(mix: Mix) -> Column:
    return _hash(mix.seed, "block", F.col("passes"), F.col("_key"), F.col("block"))


def _drawn(keyed: DataFrame, mix: Mix) -> tuple[DataFrame, int, int] | None:
    """What each source gives (k, passes, cut_turn, cut_block, fits), hex digits of a block's name, and the number of sources; None without tokens."""
    slim = stored(keyed.select("_key", "_tokens", "_h"), "mix-documents")
    sources = stored(slim.groupBy("_key").agg(F.sum("_tokens").alias("t"), F.count("*").alias("n")), "mix-sources")
    whole = sources.agg(F.sum("t").alias("t"), F.count(F.when(F.col("t") > 0, 1)).alias("k"), F.max("n").alias("most")).first()
    if not whole.t:
        return None
    digits = 0
    while whole.most > mix.block_docs * 16**digits:
        digits += 1
    block = _block(digits)
    shares = sources.filter("t > 0").select((F.col("t") / whole.t).alias("p"))
    a = exponent(shares, whole.k, mix)
    z = shares.agg(F.sum(F.pow("p", F.lit(a)))).first()[0]
    budget = round(mix.budget_share * whole.t)
    drawn = F.round(F.pow(F.col("t") / whole.t, F.lit(a)) / z * budget).cast("long")
    budgets = sources.withColumn("d", drawn).select(
        F.col("_key").alias("k"), F.when(F.col("t") > 0, F.expr("d div nullif(t, 0)")).otherwise(1).cast("int").alias("passes"), F.when(F.col("t") > 0, F.expr("d % nullif(t, 0)")).otherwise(0).alias("rest")
    )

    turn = _turn(mix)
    blocks = slim.groupBy("_key", block.alias("block")).agg(F.sum("_tokens").alias("t")).join(budgets, F.col("_key") == F.col("k")).drop("k")
    blocks = stored(blocks.withColumn("turn", turn).withColumn("bucket", F.substring("turn", 1, BUCKET_HEX)), "mix-blocks")
    # Bucket sums first, then the blocks of the one bucket in which the rest ends.
    before = lambda order: F.coalesce(F.sum("t").over(Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = lambda order: F.row_number().over(Window.partitionBy("_key").orderBy(*order))
    over = F.col("before") + F.col("t") > F.col("rest")
    buckets = blocks.groupBy("_key", "rest", "bucket").agg(F.sum("t").alias("t")).withColumn("before", before(["bucket"])).filter(over).withColumn("nth", first(["bucket"]))
    ends = stored(buckets.filter("nth = 1").select(F.col("_key").alias("k"), F.col("bucket").alias("b"), F.col("before").alias("base")), "mix-buckets")
    within = blocks.join(ends, (F.col("_key") == F.col("k")) & (F.col("bucket") == F.col("b"))).drop("k", "b").withColumn("before", F.col("base") + before(["turn", "block"]))
    cuts = within.filter(over).withColumn("nth", first(["turn", "block"])).filter("nth = 1")
    cuts = cuts.select(F.col("_key").alias("ck"), F.col("turn").alias("cut_turn"), F.col("block").alias("cut_block"), (F.col("rest") - F.col("before")).alias("fits"))
    drawn = stored(budgets.join(cuts, F.col("k") == F.col("ck"), "left").drop("ck", "rest", "d"), "mix-drawn")
    return drawn, digits, sources.count()


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, source and others), each as often as its source's budget asks, with epoch (from 0) and block.

    Columns named epoch or block are replaced.
    """
    names = [c for c in docs.columns if c not in ("epoch", "block")]
    shown = [F.col(f"row.`{c}`").alias(c) for c in names]
    keyed = docs.select(F.struct(*docs.columns).alias("row"), _key(F.col("source")).alias("_key"), tokens_of(F.col("text")).alias("_tokens"), _hash(mix.seed, F.col("doc_id"), F.md5("text")).alias("_h"))
    with temporary(keep_last=True):
        said = _drawn(keyed, mix)
    if said is None:
        return docs.select(*names, F.lit(0).alias("epoch"), F.lit("").alias("block"))
    drawn, digits, few = said
    block = _block(digits)
    placed = keyed.withColumn("block", block).join(F.broadcast(drawn) if few <= BROADCAST_SOURCES else drawn, F.col("_key") == F.col("k")).withColumn("turn", _turn(mix))
    is_cut = F.coalesce((F.col("turn") == F.col("cut_turn")) & (F.col("block") == F.col("cut_block")), F.lit(False))
    # Without a cut the rest holds all blocks; with one, all that come before it.
    whole_block = F.col("cut_turn").isNull() | (F.struct("turn", "block") < F.struct(F.col("cut_turn"), F.col("cut_block")))
    inside = Window.partitionBy("_key", "block").orderBy(_hash(mix.seed, "doc", F.col("passes"), F.col("_h")), "_h")
    cut = placed.filter(is_cut & (F.col("fits") > 0)).withColumn("_to", F.sum("_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    cut = cut.withColumn("_times", F.col("passes") + (F.col("_to") <= F.col("fits")).cast("int")).drop("_to")
    plain = placed.filter(~(is_cut & (F.col("fits") > 0))).withColumn("_times", F.col("passes") + (whole_block & ~is_cut).cast("int"))
    times = plain.unionByName(cut)
    return times.filter("_times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.col("_times") - 1).cast("int")))).select(*shown, "epoch", "block")
