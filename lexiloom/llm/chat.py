"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A turn is rendered as ``[role]text</s>``. Inside role and text the characters
that begin a control string are escaped (``&`` to ``&a``, ``<`` to ``&l``, ``[``
to ``&s``, ``]`` to ``&e``), so no text can close a turn or open one, and the
escape is undone exactly.

Every assistant turn becomes an example of its own: its prefix, all preceding turns
as rendered, is its context, and the loss mask covers that reply's escaped text
alone. Prefixes are made row by row from a running list of a conversation's pieces:
n turns give at most n rows, but n * n / 2 pieces of text, so time grows with the
square of a conversation's turns; ``read_back`` takes digests of each prefix within
the stage that makes it, so none is shuffled or kept.

Null role and null text count as empty. Turns are ordered by (turn, role, text),
nulls first, so repeated and tied rows have one order; repeats are kept. Rows of
null conv_id make up one conversation. Other columns are ignored. A conversation
is rendered into one string and must fit the 2 GB of a Spark string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, END = "[", "]", "</s>"


def escape(text: Column) -> Column:
    for raw, safe in (("&", "&a"), ("<", "&l"), ("[", "&s"), ("]", "&e")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in (("]", "&e"), ("[", "&s"), ("<", "&l"), ("&", "&a")):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def render_turns(conversations: DataFrame, target_role: str = "assistant") -> DataFrame:
    """One row per turn: its rendered piece and where it lies in its conversation.

    ``context_chars`` counts the characters of all preceding turns; the loss mask
    is ``mask_chars`` characters from ``mask_at`` (counted from 0 in the piece),
    and zero characters for turns that are only context.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role_", "text_")
    role, text = escape(F.col("role_")), escape(F.col("text_"))
    trainable = F.col("role_") == target_role
    return (
        conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role_"), F.coalesce("text", F.lit("")).alias("text_"))
        .select("conv_id", F.row_number().over(order).alias("position"), "turn", "role_", "text_")
        .select(
            "conv_id", "position", trainable.alias("trainable"),
            F.concat(F.lit(OPEN), role, F.lit(CLOSE), text, F.lit(END)).alias("piece"),
            (F.length(role) + 2).alias("mask_at"), F.when(trainable, F.length(text)).otherwise(0).alias("mask_chars"),
        )
        .withColumn("context_chars", F.sum(F.length("piece").cast("long")).over(Window.partitionBy("conv_id").orderBy("position")) - F.length("piece"))
    )


def expand_targets(turns: DataFrame) -> DataFrame:
    """One example per assistant turn: its whole prefix, the reply's piece and its mask.

    ``known_chars`` counts the characters of the prefix that the example before it holds already.
    """
    before = Window.partitionBy("conv_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    known = F.coalesce(F.max(F.when(F.col("trainable"), F.col("context_chars"))).over(before), F.lit(0).cast("long"))
    return (
        turns.select("*", F.collect_list("piece").over(before).alias("pieces"), known.alias("known_chars"))
        .filter("trainable")
        .select("conv_id", "position", (F.col("position") - 1).alias("context_turns"), "context_chars", "known_chars", F.array_join("pieces", "").alias("context"), F.col("piece").alias("target"), "mask_at", "mask_chars")
    )


def materialise(turns: DataFrame) -> DataFrame:
    """Examples as plain text: the whole prefix, then the reply; mask offsets count from the text's start."""
    return expand_targets(turns).select("conv_id", "position", F.concat("context", "target").alias("text"), (F.col("context_chars") + F.col("mask_at")).alias("mask_start"), "mask_chars")


def read_back(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """Parse the rendered conversations, the examples' masks and their contexts into one row of digests per conversation.

    Role and text of each turn come from parsing the whole rendered string, the
    loss text from what lies under the examples' masks, in order. ``contexts_sha256``
    reads every example's whole context: in order, what each context adds to the one
    before it, a bar, its ``context_chars`` and a bar. A context that does not begin
    with all of the one before it, or is not of the turns and characters that it
    claims, gives a mark and its own digest instead.
    """
    joined = lambda pieces, text: F.array_join(F.transform(F.array_sort(pieces), text), "")
    role = lambda p: unescape(F.regexp_extract(p, r"^\[([^\]]*)\]", 1))
    text = lambda p: unescape(F.regexp_replace(p, r"^\[[^\]]*\]", ""))
    masked = lambda t: unescape(F.substring(t.target, t.mask_at + 1, t.mask_chars))
    whole = turns.groupBy("conv_id").agg(joined(F.collect_list(F.struct("position", "piece")), lambda t: t.piece).alias("formatted"))
    known = F.col("known_chars").cast("int")
    read = examples.select(
        "conv_id", "position", "target", "mask_at", "mask_chars", "context_turns", "context_chars", "known_chars", F.xxhash64("context").alias("whole"),
        F.xxhash64(F.substring("context", F.lit(1), known)).alias("begins"), F.substring("context", known + 1, F.lit(2**31 - 1)).alias("added"),
    )
    held = F.struct("position", "target", "mask_at", "mask_chars", "context_turns", "context_chars", "known_chars", "whole", "begins", "added")
    loss = read.groupBy("conv_id").agg(F.array_sort(F.collect_list(held)).alias("held")).withColumnRenamed("conv_id", "of")
    before = lambda i, name, first: F.when(i > 0, F.element_at("held", F.greatest(i, F.lit(1)))[name]).otherwise(first)  # noqa: E731  of the example before
    turns_of = lambda e, i: before(i, "context_turns", F.lit(0)) + F.regexp_count(e.added, F.lit(END))
    as_said = lambda e, i: (e.begins == before(i, "whole", F.xxhash64(F.lit("")))) & (e.context_chars == e.known_chars + F.length(e.added)) & (e.context_turns == turns_of(e, i))
    added = lambda e, i: F.when(as_said(e, i), e.added).otherwise(F.concat(F.lit("!"), e.whole.cast("string")))
    contexts = F.transform("held", lambda e, i: F.concat(added(e, i), F.lit("|"), e.context_chars.cast("string"), F.lit("|")))
    return (
        whole.join(loss, F.col("conv_id").eqNullSafe(F.col("of")), "left")
        .select("conv_id", "formatted", "held", F.coalesce(F.array_join(F.transform("held", masked), ""), F.lit("")).alias("loss"), F.filter(F.split("formatted", END), lambda p: p != "").alias("parsed"))
        .select(
            "conv_id", F.size("parsed").cast("long").alias("n_turns"),
            F.sha2(F.array_join(F.transform("parsed", lambda p: F.concat(role(p), F.lit("\n"), text(p), F.lit("\n"))), ""), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
            F.sha2(F.coalesce(F.array_join(contexts, ""), F.lit("")), 256).alias("contexts_sha256"),
        )
    )
