"""The prefix trie of conversations, by collapsing whole sequences.

Conversations travel as digests of their turns, never as text. Equal conversations are grouped into one sequence with a weight and the list of
those that end there; an anti-join drops the sequences that are proper prefixes of others, which leaves the leaves; and the weighted prefixes
of the sequences are summed to the nodes. A third of all conversations that are copies of one are one sequence from the first shuffle on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlark.session import stage

WORD = r"[^\x20\x09-\x0D]+"
# Conversations of one family share the first turns of the one whose number is divisible by this; up to so many turns less one.
FAMILY = 20
SHARED = 4
# Conversation numbers of one piece of a sequence's end list.
PIECE = 1 << 16

# A prefix is named by two sums without carry over hashes of its turns and their places, and by its depth.
KEY = ["depth", "x1", "x2"]


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, d1, d2, words) of every turn, from place 1 in the order of ``turn``, nulls first; equal ones by their digest."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    plain = turns.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.xxhash64(role, text).alias("d1"), F.xxhash64(F.lit(1), role, text).alias("d2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "d1", "d2")
    return plain.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "d1", "d2", "words")


def shared_turns(conv_id: Column) -> Column:
    """How many of its family's first turns a conversation begins with."""
    return F.crc32(conv_id.cast("string").cast("binary")) % SHARED


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, d1, d2, words) of the rebuilt conversations, and all their conv_ids, turnless ones too.

    A conversation of a family takes the first turns of the family's head, all if there are fewer, none if there is no head, then
    its own turns behind as many. At most ``SHARED`` - 1 turns of a head travel, to at most ``FAMILY`` conversations on either side of 0.
    """
    first = numbered.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < SHARED))
    heads = first.groupBy(F.col("conv_id").alias("family")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "d1", "d2", "words"))).alias("head"))
    convs = numbered.filter("pos = 1").select("conv_id", shared_turns(F.col("conv_id")).alias("h"))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    taken = convs.withColumn("family", family).join(heads, "family", "left").select(
        "conv_id", "h", F.coalesce(F.filter("head", lambda t: t["pos"] <= F.col("h")), F.expr(
            "cast(array() as array<struct<pos bigint, d1 bigint, d2 bigint, words bigint>>)")).alias("head"))
    own = numbered.withColumn("h", shared_turns(F.col("conv_id"))).filter("pos > h").select("conv_id", "pos", "d1", "d2", "words")
    # Own turns keep their places: those of a short head are closed up by numbering once more.
    every = taken.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*").unionByName(own)
    return every, convs.select("conv_id")


def prefixes(every: DataFrame) -> DataFrame:
    """(conv_id, depth, x1, x2, words, last): every prefix of every rebuilt conversation that has turns."""
    order = Window.partitionBy("conv_id").orderBy("pos")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    placed = every.select("conv_id", "pos", F.row_number().over(order).cast("long").alias("depth"), "d1", "d2", "words",
                          F.lead("pos").over(order).isNull().alias("last"))
    salted = placed.withColumns({"h1": F.xxhash64("depth", "d1", "d2"), "h2": F.xxhash64("d2", "depth", "d1")})
    return salted.select("conv_id", "depth", F.bit_xor("h1").over(upto).alias("x1"), F.bit_xor("h2").over(upto).alias("x2"), "words", "last")


def end_digests(members: DataFrame, piece: int = PIECE) -> DataFrame:
    """``KEY`` with weight, rep and ends_sha256 of every sequence of ``members`` (conv_id and ``KEY``).

    An end list is cut into pieces by ranges of conversation numbers. A sequence with one piece is hashed at once. The pieces of the
    others stream in order through one running hash each, so a list of any length needs the memory of one piece; the digest asks for
    one order over the whole list, which nothing but one reader can give.
    """
    pieces = members.groupBy(*KEY, F.floor(F.col("conv_id") / piece).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"),
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"))
    cut = stage(pieces, "trie-pieces")
    whole = cut.groupBy(*KEY).agg(
        F.sum("n").alias("weight"), F.min("low").alias("rep"), F.count(F.lit(1)).alias("pieces"))
    many = whole.filter("pieces > 1").select(*KEY)
    alone = cut.join(many, KEY, "left_anti").select(*KEY, F.sha2("ids", 256).alias("ends_sha256"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, running = None, None
        for frame in frames:
            ended = []
            for *key, ids in frame.itertuples(index=False):
                if key != now:
                    if now is not None:
                        ended.append((*now, running.hexdigest()))
                    now, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.encode())
            yield pd.DataFrame(ended, columns=[*KEY, "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(*now, running.hexdigest())], columns=[*KEY, "ends_sha256"])

    streamed = cut.join(many, KEY).repartition(*[F.col(k) for k in KEY]).sortWithinPartitions(*KEY, "piece").select(
        *KEY, "ids").mapInPandas(run, "depth long, x1 long, x2 long, ends_sha256 string")
    return whole.drop("pieces").join(alone.unionByName(streamed), KEY)


def trie(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` needs conv_id, turn, role and text; other columns are ignored whatever their names. Turns are ordered by ``turn``, nulls first, and
    where it is equal by a digest of role and text; repeated rows are repeated turns. A null role or text is an empty one. Rows
    without conv_id take no part. A conversation of which nothing is left belongs to the root alone. An empty table has no root.

    Conversations are ordered one by one, each in one task that spills; a long one is never an array. The root's numbers are sums over all
    nodes. Below it, each node belongs to the sequence with its smallest member, so that a subtree is summed over the sequences
    through it with every node counted once, and children, parents and saved words come from one pass over each sequence.
    """
    every, convs = rebuilt(stage(numbered_turns(turns), "trie-turns"))
    rows = stage(prefixes(every), "trie-prefixes")
    ends = rows.filter("last").select("conv_id", *KEY)
    turnless = convs.join(ends, "conv_id", "left_anti").select("conv_id", *[F.lit(0).cast("long").alias(k) for k in KEY])
    sequences = stage(end_digests(ends.unionByName(turnless), piece), "trie-sequences")
    # The prefixes of the sequences, each by its smallest conversation, with the sequence's weight.
    weighted = rows.join(sequences.select(F.col("rep").alias("conv_id"), "weight", F.col("ends_sha256").alias("own_ends")), "conv_id")
    weighted = weighted.withColumn("own_ends", F.when(F.col("last"), F.col("own_ends")))
    nodes = stage(weighted.groupBy(*KEY).agg(
        F.sum("weight").alias("n_convs"), F.min("conv_id").alias("owner"), F.max("words").alias("node_words"),
        F.bool_or(~F.col("last")).alias("inner")), "trie-nodes")
    leaves = sequences.filter("depth > 0").join(nodes.filter("inner").select(*KEY), KEY, "left_anti").select(
        F.col("rep").alias("conv_id"), F.lit(1).cast("long").alias("leaf"))
    owned = F.col("conv_id") == F.col("owner")
    known = weighted.select("conv_id", *KEY, "own_ends").join(nodes.drop("inner"), KEY).join(leaves, "conv_id", "left").select(
        "conv_id", *KEY, "own_ends", "owner", "n_convs", F.coalesce("leaf", F.lit(0)).alias("leaf"), owned.cast("long").alias("owns"),
        F.when(owned, (F.col("n_convs") - 1) * F.col("node_words")).otherwise(0).alias("saved"))
    along = Window.partitionBy("conv_id").orderBy("depth")
    below = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    walked = known.select(
        *KEY, "owner", "n_convs", "own_ends", "leaf", F.lag("owner").over(along).alias("parent"),
        F.coalesce(F.lead("owns").over(along), F.lit(0)).alias("child"), F.sum("saved").over(below).alias("saved"))
    none = F.sha2(F.lit(""), 256)
    # Members of the root alone, the smallest conversation and its end list; one row, or none for an empty table.
    top = sequences.agg(
        F.sum("weight").alias("n_convs"), F.min("rep").alias("low"), F.max(F.when(F.col("depth") == 0, F.col("ends_sha256"))).alias("own_ends"))
    smallest = top.first()["low"]
    inner = walked.groupBy(*KEY).agg(
        F.min("owner").alias("conv_id"), F.min("parent").alias("parent"), F.min("n_convs").alias("n_convs"), F.sum("child").alias("n_children"),
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.max("own_ends").alias("own_ends"))
    below_root = inner.select(
        "conv_id", "depth", F.coalesce("parent", F.lit(smallest).cast("long")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("own_ends", none).alias("ends_sha256"))
    zero = F.lit(0).cast("long")
    summed = (
        nodes.agg(F.count_if(F.col("depth") == 1).alias("n_children"), F.sum((F.col("n_convs") - 1) * F.col("node_words")).alias("saved"))
        .select("n_children", F.coalesce("saved", zero).alias("saved_tokens"), zero.alias("n_leaves"))
        .unionByName(leaves.agg(F.sum("leaf").alias("n_leaves")).select(
            zero.alias("n_children"), zero.alias("saved_tokens"), F.coalesce("n_leaves", zero).alias("n_leaves")))
        .agg(*[F.sum(c).alias(c) for c in ("n_children", "saved_tokens", "n_leaves")])
    )
    root = top.filter("n_convs IS NOT NULL").join(summed, F.lit(True)).select(
        F.col("low").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        # A trie without turns is a childless root.
        F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")).alias("n_leaves"), "saved_tokens",
        F.coalesce("own_ends", none).alias("ends_sha256"))
    return below_root.unionByName(root)
