"""Temperature mixing of sources, as DataFrame functions only.

Each source's share of all tokens is raised to an exponent and normalised: 1 leaves the mix as it is, 0 makes all
sources equal. The exponent is bisected until the mix meets a target entropy or no source is repeated more often than
allowed. The weights are then realised block by block: a source's documents fall into blocks by a hash, every epoch
deals the blocks in another permutation, and the last epoch stops at the source's token budget.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlark.session import stage

BLOCKS = 1024
SEED = "mix"
REPETITION = 1.25
# 2 ** (STEPS * ROUNDS) is the precision of the exponent. A round asks at once for every answer that STEPS bisections may need.
STEPS, ROUNDS = 4, 10
# A plan of at most this many narrow rows is broadcast; beyond it the join is shuffled by source and block.
BROADCAST_ROWS = 200_000

WORD = r"[^\x09-\x0D\x20]+"


def token_count(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_name(source: Column) -> Column:
    return F.coalesce(source.cast("string"), F.lit(""))


def block_of(doc_id: Column, seed: str = SEED) -> Column:
    """A document's block within its source, from its id alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))) 
    return (F.conv(F.substring(digest, 1, 6), 16, 10).cast("long") % BLOCKS).cast("int")


@dataclass(frozen=True)
class Target:
    """What the exponent must meet: no source repeated more than ``repetition`` times, or at least ``entropy`` nats.

    ``cover`` sets the token budget so that every source is used whole at least once; otherwise it is ``budget``
    tokens, or as many as there are.
    """

    repetition: float | None = REPETITION
    entropy: float | None = None
    budget: int | None = None
    cover: bool = False


def exponent(shares: DataFrame, target: Target, total: int) -> float:
    """The exponent in 0..1 by bisection over (share) rows of all sources; each round is one aggregate to one row."""
    p = F.col("share")
    over = (target.budget or total) / total if total else 1.0

    def measures(i: int, a: float) -> list[Column]:
        powered = F.pow(p, F.lit(a))
        return [
            F.sum(powered).alias(f"s{i}"), F.sum(powered * F.log(p)).alias(f"l{i}"),
            F.max(F.pow(p, F.lit(a - 1))).alias(f"r{i}"), F.max(F.pow(p, F.lit(1 - a))).alias(f"c{i}"),
        ]

    def above(row, i: int, a: float) -> bool:
        """Whether an exponent is at least the one looked for."""
        if target.entropy is not None:
            return math.log(row[f"s{i}"]) - a * row[f"l{i}"] / row[f"s{i}"] <= target.entropy
        most = row[f"r{i}"] * row[f"c{i}"] if target.cover else row[f"r{i}"] / row[f"s{i}"] * over
        return most <= target.repetition

    ends = shares.agg(*measures(0, 0.0), F.count(F.lit(1)).alias("n")).first()
    if not ends["n"] or above(ends, 0, 0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        parts = 1 << STEPS
        asked = [low + (high - low) * i / parts for i in range(1, parts)]
        row = shares.agg(*[m for i, a in enumerate(asked) for m in measures(i, a)]).first()
        for _ in range(STEPS):
            middle = (low + high) / 2
            if above(row, asked.index(middle), middle):
                high = middle
            else:
                low = middle
    return high


def mixing_plan(tokens: DataFrame, target: Target = Target(), seed: str = SEED) -> DataFrame:
    """(source, block, epoch, block_rank, weight, exponent) from documents' (source, block, n_tokens).

    One row for every time a block is used; ``block_rank`` is its place in the epoch's permutation of the source's
    blocks. In the last epoch blocks are dealt while they fit the rest of the budget. Only sums by source and
    block are kept, at most ``BLOCKS`` rows a source however many documents it holds.
    """
    blocks = stage(tokens.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")), "mix-blocks")
    sources = blocks.groupBy("source").agg(F.sum("tokens").alias("all_tokens"))
    total = sources.agg(F.sum("all_tokens")).first()[0] or 0
    shares = stage(sources.filter("all_tokens > 0").withColumn("share", F.col("all_tokens") / F.lit(float(max(1, total)))), "mix-shares")
    a = exponent(shares.select("share"), target, total)
    sums = shares.agg(F.sum(F.pow("share", F.lit(a))).alias("s"), F.max(F.pow("share", F.lit(1 - a))).alias("c")).first()
    norm, widest = sums["s"] or 1.0, sums["c"] or 1.0
    budget = total * norm * widest if target.cover else float(target.budget or total)
    weight = F.pow("share", F.lit(a)) / norm
    # Rounded, so that a repetition of exactly one is not lost to the last bit.
    uses = sources.join(shares.select("source", "share"), "source", "left").select(
        "source", F.round(F.coalesce(weight, F.lit(0.0)), 9).alias("weight"), "all_tokens",
        F.round(F.coalesce(weight * F.lit(budget) / F.col("all_tokens"), F.lit(1.0)), 9).alias("repetition"))
    uses = uses.withColumn("whole", F.floor("repetition")).withColumn(
        "rest", F.floor((F.col("repetition") - F.col("whole")) * F.col("all_tokens")))
    dealt = blocks.join(uses, "source").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole").cast("int"))))
    key = F.md5(F.concat_ws(":", F.lit(seed), "source", "epoch", "block"))
    order = Window.partitionBy("source", "epoch").orderBy(key, "block")
    ranked = dealt.withColumn("block_rank", F.row_number().over(order)).withColumn(
        "used", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.col("epoch") == F.col("whole")
    fits = F.when(last, (F.col("rest") > 0) & (F.col("used") <= F.col("rest"))).otherwise(F.lit(True))
    return ranked.filter(fits).select(
        "source", "block", F.col("epoch").cast("long"), F.col("block_rank").cast("long"), "weight", F.lit(round(a, 9)).alias("exponent"))


def joined(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with every use of their block; the hot source is spread over its blocks."""
    if plan.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        plan = F.broadcast(plan)
    right = plan.select(*[F.col(c).alias(f"_{c}") for c in plan.columns])
    return rows.join(right, (F.col("source") == F.col("_source")) & (F.col("block") == F.col("_block")))


def document_tokens(docs: DataFrame, seed: str = SEED) -> DataFrame:
    return docs.select(
        "doc_id", source_name(F.col("source")).alias("source"), block_of(F.col("doc_id"), seed).alias("block"),
        token_count(F.col("text")).alias("n_tokens"))


def mix(docs: DataFrame, target: Target = Target(), seed: str = SEED) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block, block_rank, weight, exponent: one row for every use of a document.

    ``docs`` needs doc_id, text and source; other columns are ignored whatever their names. A null source is the source
    "". Null and empty texts hold no tokens and cost nothing; a source without any tokens is used once.
    Repeated rows are used alike, each for itself; rows without doc_id share a block. An empty table gives no rows.
    """
    tokens = stage(document_tokens(docs, seed), "mix-tokens")
    plan = stage(mixing_plan(tokens.select("source", "block", "n_tokens"), target, seed), "mix-plan")
    return joined(tokens, plan).select(
        "doc_id", "source", "n_tokens", F.col("_epoch").alias("epoch"), F.col("block").cast("long").alias("block"),
        F.col("_block_rank").alias("block_rank"), F.col("_weight").alias("weight"), F.col("_exponent").alias("exponent"))


def mixed(docs: DataFrame, target: Target = Target(), seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, all columns, as often as the mix uses them."""
    plan = stage(mixing_plan(document_tokens(docs, seed).select("source", "block", "n_tokens"), target, seed), "mix-plan")
    keyed = docs.select(
        F.struct("*").alias("row"), source_name(F.col("source")).alias("source"), block_of(F.col("doc_id"), seed).alias("block"))
    return joined(keyed, plan).select("row.*")
