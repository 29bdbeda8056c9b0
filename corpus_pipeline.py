"""The corpus pipeline: toxic documents go, repeated lines go, near-duplicates go, sources are mixed, sequences are packed.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all that its predecessor kept; ``run`` writes each result as Parquet
to the shared folder and reads it again. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterlark.llm import line_dedup, mixing, order_minhash, packing, queries, toxicity
from meterlark.session import stage

# Sources are evened out until one is used more than this many times as often as another; none loses a document.
REPETITION = 1.25


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5, by a model of the labels among ``docs``; without both labels all stay."""
    model = toxicity.fit(docs, queries.table(spark, sf_dir, "labels"))
    return docs if model is None else toxicity.keep_clean(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the lines it keeps and their number of code points; none goes, though one may end up empty."""
    kept = line_dedup.dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    values = {
        "text": F.when(changed, F.col("kept_text")).otherwise(F.col("text")),
        "n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")),
    }
    return kept.select(*[values[c].alias(c) if c in values else F.col(c) for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest doc_id; what the line stage emptied is one class too."""
    return order_minhash.keep_first(docs, one_blank=True)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources repeated towards an even mix, large ones used once: every document stays."""
    return mixing.mixed(docs, mixing.Target(repetition=REPETITION, cover=True))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packing.pack(docs, queries.public_bpe())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", without_near_duplicates),
    ("mixing", mixed_sources),
    ("packing", packed),
]

# A trained network, sketches and token ids are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the last one."""
    docs = queries.documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"corpus-{name}")
    return docs
