"""Train/test splits and seeded samples that depend on the rows alone."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlark import params
from meterlark.functions.numeric import stable_unit


def in_test(key: str = "id", share: float = params.DURATION_TEST_SHARE, seed: int = params.SEED) -> Column:
    """Whether a row belongs to the test part; the share holds in expectation."""
    return stable_unit(F.col(key), seed) < share


def random_split(
    df: DataFrame, key: str = "id", share: float = params.DURATION_TEST_SHARE, seed: int = params.SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key: two filters, the same rows on every run and partitioning."""
    test = in_test(key, share, seed)
    return df.filter(~test), df.filter(test)


def fold_of(key: str, folds: int, seed: int = params.SEED) -> Column:
    """Cross-validation fold 0..folds-1 of a row, independent of the test split."""
    return F.floor(stable_unit(F.col(key), seed + 1) * folds).cast("int")


def cutoff_hour(grid: DataFrame, share: float = params.DEMAND_TEST_SHARE) -> DataFrame:
    """One row with the first test hour: the distinct hours in order, cut at the share."""
    # One row per distinct hour: a century holds under a million.
    hours = grid.select("hour").distinct().filter("hour IS NOT NULL")
    ranked = hours.select(
        "hour", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("hour")).alias("nth"),
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("of"))
    return ranked.filter(F.col("nth") == F.floor(F.col("of") * F.lit(1 - share)) + 1).agg(F.min("hour").alias("cutoff"))


def chronological_split(
    grid: DataFrame, share: float = params.DEMAND_TEST_SHARE
) -> tuple[DataFrame, DataFrame, datetime]:
    """(train, test, cutoff) with one cutoff for all zones, as a literal a scan can prune by."""
    cutoff = cutoff_hour(grid, share).first()["cutoff"]
    if cutoff is None:
        raise ValueError("no hours to split")
    edge = F.lit(cutoff).cast("timestamp_ntz")
    return grid.filter(F.col("hour") < edge), grid.filter(F.col("hour") >= edge), cutoff


def sample_rows(df: DataFrame, n: int, key: str = "id", seed: int = params.SEED) -> DataFrame:
    """Exactly min(n, rows) rows without replacement, the same ones on every run.

    Rows are ranked by the hash of their key, rows of one key by their content. The row count gives a cut that lets
    through a little more than n rows (ten standard deviations above), so only those are ranked, not the table. Where
    keys repeat, whole keys fall on one side of the cut; it is then widened until enough rows pass.
    """
    total = df.agg(F.count(F.lit(1))).first()[0]
    share = (n + 10 * math.sqrt(n) + 10) / max(1, total)
    drawn, pool = stable_unit(F.col(key), seed), df
    while share < 1:
        pool = df.filter(drawn < share)
        if pool.limit(n).count() == n:
            break
        share, pool = share * 4, df
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return pool.orderBy(drawn, key, content).limit(n)
