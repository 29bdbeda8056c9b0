"""Exact quantiles by narrowing.

``percentile`` keeps every distinct value in one buffer and an approximate sketch is not exact.
Here each pass counts values in a fixed number of bins per bracket and keeps only the bin that holds
the wanted rank, until few values are left; those are counted one by one. A value shared by many
rows is one counted value, so ties cost nothing. Every pass is one scan with a partial aggregate.
What the driver holds between passes is one bracket per column and wanted rank.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlark.functions.numeric import is_missing

BINS = 4096
# Values that may be counted one by one for a single bracket.
FEW = 1_000_000

TARGET = "column string, rank bigint, lo double, hi double, base bigint, inside bigint"


def melt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) for all known values; exploded within each task."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    return (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .select("cell.column", "cell.value")
        .filter(~is_missing(F.col("value")))
    )


def _bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Monotone in the value, so every bin is a contiguous range of values.

    The ends have bins of their own: a bracket always shrinks, and infinite ends fall away.
    """
    place = F.floor((value - lo) / (hi - lo) * bins)
    inner = F.greatest(F.least(place, F.lit(bins - 1)), F.lit(0))
    return F.when(value == lo, -1).when(value == hi, bins).otherwise(inner).cast("int")


def _narrow(cells: DataFrame, targets: list[tuple], group_by: Column) -> list[tuple]:
    """Replace each target's bracket by the counted group of values that contains its rank."""
    wanted = F.broadcast(cells.sparkSession.createDataFrame(targets, TARGET))
    brackets = F.broadcast(wanted.select("column", "lo", "hi").distinct())
    inside = cells.join(brackets, "column").filter(F.col("value").between(F.col("lo"), F.col("hi")))
    counted = inside.groupBy("column", "lo", "hi", group_by.alias("group")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("first"), F.max("value").alias("last")
    )
    upto = Window.partitionBy("column", "lo", "hi").orderBy("first").rowsBetween(Window.unboundedPreceding, 0)
    below = F.col("base") + F.col("upto") - F.col("n")
    hits = (
        counted.withColumn("upto", F.sum("n").over(upto))
        .join(wanted, ["column", "lo", "hi"])
        .filter((F.col("rank") >= below) & (F.col("rank") < below + F.col("n")))
    )
    return [tuple(r) for r in hits.select("column", "rank", "first", "last", below, "n").collect()]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], bins: int = BINS, few: int = FEW
) -> DataFrame:
    """(column, prob, value): quantiles with linear interpolation between neighbouring ranks.

    Reads ``df`` once for the ranges, once per narrowing (none for a small table) and once at the
    end; pass a stage table when it is expensive to compute.
    """
    cells = melt(df, columns)
    stats = cells.groupBy("column").agg(F.count(F.lit(1)), F.min("value"), F.max("value")).collect()
    positions = [(name, float(p), p * (n - 1)) for name, n, _, _ in stats for p in probs]
    ranges = {name: (n, lo, hi) for name, n, lo, hi in stats}
    ranks = {(name, rank) for name, _, at in positions for rank in (math.floor(at), math.ceil(at))}
    targets = [(name, rank, *ranges[name][1:], 0, ranges[name][0]) for name, rank in sorted(ranks)]

    found: dict[tuple[str, int], float] = {}
    while targets:
        found.update({(t[0], t[1]): t[2] for t in targets if t[2] == t[3]})
        still = [t for t in targets if t[2] < t[3]]
        wide = [t for t in still if t[5] > few]
        targets = []
        if wide:
            targets += _narrow(cells, wide, _bin(F.col("value"), F.col("lo"), F.col("hi"), bins))
        narrow = [t for t in still if t[5] <= few]
        if narrow:
            targets += _narrow(cells, narrow, F.col("value"))

    rows = []
    for name, prob, at in positions:
        low, high = found[name, math.floor(at)], found[name, math.ceil(at)]
        rows.append((name, prob, low + (high - low) * (at - math.floor(at))))
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")
