"""Null- and NaN-aware numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_missing(x: Column) -> Column:
    """True for null and for NaN of a floating column."""
    return x.isNull() | F.isnan(x)


def clip(x: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound ``x``; null and NaN stay as they are (least/greatest alone would replace them)."""
    bounded = x
    if upper is not None:
        bounded = F.least(bounded, F.lit(float(upper)))
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(float(lower)))
    return F.when(is_missing(x), x).otherwise(bounded)


def flag(condition: Column) -> Column:
    """A predicate that counts an unknown outcome as false."""
    return F.coalesce(condition, F.lit(False))


def outside(x: Column, bounds: tuple[float, float]) -> Column:
    """True when ``x`` is not within the closed bounds; unknown counts as outside."""
    return ~flag(x.between(bounds[0], bounds[1]))


def to_log(x: Column) -> Column:
    """Scale on which durations and counts are modelled."""
    return F.log1p(x)


def from_log(x: Column, floor: float) -> Column:
    """Back from the modelling scale, not below ``floor``."""
    return clip(F.expm1(x), lower=floor)


def stable_unit(key: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the key's text and the seed.

    Draws depend on the row alone, so splits, folds and samples do not change with partitioning,
    retries or lost executors, and any engine with MD5 can repeat them.
    """
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") / F.lit(float(2**48))
