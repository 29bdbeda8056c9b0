"""Turning raw anomaly scores into normalised scores, flags and review tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from meterlark import params
from meterlark.functions.numeric import clip
from meterlark.operators.quantiles import exact_quantiles

RAW = "anomaly_score_raw"


@dataclass(frozen=True)
class ScoreScale:
    """Range and flag threshold of the raw scores seen in training."""

    low: float
    high: float
    threshold: float

    def normalised(self, raw: Column) -> Column:
        """Into [0, 1] by the training range; more extreme values are clipped."""
        return clip((raw - self.low) / F.lit(self.high - self.low + params.RATIO_EPSILON), 0.0, 1.0)

    def flagged(self, raw: Column) -> Column:
        return raw > F.lit(self.threshold)

    def apply(self, df: DataFrame) -> DataFrame:
        raw = F.col(RAW)
        return df.withColumns({"anomaly_score": self.normalised(raw), "is_anomaly": self.flagged(raw)})


def fit_scale(raw_scores: DataFrame, contamination: float = params.CONTAMINATION) -> ScoreScale:
    """Range of the training scores and the exact quantile above which the contamination share lies."""
    ends = raw_scores.agg(F.min(RAW).alias("low"), F.max(RAW).alias("high")).first()
    if ends["low"] is None:
        raise ValueError("no scores to scale")
    cut = exact_quantiles(raw_scores, [RAW], [1 - contamination]).first()["value"]
    return ScoreScale(ends["low"], ends["high"], cut)


def flag_share(scored: DataFrame) -> DataFrame:
    """One row: flagged trips, all trips and the share."""
    flagged = F.col("is_anomaly").cast("int")
    return scored.agg(
        F.count_if("is_anomaly").alias("n_flagged"), F.count(F.lit(1)).alias("n"), F.avg(flagged).alias("share")
    )


def flagged_summary(scored: DataFrame, features=params.ANOMALY_FEATURES) -> DataFrame:
    """(feature, mean_normal, mean_flagged), one aggregate; an empty group gives null."""
    flagged = F.col("is_anomaly")
    row = scored.agg(
        *[
            F.struct(
                F.avg(F.when(~flagged, F.col(c))).alias("mean_normal"),
                F.avg(F.when(flagged, F.col(c))).alias("mean_flagged"),
            ).alias(c)
            for c in features
        ]
    )
    return row.unpivot([], list(features), "feature", "cell").select("feature", "cell.mean_normal", "cell.mean_flagged")


def top_anomalies(scored: DataFrame, n: int = 20, key: str = "id", features=params.ANOMALY_FEATURES) -> DataFrame:
    """The n highest scores with their features; ties in key order. A top-n, not a full sort."""
    return (
        scored.select(key, *features, "anomaly_score", "is_anomaly")
        .orderBy(F.desc("anomaly_score"), key)
        .limit(n)
    )
