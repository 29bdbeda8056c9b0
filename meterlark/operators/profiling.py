"""Profiles of the raw and featured trips: counts, shares, correlations, histograms, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from meterlark import params
from meterlark.functions.numeric import flag, is_missing
from meterlark.operators import cleaning
from meterlark.operators.quantiles import exact_quantiles


def _shares(df: DataFrame, issues: dict[str, Column]) -> DataFrame:
    """(issue, n, share), every issue counted on all rows in one aggregate."""
    total = F.count(F.lit(1))
    row = df.agg(
        *[
            F.struct(
                F.count_if(bad).alias("n"),
                F.try_divide(F.count_if(bad).cast("double"), total).alias("share"),
            ).alias(name)
            for name, bad in issues.items()
        ]
    )
    return row.unpivot([], list(issues), "issue", "cell").select("issue", "cell.n", "cell.share")


def _short(low: int = params.MIN_TRIP_SECONDS) -> Column:
    return flag(F.col("trip_duration") < low)


def _long(high: int = params.MAX_TRIP_SECONDS) -> Column:
    return flag(F.col("trip_duration") > high)


def duration_outliers(df: DataFrame) -> DataFrame:
    return _shares(df, {"too_short": _short(), "too_long": _long()})


def geographic_outliers(df: DataFrame) -> DataFrame:
    return _shares(
        df,
        {
            "pickup_outside": cleaning.point_out_of_bounds("pickup"),
            "dropoff_outside": cleaning.point_out_of_bounds("dropoff"),
        },
    )


def trips_by_hour(df: DataFrame) -> DataFrame:
    hours = df.select(F.hour("pickup_datetime").alias("hour")).filter("hour IS NOT NULL")
    return hours.groupBy("hour").agg(F.count(F.lit(1)).alias("n")).orderBy("hour")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each known value, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
    )


def missing_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing_pct), highest first."""
    columns = list(columns or df.columns)
    row = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(c) for c in columns])
    return row.unpivot([], columns, "column", "missing_pct").orderBy(F.desc("missing_pct"), "column")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_a, column_b, corr) for all pairs, each over the rows where both are known."""
    columns = list(columns or numeric_columns(df))
    if len(columns) < 2:
        raise ValueError("a correlation matrix needs at least two numeric columns")
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in dict.fromkeys([(a, b), (b, a)]):
            cells.append(F.struct(F.lit(left).alias("column_a"), F.lit(right).alias("column_b"), F.col(f"p{i}").alias("corr")))
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def histogram(df: DataFrame, value: Column, bins: int = 100) -> DataFrame:
    """(bin, lower, upper, n): equal bins over [min, max], the last one closed, empty ones included.

    The range is a one-row aggregate, used as a scalar; a single value gets a range of one around it.
    """
    values = df.select(value.cast("double").alias("value")).filter(~is_missing(F.col("value")))
    ends = values.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).select(
        F.when(F.col("hi") > F.col("lo"), F.col("lo")).otherwise(F.col("lo") - 0.5).alias("lo"),
        F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(F.col("hi") + 0.5).alias("hi"),
    )
    placed = values.withColumn("ends", ends.select(F.struct("lo", "hi")).scalar())
    place = F.floor((F.col("value") - F.col("ends.lo")) / (F.col("ends.hi") - F.col("ends.lo")) * bins)
    counts = placed.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    every = (
        ends.filter("lo IS NOT NULL")
        .select("lo", width.alias("width"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("lower"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("upper"),
        )
    )
    return every.join(counts, "bin", "left").na.fill(0, ["n"])


def duration_histograms(df: DataFrame, bins: int = 100) -> DataFrame:
    """Histograms of the duration and of its logarithm."""
    seconds = F.col("trip_duration")
    raw = histogram(df, seconds, bins).withColumn("scale", F.lit("raw"))
    return raw.unionByName(histogram(df, F.log1p(seconds), bins).withColumn("scale", F.lit("log1p")))


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, count, mean, std, min, p25, p50, p75, max) with exact quartiles."""
    columns = list(columns or numeric_columns(df))
    row = df.agg(
        *[
            F.struct(
                F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                F.min(x).alias("min"), F.max(x).alias("max"),
            ).alias(c)
            for c in columns
            for x in [F.col(c).cast("double")]
        ]
    )
    moments = row.unpivot([], columns, "column", "cell").select("column", "cell.*")
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    wide = quartiles.groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{int(p * 100)}") for p in (0.25, 0.5, 0.75)]
    )
    return moments.join(wide, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def text_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, unique, top, freq); of equally frequent values the first in order is the top.

    Values are counted before they are compared, so no task holds a column's distinct values.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    values = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").filter("value IS NOT NULL")
    counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), "value")).alias("top"),
        F.max("n").alias("freq"),
    )


def quality_table(df: DataFrame) -> DataFrame:
    """(issue, n, share) of the raw data, every issue counted on its own."""
    rows = _shares(
        df,
        {
            "duration_too_short": _short(),
            "duration_too_long": _long(),
            "pickup_out_of_bounds": cleaning.point_out_of_bounds("pickup"),
            "dropoff_out_of_bounds": cleaning.point_out_of_bounds("dropoff"),
            "duration_mismatch": cleaning.duration_mismatch(),
            "missing_values": cleaning.missing_critical(params.RAW_COLUMNS),
        },
    )
    per_id = df.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
    repeated = per_id.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("n"), F.sum("copies").alias("total")
    ).select(F.lit("duplicate_ids").alias("issue"), "n", F.try_divide(F.col("n").cast("double"), F.col("total")).alias("share"))
    return rows.unionByName(repeated)
