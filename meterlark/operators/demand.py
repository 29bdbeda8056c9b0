"""The complete zone-hour table and its leakage-free history columns.

Trips are counted per zone and hour before anything else, so all later steps work on at most
zones x hours rows, however unevenly the trips are spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from meterlark import params
from meterlark.functions.temporal import floor_hour, hourly_range, with_calendar


def zone_hour_counts(df: DataFrame, ts: str = "pickup_datetime", zone: str = "pickup_zone") -> DataFrame:
    """Trips per observed zone and hour.

    Rows without a zone or hour are left out by the count: a filter on the zone would be pushed
    below the projection and compute every zone twice.
    """
    known = F.when(F.col("hour").isNotNull(), F.col("pickup_zone"))
    return (
        df.select(F.col(zone).alias("pickup_zone"), floor_hour(F.col(ts)).alias("hour"))
        .groupBy("pickup_zone", "hour")
        .agg(F.count(known).alias("pickup_count"))
        .filter("pickup_count > 0")
    )


def dense_grid(counts: DataFrame, n_zones: int = params.N_ZONES) -> DataFrame:
    """Every zone x every hour between the first and last observed one."""
    # The filter on the count keeps this branch's aggregate equal to the one it is joined with, so
    # the counts are computed once and their shuffle is reused.
    span = counts.filter("pickup_count > 0").agg(F.min("hour").alias("first"), F.max("hour").alias("last"))
    return (
        span.filter("first IS NOT NULL")
        .select(F.explode(hourly_range(F.col("first"), F.col("last"))).alias("hour"))
        # The hours come from one row; dealt out, so that a long span times the zones is not one task's work.
        .repartition("hour")
        .select(F.explode(F.sequence(F.lit(0), F.lit(n_zones - 1))).alias("pickup_zone"), "hour")
    )


def hourly_demand(df: DataFrame, n_zones: int = params.N_ZONES) -> DataFrame:
    """(pickup_zone, hour, pickup_count) without gaps; absent pairs count zero.

    Zero rows are added to the counts and summed: the same result as a left join of the grid to the
    counts, on rows already reduced to zones x hours.
    """
    counts = zone_hour_counts(df)
    zeros = dense_grid(counts, n_zones).withColumn("pickup_count", F.lit(0).cast("bigint"))
    return zeros.unionByName(counts).groupBy("pickup_zone", "hour").agg(F.sum("pickup_count").alias("pickup_count"))


def _by_hour(zone: str = "pickup_zone") -> Window:
    return Window.partitionBy(zone).orderBy("hour")


def with_lags(grid: DataFrame, lags: Sequence[int] = params.LAG_HOURS) -> DataFrame:
    """Counts of earlier hours of the same zone; null before the zone's history starts."""
    return grid.withColumns({f"demand_lag_{h}h": F.lag("pickup_count", h).over(_by_hour()) for h in lags})


def with_rolling_means(grid: DataFrame, windows: Sequence[int] = params.ROLLING_WINDOWS) -> DataFrame:
    """Mean of the w hours before the current one, within the zone and over what exists."""
    return grid.withColumns(
        {f"demand_rolling_mean_{w}h": F.avg("pickup_count").over(_by_hour().rowsBetween(-w, -1)) for w in windows}
    )


def drop_short_history(grid: DataFrame, lags: Sequence[int] = params.LAG_HOURS) -> DataFrame:
    """Keep hours whose longest lag is known."""
    return grid.filter(F.col(f"demand_lag_{max(lags)}h").isNotNull())


def demand_dataset(
    df: DataFrame,
    n_zones: int = params.N_ZONES,
    lags: Sequence[int] = params.LAG_HOURS,
    windows: Sequence[int] = params.ROLLING_WINDOWS,
) -> DataFrame:
    """From zoned trips to the modelling table; lags and means share one sort per zone."""
    grid = with_rolling_means(with_lags(hourly_demand(df, n_zones), lags), windows)
    return drop_short_history(with_calendar(grid), lags)


def request_history(
    history: DataFrame,
    lags: Sequence[int] = params.LAG_HOURS,
    windows: Sequence[int] = params.ROLLING_WINDOWS,
) -> DataFrame:
    """What the history says about each (zone, target hour) that it can say anything about.

    Every known hour is handed to the next hours that look back at it, once per hour of history
    instead of once per request. Lags need exactly their hour; means use the hours that exist.
    """
    reach = max([*lags, *windows])
    seen = history.select("pickup_zone", "hour", "pickup_count").withColumn(
        "offset", F.explode(F.sequence(F.lit(1), F.lit(reach)))
    )
    target = F.timestamp_add("HOUR", F.col("offset"), F.col("hour"))
    return seen.groupBy(F.col("pickup_zone").alias("zone_id"), target.alias("target_hour")).agg(
        *[F.max(F.when(F.col("offset") == h, F.col("pickup_count"))).alias(f"demand_lag_{h}h") for h in lags],
        *[
            F.avg(F.when(F.col("offset") <= w, F.col("pickup_count"))).alias(f"demand_rolling_mean_{w}h")
            for w in windows
        ],
    )
