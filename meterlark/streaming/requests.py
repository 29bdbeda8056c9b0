"""Unbounded inputs: request streams through the batch scorers, pickup streams into hourly counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterlark.operators.zones import ZoneModel, assign_zone


def hourly_counts(trips: DataFrame, zones: ZoneModel, lateness: str = "2 hours") -> DataFrame:
    """(pickup_zone, hour, pickup_count) of a trip stream, each hour emitted once it can no longer change.

    State is one counter per zone and open hour, whatever the number of trips. The event time is
    made a zoned timestamp because watermarks need one.
    """
    located = assign_zone(trips, zones).withColumn("at", F.col("pickup_datetime").cast("timestamp"))
    counts = located.withWatermark("at", lateness).groupBy(F.window("at", "1 hour").alias("w"), "pickup_zone").count()
    return counts.select(
        "pickup_zone", F.col("w.start").cast("timestamp_ntz").alias("hour"), F.col("count").alias("pickup_count")
    )


def score_stream(requests: DataFrame, score, path: str, checkpoint: str, trigger: dict | None = None):
    """Run a batch scorer over a request stream into Parquet; returns the running query.

    The scorers are projections and a join to a static history, so they need no state and a retried
    micro-batch gives the same rows. ``score`` takes and returns a DataFrame.
    """
    writer = score(requests).writeStream.format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"availableNow": True})).start()
