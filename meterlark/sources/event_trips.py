"""Trips, requests and fixed zones derived from a table of timed user events.

The same SQL text runs on Spark and on other engines, so checks can start from equal inputs.
A known share of rows gets defects: repeated ids, disagreeing or extreme durations, points outside
the city, unusable passenger counts and missing values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterlark.operators.zones import ZoneModel

TRIPS_SQL = """
SELECT row_seq, id, vendor_id, pickup_datetime,
       pickup_datetime + elapsed_s * INTERVAL '1' SECOND AS dropoff_datetime,
       passenger_count, pickup_longitude, pickup_latitude,
       dropoff_longitude, dropoff_latitude, store_and_fwd_flag, trip_duration
FROM (
  SELECT event_id AS row_seq,
    concat('id', CAST(event_id - CASE WHEN event_id > 0 AND event_id % 211 = 0 THEN 1 ELSE 0 END AS STRING)) AS id,
    CAST(1 + event_id % 2 AS STRING) AS vendor_id,
    CASE WHEN event_id % 613 = 0 THEN NULL ELSE date_trunc('second', ts) END AS pickup_datetime,
    dur + CASE WHEN event_id % 397 = 0 THEN 5 ELSE 0 END AS elapsed_s,
    CASE WHEN event_id % 149 = 0 THEN 0 WHEN event_id % 251 = 0 THEN 7
         WHEN event_id % 257 = 0 THEN NULL ELSE CAST(1 + event_id % 6 AS INT) END AS passenger_count,
    CAST(-740000 + plon AS DOUBLE) / 10000 AS pickup_longitude,
    CASE WHEN event_id % 503 = 0 THEN CAST(41.5 AS DOUBLE) ELSE CAST(406000 + plat AS DOUBLE) / 10000 END AS pickup_latitude,
    CAST(-740000 + dlon AS DOUBLE) / 10000 AS dropoff_longitude,
    CASE WHEN event_id % 307 = 0 THEN CAST(39.9 AS DOUBLE) WHEN event_id % 601 = 0 THEN NULL
         ELSE CAST(406000 + dlat AS DOUBLE) / 10000 END AS dropoff_latitude,
    CASE WHEN event_id % 181 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    dur AS trip_duration
  FROM (
    SELECT *, CASE WHEN event_id % 701 = 0 THEN 3 WHEN event_id % 1709 = 0 THEN 90000
                   ELSE 60 + CAST((abs(dlat - plat) + abs(dlon - plon)) / 2 AS INT) + CAST(floor(value * 4) AS INT) END AS dur
    FROM (
      SELECT *,
        (user_id * 617) % 2400 + (event_id * 7919) % 200 AS plat,
        (user_id * 389) % 2000 + (event_id * 6007) % 200 AS plon,
        (event_id * 104729) % 2600 AS dlat,
        (event_id * 1299709) % 2200 AS dlon
      FROM {events}) a) b) c
"""

CENTROIDS_SQL = """
SELECT CAST(zone_id AS INT) AS zone_id,
       CAST(4062 + 4 * (zone_id % 6) AS DOUBLE) / 100 AS lat,
       CAST(-7398 + 4 * CAST(floor(zone_id / 6) AS INT) AS DOUBLE) / 100 AS lon
FROM range(30) t(zone_id)
"""
LONGITUDE_FACTOR = 0.757

REQUESTS_SQL = """
SELECT row_seq AS request_id, pickup_datetime,
       CASE WHEN row_seq % 3 = 0 THEN dropoff_datetime END AS dropoff_datetime,
       pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude,
       passenger_count,
       CASE WHEN row_seq % 97 = 0 THEN 3 ELSE CAST(vendor_id AS INT) END AS vendor_id,
       CASE WHEN row_seq % 5 = 0 THEN store_and_fwd_flag END AS store_and_fwd_flag,
       CASE WHEN row_seq % 11 = 0 THEN CAST(row_seq % 37 AS INT) END AS zone_id,
       CASE WHEN row_seq % 7 = 0 THEN pickup_datetime + INTERVAL '1' HOUR END AS target_datetime
FROM {trips}
"""


def _without_zone(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def trips_from_events(events: DataFrame) -> DataFrame:
    spark = events.sparkSession
    return _without_zone(spark.sql(TRIPS_SQL, events=events), "pickup_datetime", "dropoff_datetime")


def fixed_centroids(spark: SparkSession) -> DataFrame:
    return spark.sql(CENTROIDS_SQL)


def requests_from_trips(trips: DataFrame) -> DataFrame:
    return _without_zone(
        trips.sparkSession.sql(REQUESTS_SQL, trips=trips),
        "pickup_datetime", "dropoff_datetime", "target_datetime",
    )


def load_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def fixed_zones() -> ZoneModel:
    """The fixed centroids as a model, from the same rule as ``CENTROIDS_SQL``."""
    points = tuple(((4062 + 4 * (z % 6)) / 100, (-7398 + 4 * (z // 6)) / 100) for z in range(30))
    return ZoneModel(points, LONGITUDE_FACTOR)
