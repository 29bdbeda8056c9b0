"""Pickup zones: nearest centroid in a locally straightened plane."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterlark import params

# Beyond this many centroids the distances go through a loop instead of one expression each.
UNROLLED_ZONES = 64


@dataclass(frozen=True)
class ZoneModel:
    """k centroids in degrees and the longitude factor frozen when they were fitted."""

    centroids: tuple[tuple[float, float], ...]
    longitude_factor: float
    inertia: float | None = None

    @property
    def n_zones(self) -> int:
        return len(self.centroids)

    def to_table(self, spark: SparkSession) -> DataFrame:
        """(zone_id, lat, lon, longitude_factor, inertia): centroids and factor as one unit."""
        rows = [(i, a, b, self.longitude_factor, self.inertia) for i, (a, b) in enumerate(self.centroids)]
        return spark.createDataFrame(
            rows, "zone_id int, lat double, lon double, longitude_factor double, inertia double"
        )

    @classmethod
    def from_table(cls, centroids: DataFrame, longitude_factor: float) -> "ZoneModel":
        """From a (zone_id, lat, lon) table with one row per zone, ids 0..k-1."""
        rows = sorted(centroids.select("zone_id", "lat", "lon").collect())
        if [r["zone_id"] for r in rows] != list(range(len(rows))):
            raise ValueError("zone ids must be 0..k-1")
        return cls(tuple((r["lat"], r["lon"]) for r in rows), longitude_factor)

    def nearest(self, lat: str, lon: str) -> Column:
        """Id of the centroid nearest to two columns, the lowest id on ties; null where one is null, NaN or infinite.

        k distances per row: no join and no pairs. Distances are taken on values that cannot be
        null and outside any condition, which keeps the generated code small enough to be compiled
        and lets Spark build the array once for both uses; it makes a factor of ten. Written as SQL
        text because k expressions built one by one take longer than a small query.
        """
        known_lat, known_lon = f"coalesce({lat}, double('NaN'))", f"coalesce({lon}, double('NaN'))"

        def distance(zone_lat, zone_lon) -> str:
            north = f"({known_lat} - {zone_lat})"
            east = f"(({known_lon} - {zone_lon}) * {self.longitude_factor!r}D)"
            return f"{north} * {north} + {east} * {east}"

        if self.n_zones <= UNROLLED_ZONES:
            cells = ", ".join(distance(f"({a!r}D)", f"({b!r}D)") for a, b in self.centroids)
            distances = f"array({cells})"
        else:
            points = ", ".join(f"struct({a!r}D AS a, {b!r}D AS b)" for a, b in self.centroids)
            distances = f"transform(array({points}), p -> {distance('p.a', 'p.b')})"
        place = f"cast(array_position({distances}, array_min({distances})) AS int)"
        # A comparison with infinity is null for null and, NaN being above all numbers, false for NaN.
        known = f"abs({lat}) < double('inf') AND abs({lon}) < double('inf')"
        return F.expr(f"CASE WHEN {known} THEN -1 END + {place}")


def longitude_factor(df: DataFrame, lat: str = "pickup_latitude") -> float:
    """How much shorter a degree of longitude is than one of latitude, at the data's mean latitude."""
    mean = df.agg(F.avg(lat)).first()[0]
    if mean is None:
        raise ValueError("no coordinates to centre on")
    return math.cos(math.radians(mean))


def assign_zone(df: DataFrame, zones: ZoneModel, name: str = "pickup_zone") -> DataFrame:
    return df.withColumn(name, zones.nearest("pickup_latitude", "pickup_longitude"))


def zone_sizes(df: DataFrame, n_zones: int = params.N_ZONES, zone: str = "pickup_zone") -> DataFrame:
    """(zone, n) for every zone of the range, also the empty ones."""
    every = df.sparkSession.range(n_zones).select(F.col("id").cast("int").alias(zone))
    return every.join(df.groupBy(zone).agg(F.count(F.lit(1)).alias("n")), zone, "left").na.fill(0, ["n"])
