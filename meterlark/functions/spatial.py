"""Distances, bearings and ratios on coordinates in degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterlark import params
from meterlark.errors import DataValidationError
from meterlark.functions.numeric import clip

COORDINATES = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


def _half_chord(angle: Column) -> Column:
    half = F.sin(angle / 2)
    return half * half


def _arc_km(a: Column) -> Column:
    """Distance for a squared half-chord, which rounding may push slightly past 0 or 1."""
    a = clip(a, 0.0, 1.0)
    return F.lit(2 * params.EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dlon = F.radians(lon2) - F.radians(lon1)
    return _arc_km(_half_chord(phi2 - phi1) + F.cos(phi1) * F.cos(phi2) * _half_chord(dlon))


def grid_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Street-grid distance: north-south at the start's longitude, then east-west at the end's latitude.

    Each leg is the great-circle formula with the other difference at zero.
    """
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dlon = F.radians(lon2) - F.radians(lon1)
    return _arc_km(_half_chord(phi2 - phi1)) + _arc_km(F.cos(phi2) * F.cos(phi2) * _half_chord(dlon))


def bearing_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing in [0, 360), north = 0; identical points give 0."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dlon = F.radians(lon2) - F.radians(lon1)
    east = F.sin(dlon) * F.cos(phi2)
    north = F.cos(phi1) * F.sin(phi2) - F.sin(phi1) * F.cos(phi2) * F.cos(dlon)
    return (F.degrees(F.atan2(east, north)) + 360) % 360


def compass(bearing: Column) -> Column:
    """Eight-way direction, each sector centred on its heading."""
    sector = (F.floor((bearing + 22.5) / 45) % 8).cast("int")
    return F.element_at(F.array(*[F.lit(name) for name in params.COMPASS]), sector + 1)


def with_spatial_features(df: DataFrame) -> DataFrame:
    """Two distances, the bearing with its sine and cosine, and the compass direction."""
    missing = [c for c in COORDINATES if c not in df.columns]
    if missing:
        raise DataValidationError(f"spatial features need the columns {missing}")
    ends = [F.col(c) for c in COORDINATES]
    bearing = bearing_degrees(*ends)
    return df.withColumns(
        {
            "trip_distance_km": haversine_km(*ends),
            "manhattan_distance_km": grid_km(*ends),
            "bearing_degrees": bearing,
        }
    ).withColumns(
        {
            "bearing_sin": F.sin(F.radians("bearing_degrees")),
            "bearing_cos": F.cos(F.radians("bearing_degrees")),
            "trip_direction": compass(F.col("bearing_degrees")),
        }
    )


def speed_kmh(km: Column, seconds: Column) -> Column:
    """Average speed; a zero duration gives infinity (or NaN for no distance), never an error."""
    hours = seconds / F.lit(3600.0)
    at_rest = F.when(km > 0, F.lit(float("inf"))).when(km == 0, F.lit(float("nan")))
    return F.when(hours == 0, at_rest).otherwise(F.try_divide(km, hours))


def route_ratio(km: Column, grid: Column) -> Column:
    """Straight-line over street-grid distance."""
    return km / (grid + F.lit(params.RATIO_EPSILON))


def with_anomaly_features(df: DataFrame) -> DataFrame:
    """Average speed and route efficiency of finished trips."""
    return df.withColumns(
        {
            "average_speed_kmh": speed_kmh(F.col("trip_distance_km"), F.col("trip_duration")),
            "route_efficiency_ratio": route_ratio(F.col("trip_distance_km"), F.col("manhattan_distance_km")),
        }
    )
