import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meterlark.errors import DataValidationError
from trip_rows import RAW
from meterlark.functions import numeric, spatial, temporal
from meterlark.operators import features


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def points(*values):
    return [F.lit(v) for v in values]


def test_airport_ride_in_a_minute(spark):
    ends = points(40.6413, -73.7781, 40.7580, -73.9855)
    km, grid = spatial.haversine_km(*ends), spatial.grid_km(*ends)
    assert one(spark, km) == pytest.approx(21.7734, abs=1e-4)
    assert one(spark, spatial.speed_kmh(km, F.lit(60))) == pytest.approx(1306.404, abs=1e-3)
    assert one(spark, spatial.route_ratio(km, grid)) == pytest.approx(0.7152, abs=1e-4)


def test_slow_long_ride(spark):
    assert one(spark, spatial.speed_kmh(F.lit(28.08451311892809), F.lit(85102))) == pytest.approx(1.188036088789231, rel=1e-12)


def test_identical_points(spark):
    ends = points(40.75, -73.98, 40.75, -73.98)
    km = spatial.haversine_km(*ends)
    assert one(spark, km) == 0 and one(spark, spatial.bearing_degrees(*ends)) == 0
    assert one(spark, spatial.route_ratio(km, spatial.grid_km(*ends))) == 0


def test_grid_distance_takes_the_second_leg_at_the_destination(spark):
    ends = (40.0, -74.0, 41.0, -73.0)
    legs = spatial.haversine_km(*points(40.0, -74.0, 41.0, -74.0)) + spatial.haversine_km(*points(41.0, -74.0, 41.0, -73.0))
    assert one(spark, spatial.grid_km(*points(*ends))) == pytest.approx(one(spark, legs), rel=1e-12)


def test_unknown_coordinate_gives_unknown_distance(spark):
    assert one(spark, spatial.haversine_km(F.lit(None).cast("double"), *points(-74.0, 41.0, -73.0))) is None
    assert math.isnan(one(spark, spatial.haversine_km(*points(float("nan"), -74.0, 41.0, -73.0))))


@pytest.mark.parametrize("bearing,name", [(0.0, "N"), (22.4, "N"), (22.5, "NE"), (337.4, "NW"), (337.5, "N"), (359.9, "N")])
def test_compass_edges(spark, bearing, name):
    assert one(spark, spatial.compass(F.lit(bearing))) == name


def test_speed_without_duration_does_not_fail(spark):
    assert one(spark, spatial.speed_kmh(F.lit(1.0), F.lit(0))) == math.inf
    assert math.isnan(one(spark, spatial.speed_kmh(F.lit(0.0), F.lit(0))))


def test_clip_keeps_unknown_values(spark):
    assert one(spark, numeric.clip(F.lit(None).cast("double"), 0, 1)) is None
    assert math.isnan(one(spark, numeric.clip(F.lit(float("nan")), 0, 1)))
    assert [one(spark, numeric.clip(F.lit(x), 0, 1)) for x in (-1.0, 0.5, 2.0)] == [0.0, 0.5, 1.0]


def test_log_scale_and_floor(spark):
    assert one(spark, numeric.from_log(numeric.to_log(F.lit(100.0)), 10)) == pytest.approx(100)
    assert one(spark, numeric.from_log(numeric.to_log(F.lit(3.0)), 10)) == 10


def test_calendar(spark):
    monday = F.expr("timestamp_ntz'2024-01-01 10:59:59'")
    assert one(spark, temporal.weekday(monday)) == 0
    assert one(spark, temporal.weekday(F.expr("timestamp_ntz'2024-01-07 00:00:00'"))) == 6
    hours = [one(spark, temporal.is_rush_hour(F.lit(h))) for h in (6, 7, 10, 11, 15, 16, 19, 20)]
    assert hours == [0, 1, 1, 0, 0, 1, 1, 0]
    assert spark.range(1).select(temporal.floor_hour(monday).alias("x")).dtypes == [("x", "timestamp_ntz")]


def test_draws_depend_on_key_and_seed_only(spark):
    draws = spark.range(5000).select(numeric.stable_unit(F.col("id"), 42).alias("u"), numeric.stable_unit(F.col("id"), 43).alias("v"))
    row = draws.agg(F.min("u"), F.max("u"), F.avg("u"), F.corr("u", "v")).first()
    assert 0 <= row[0] and row[1] < 1 and abs(row[2] - 0.5) < 0.02 and abs(row[3]) < 0.05


def test_missing_columns_are_named(spark):
    with pytest.raises(DataValidationError, match="dropoff_longitude"):
        spatial.with_spatial_features(spark.range(1).select(F.lit(1.0).alias("pickup_latitude")))
    with pytest.raises(DataValidationError, match="pickup_datetime"):
        temporal.with_temporal_features(spark.range(1))


def test_gate_names_the_bad_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1), (None, float("inf"), 2)], "trip_distance_km double, bearing_sin double, pickup_hour int")
    with pytest.raises(DataValidationError, match="trip_distance_km"):
        features.require_usable(df)
    with pytest.raises(DataValidationError, match="bearing_sin"):
        features.require_usable(df.select("bearing_sin", "pickup_hour"))
    assert features.require_usable(df.select("pickup_hour")).count() == 2


def test_usable_features_stop_at_bad_rows_and_leave_good_ones(spark, trip):
    names = RAW
    good = spark.createDataFrame([trip(1), trip(2, passenger_count=3)], names)
    assert features.usable_features(good).collect() == features.build_features(good).collect()
    assert features.usable_features(good.limit(0)).count() == 0
    for changed, column in (({"pickup_datetime": None}, "pickup_hour missing"), ({"dropoff_latitude": float("inf")}, "trip_distance_km"), ({"pickup_longitude": float("nan")}, "bearing_degrees")):
        bad = spark.createDataFrame([trip(1), trip(2, **changed)], names)
        with pytest.raises(PySparkException, match=column):
            features.usable_features(bad).collect()
        # Rows that a filter takes out are not judged, although the optimizer moves filters down.
        assert features.usable_features(bad.filter("row_seq = 1")).count() == 1
        assert features.usable_features(bad).filter("row_seq = 1").count() == 1
