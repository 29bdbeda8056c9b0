from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterlark.operators import demand, splits, zones
from meterlark.sources.event_trips import fixed_zones

START = datetime(2024, 1, 1)


def grid(spark, counts):
    rows = [(z, START + timedelta(hours=h), c) for z, series in counts.items() for h, c in enumerate(series)]
    return spark.createDataFrame(rows, "pickup_zone int, hour timestamp_ntz, pickup_count bigint")


def test_rolling_mean_stays_inside_the_zone(spark):
    rows = demand.with_rolling_means(grid(spark, {0: [10, 20, 30, 40], 1: [1, 2, 3, 4]}), [3])
    means = [r["demand_rolling_mean_3h"] for r in rows.filter("pickup_zone = 1").orderBy("hour").collect()]
    assert means == [None, 1.0, 1.5, 2.0]


def test_lag_is_null_before_the_history(spark):
    rows = demand.with_lags(grid(spark, {0: [5, 6, 7]}), [1, 2]).orderBy("hour").collect()
    assert [(r["demand_lag_1h"], r["demand_lag_2h"]) for r in rows] == [(None, None), (5, None), (6, 5)]


def test_no_feature_sees_its_own_hour(spark):
    quiet = demand.with_rolling_means(demand.with_lags(grid(spark, {0: [1] * 30})))
    loud = demand.with_rolling_means(demand.with_lags(grid(spark, {0: [1] * 29 + [1000]})))
    drop = ("pickup_count",)
    assert quiet.drop(*drop).exceptAll(loud.drop(*drop)).count() == 0


def test_grid_covers_empty_zones_and_hours(spark):
    trips = spark.createDataFrame([(3, START + timedelta(minutes=5)), (3, START + timedelta(hours=4, minutes=59)), (None, START)],
                                  "pickup_zone int, pickup_datetime timestamp_ntz")
    rows = demand.hourly_demand(trips, 30).collect()
    assert len(rows) == 30 * 5 and sum(r["pickup_count"] for r in rows) == 2
    assert {r["pickup_zone"] for r in rows} == set(range(30))


def test_counts_are_computed_once(spark, sf_dir):
    from meterlark.sources.event_trips import load_trips

    df = demand.hourly_demand(zones.assign_zone(load_trips(spark, sf_dir), fixed_zones()))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Scan parquet") == 1 and "ReusedExchange" in plan


def test_history_for_requests_uses_what_exists(spark):
    history = grid(spark, {0: list(range(1, 31))}).filter(F.col("hour") != START + timedelta(hours=28))
    known = {r["target_hour"]: r for r in demand.request_history(history).collect()}
    nxt = known[START + timedelta(hours=30)]  # one hour past the end can be served
    assert (nxt["demand_lag_1h"], nxt["demand_lag_2h"], nxt["demand_lag_3h"], nxt["demand_lag_24h"]) == (30, None, 28, 7)
    assert nxt["demand_rolling_mean_3h"] == pytest.approx((30 + 28) / 2)
    assert known[START + timedelta(hours=31)]["demand_lag_1h"] is None
    assert START + timedelta(hours=60) not in known


def test_cutoff_is_one_hour_for_all_zones(spark):
    train, test, cutoff = splits.chronological_split(grid(spark, {0: [1] * 11, 1: [2] * 11}))
    assert cutoff == START + timedelta(hours=8)
    assert train.count() == 16 and test.count() == 6


def test_nearest_zone_ties_and_unknown_points(spark):
    model = zones.ZoneModel(((40.0, -74.0), (41.0, -74.0), (41.0, -74.0)), 0.757)
    df = spark.createDataFrame([(40.5, -74.0), (40.6, -74.0), (None, -74.0), (40.0, None)], "pickup_latitude double, pickup_longitude double")
    assert [r["pickup_zone"] for r in zones.assign_zone(df, model).collect()] == [0, 1, None, None]


def test_many_zones_take_the_loop(spark):
    few = fixed_zones()
    # Far-away extra centroids change the expression but not the answer.
    many = zones.ZoneModel(few.centroids + tuple((10.0 + i, 10.0) for i in range(60)), few.longitude_factor)
    df = spark.range(3000).select((40.6 + F.col("id") % 97 / 250).alias("pickup_latitude"), (-74 + F.col("id") % 83 / 300).alias("pickup_longitude"))
    both = zones.assign_zone(zones.assign_zone(df, few, "a"), many, "b")
    assert both.filter("a <> b").count() == 0 and many.n_zones > zones.UNROLLED_ZONES
