from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterlark.errors import ModelNotFittedError
from meterlark.models.isolation import IsolationForest
from meterlark.operators import requests as rules
from meterlark.operators.anomaly import RAW, ScoreScale
from meterlark.plans import scoring
from meterlark.sources.event_trips import fixed_zones
from meterlark.sources.tables import REQUEST_SCHEMA

AT = datetime(2024, 1, 10, 12, 30)


@pytest.fixture(scope="module")
def history(spark):
    hours = spark.range(24 * 12).select(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,int(id))").alias("hour"))
    return hours.select(F.explode(F.sequence(F.lit(0), F.lit(29))).alias("pickup_zone"), "hour", F.lit(6).cast("bigint").alias("pickup_count"))


def request(request_id, **changed):
    values = dict(
        request_id=request_id, pickup_datetime=AT, dropoff_datetime=None, pickup_latitude=40.7580, pickup_longitude=-73.9855,
        dropoff_latitude=40.6413, dropoff_longitude=-73.7781, passenger_count=1, vendor_id=2, store_and_fwd_flag=None,
        zone_id=None, target_datetime=None,
    )
    values.update(changed)
    return tuple(values[f.name] for f in REQUEST_SCHEMA.fields)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), REQUEST_SCHEMA)


def twenty_five_minutes(df):
    return df.withColumn("prediction", F.log1p(F.lit(1500.0)))


def last_day(df):
    return df.withColumn("prediction", F.log1p(F.col("demand_lag_24h").cast("double")))


def fast_is_odd(df):
    scale = ScoreScale(0.0, 1.0, 0.7)
    return scale.apply(df.withColumn(RAW, F.col("average_speed_kmh") / (F.col("average_speed_kmh") + 40)))


def unified(spark, history, *rows):
    scored = scoring.score_unified(frame(spark, *rows), fixed_zones(), history, twenty_five_minutes, last_day, fast_is_odd)
    return {r["request_id"]: r for r in scored.collect()}


def test_four_lifecycles(spark, history):
    found = unified(
        spark, history,
        request(1),
        request(2, dropoff_datetime=AT + timedelta(minutes=25)),
        request(3, dropoff_datetime=AT + timedelta(minutes=1), pickup_latitude=40.6413, pickup_longitude=-73.7781,
                dropoff_latitude=40.7580, dropoff_longitude=-73.9855),
        request(4, dropoff_datetime=AT + timedelta(minutes=20), dropoff_latitude=34.0522, dropoff_longitude=-118.2437),
    )
    before = found[1]
    assert before["request_mode"] == "pre_trip" and before["anomaly"] is None
    assert before["component_status"]["anomaly"]["status"] == "unavailable"
    assert "not yet completed" in before["component_status"]["anomaly"]["reason"]
    zone = before["demand"]["zone_id"]
    assert before["operational_insight"] == (
        f"Estimated trip duration: 25.0 minutes. Pickup zone {zone} is forecast at ~6.0 pickups in the next hour (moderate demand)."
    )
    assert before["demand"]["target_hour"] == "2024-01-10T12:00:00"

    normal = found[2]
    assert normal["request_mode"] == "post_trip" and normal["anomaly"]["is_anomaly"] is False
    assert "(0% deviation) and no anomaly signals were raised" in normal["operational_insight"]
    assert f"(Context: pickup zone {zone} was forecast at ~6.0 pickups/hour" in normal["operational_insight"]

    fast = found[3]
    assert fast["anomaly"]["average_speed_kmh"] == pytest.approx(1306.404, abs=1e-3) and fast["anomaly"]["is_anomaly"]
    assert "Actual duration (60s) deviated 96% from the pre-trip estimate (1500s), reinforcing" in fast["operational_insight"]

    far = found[4]
    assert far["duration"] is None and far["anomaly"] is not None
    assert far["component_status"]["duration"]["reason"] == "dropoff_latitude=34.0522 is outside expected NYC range (40.4, 41.0)."
    assert "notably consistent with the anomaly flag raised above." in far["operational_insight"]


def test_late_but_plausible_and_flagged_on_time(spark, history):
    found = unified(
        spark, history,
        request(1, dropoff_datetime=AT + timedelta(minutes=60)),
        request(2, dropoff_datetime=AT + timedelta(minutes=25), dropoff_latitude=40.41, dropoff_longitude=-74.29, zone_id=29, pickup_latitude=40.99, pickup_longitude=-73.61),
    )
    assert "but was not flagged anomalous - likely explainable variance" in found[1]["operational_insight"]
    assert "so the anomaly flag is likely driven by distance/speed/routing" in found[2]["operational_insight"]


def test_components_fail_alone(spark, history):
    found = unified(
        spark, history,
        request(1, passenger_count=None),
        request(2, zone_id=30),
        request(3, pickup_datetime=None),
        request(4, target_datetime=datetime(2024, 1, 13, 2), dropoff_datetime=AT - timedelta(seconds=5)),
        request(5, vendor_id=3, passenger_count=9, target_datetime=datetime(2024, 1, 1, 5)),
        request(6, store_and_fwd_flag="X", pickup_latitude=None, dropoff_datetime=AT + timedelta(minutes=5)),
        request(7, target_datetime=datetime(2024, 1, 13, 0, 59)),
    )
    reason = lambda i, c: found[i]["component_status"][c]["reason"]
    assert reason(1, "duration") == "missing required field(s): ['passenger_count']" and reason(1, "demand") is None
    assert reason(2, "demand") == "zone_id must be between 0 and 29, got 30." and found[2]["duration"] is not None
    assert reason(3, "duration") == "missing required field(s): ['pickup_datetime']"
    assert reason(3, "demand").startswith("missing required field(s): need target_datetime")
    assert reason(4, "demand").startswith("Cannot compute demand_lag_1h for zone")
    assert "covering 2024-01-01 00:00:00 to 2024-01-12 23:00:00 - " in reason(4, "demand")
    assert reason(4, "anomaly") == "dropoff_datetime must be strictly after pickup_datetime, got a computed duration of -5.0s."
    assert reason(5, "duration") == "passenger_count must be between 1 and 6, got 9."
    assert reason(5, "demand").startswith("Cannot compute demand_lag_24h")
    assert reason(6, "duration") == "missing required field(s): ['pickup_latitude']"
    assert reason(6, "anomaly") == "missing required field(s): ['pickup_latitude']"
    assert found[7]["demand"]["predicted_pickup_count"] == pytest.approx(6.0)  # one hour past the history


def test_first_failing_check_wins(spark):
    df = frame(spark, request(1, vendor_id=3, store_and_fwd_flag="X", pickup_latitude=1.0), request(2, store_and_fwd_flag="X"), request(3))
    rows = [r["x"] for r in df.select(rules.duration_reason().alias("x")).collect()]
    assert rows == ["vendor_id must be one of [1, 2], got 3.", "store_and_fwd_flag must be one of ['N', 'Y'], got 'X'.", None]


def test_completed_trips_may_leave_the_city_but_not_the_globe(spark):
    done = AT + timedelta(minutes=5)
    df = frame(
        spark, request(1, dropoff_datetime=done, dropoff_latitude=34.0), request(2, dropoff_datetime=done, dropoff_latitude=91.5),
        request(3, dropoff_datetime=done, passenger_count=-1), request(4, dropoff_datetime=done, passenger_count=None), request(5),
    )
    rows = [r["x"] for r in df.select(rules.completed_reason().alias("x")).collect()]
    assert rows == [None, "dropoff_latitude=91.5 is not a valid latitude.", "passenger_count cannot be negative, got -1.", None,
                    "Request must include both 'pickup_datetime' and 'dropoff_datetime'."]


def test_constraints_split_the_table(spark):
    df = frame(spark, request(1), request(2, passenger_count=0, zone_id=-1), request(3, pickup_latitude=None))
    valid, rejected = rules.split_valid(df)
    assert [r["request_id"] for r in valid.collect()] == [1]
    assert {r["request_id"]: r["violations"] for r in rejected.collect()} == {2: ["passenger_count", "zone_id"], 3: ["pickup_latitude"]}
    demand = rules.with_violations(df, "demand").select("violations").first()[0]
    assert demand == ["target_datetime"]
    with pytest.raises(ValueError):
        rules.field_constraints("other")


def test_duration_scorer_defaults_the_flag(spark):
    rows = scoring.score_durations(frame(spark, request(1)), twenty_five_minutes, "stub").collect()
    assert rows[0]["duration"]["predicted_duration_minutes"] == pytest.approx(25) and rows[0]["store_and_fwd_flag"] is None


def test_unfitted_detector_is_refused(spark):
    with pytest.raises(ModelNotFittedError):
        IsolationForest().score(spark.range(1))
