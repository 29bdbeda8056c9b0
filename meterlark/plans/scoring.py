"""Batch scorers: a table of requests in, the same rows with results and status out.

Every scorer is a projection (plus one join to the history for demand), so it runs unchanged on a
stream of requests. A predictor adds the column ``prediction`` on the logarithmic scale.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from meterlark import messages, params
from meterlark.functions.numeric import from_log
from meterlark.functions.spatial import grid_km, haversine_km, with_anomaly_features
from meterlark.functions.temporal import elapsed_seconds, floor_hour, with_calendar
from meterlark.operators import requests as rules
from meterlark.operators.demand import request_history
from meterlark.operators.encoding import with_request_codes, with_zone_dummies
from meterlark.operators.features import build_features
from meterlark.operators.zones import ZoneModel

Predictor = Callable[[DataFrame], DataFrame]


def _keep(df: DataFrame, requests: DataFrame, *added: str) -> DataFrame:
    return df.select(*requests.columns, *added)


def score_durations(
    requests: DataFrame,
    predict: Predictor,
    model_name: str = "stacking_ensemble",
    floor: float = params.MIN_TRIP_SECONDS,
) -> DataFrame:
    """Add ``duration`` (seconds, minutes, model name; null when unavailable) and ``duration_status``."""
    reason = F.coalesce(rules.missing_reason(rules.DURATION_FIELDS), rules.duration_reason())
    checked = requests.withColumn("_flag", F.col("store_and_fwd_flag")).withColumn("_reason", reason)
    features = build_features(with_request_codes(checked.withColumn("store_and_fwd_flag", rules.store_flag())))
    seconds = from_log(F.col("prediction"), floor)
    result = F.struct(
        seconds.alias("predicted_duration_seconds"),
        (seconds / 60).alias("predicted_duration_minutes"),
        F.lit(model_name).alias("model_name"),
    )
    scored = predict(features).withColumns(
        {
            "duration": F.when(F.col("_reason").isNull(), result),
            "duration_status": rules.status(F.col("_reason")),
            "store_and_fwd_flag": F.col("_flag"),
        }
    )
    return _keep(scored, requests, "duration", "duration_status")


def resolved_zone(zones: ZoneModel) -> Column:
    """The given zone, else the nearest one.

    A plain coalesce would make the distances conditional, and Spark then builds them twice per row.
    """
    given, nearest = F.col("zone_id").cast("int"), zones.nearest("pickup_latitude", "pickup_longitude")
    return F.when(nearest.isNull() | given.isNotNull(), given).otherwise(nearest)


def with_request_demand(
    requests: DataFrame,
    zones: ZoneModel,
    history: DataFrame,
    lags=params.LAG_HOURS,
    windows=params.ROLLING_WINDOWS,
    target: Column | None = None,
) -> DataFrame:
    """Resolve zone and hour, look up the history, and say why a request cannot be served.

    Adds ``pickup_zone``, ``target_hour``, the demand features and ``demand_reason``. The history is
    summarised per zone and hour first; requests meet it in one join, whose kind adaptive execution chooses by the bytes
    it finds. Nothing runs while the plan is built.
    """
    target = F.col("target_datetime") if target is None else target
    located = requests.withColumns(
        {
            "pickup_zone": resolved_zone(zones),
            "target_hour": floor_hour(target),
        }
    )
    known = request_history(history, lags, windows).withColumnRenamed("zone_id", "pickup_zone")
    joined = located.join(known, ["pickup_zone", "target_hour"], "left")
    # One subquery for the whole table, needed only inside a message.
    spanned = joined.withColumn("_span", rules.history_span(history))
    reason = F.coalesce(
        rules.zone_reason("pickup_zone", zones.n_zones),
        F.when(F.col("target_hour").isNull(), F.lit(messages.NO_TARGET)),
        rules.history_reason("pickup_zone", "target_hour", F.col("_span"), lags, windows),
    )
    return with_calendar(spanned.withColumn("demand_reason", reason), "target_hour").drop("_span")


def score_demand(
    requests: DataFrame,
    zones: ZoneModel,
    history: DataFrame,
    predict: Predictor,
    model_name: str,
    lags=params.LAG_HOURS,
    windows=params.ROLLING_WINDOWS,
    fallback_to_pickup: bool = False,
) -> DataFrame:
    """Add ``demand`` (count, zone, hour, model name; null when unavailable) and ``demand_status``."""
    target, missing = F.col("target_datetime"), F.lit(None).cast("string")
    if fallback_to_pickup:
        target = F.coalesce(target, F.col("pickup_datetime"))
        placed = F.col("zone_id").isNotNull() | (
            F.col("pickup_latitude").isNotNull() & F.col("pickup_longitude").isNotNull()
        )
        missing = F.when(target.isNull() | ~placed, F.lit(messages.MISSING_DEMAND_FIELDS))
    joined = with_request_demand(requests, zones, history, lags, windows, target)
    reason = F.coalesce(missing, F.col("demand_reason"))
    scored = predict(with_zone_dummies(joined, zones.n_zones))
    result = F.struct(
        from_log(F.col("prediction"), 0.0).alias("predicted_pickup_count"),
        F.col("pickup_zone").alias("zone_id"),
        F.date_format("target_hour", "yyyy-MM-dd'T'HH:mm:ss").alias("target_hour"),
        F.lit(model_name).alias("model_name"),
    )
    scored = scored.withColumns({"demand": F.when(reason.isNull(), result), "demand_status": rules.status(reason)})
    return _keep(scored, requests, "demand", "demand_status")


def completed_features(requests: DataFrame) -> DataFrame:
    """Requests with the five anomaly features, from timestamps and coordinates alone."""
    ends = [F.col(c) for c in rules.COORDINATES]
    measured = requests.withColumns(
        {
            "trip_duration": elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime")),
            "trip_distance_km": haversine_km(*ends),
            "manhattan_distance_km": grid_km(*ends),
            "passenger_count": F.coalesce(F.col("passenger_count"), F.lit(0)),
        }
    )
    return with_anomaly_features(measured)


def score_anomalies(requests: DataFrame, score: Callable[[DataFrame], DataFrame], unified: bool = False) -> DataFrame:
    """Add ``anomaly`` (score, flag and the features behind them) and ``anomaly_status``.

    ``score`` adds ``anomaly_score`` and ``is_anomaly`` to rows with the anomaly features.
    """
    reason = rules.completed_reason()
    if unified:
        reason = F.coalesce(
            F.when(F.col("dropoff_datetime").isNull(), F.lit(messages.NOT_COMPLETED)),
            rules.missing_reason(rules.ANOMALY_FIELDS),
            reason,
        )
    checked = requests.withColumns({"_reason": reason, "_passengers": F.col("passenger_count")})
    result = F.struct(
        "anomaly_score",
        "is_anomaly",
        F.col("trip_duration").alias("trip_duration_seconds"),
        "trip_distance_km",
        "average_speed_kmh",
        "route_efficiency_ratio",
    )
    scored = score(completed_features(checked)).withColumns(
        {
            "anomaly": F.when(F.col("_reason").isNull(), result),
            "anomaly_status": rules.status(F.col("_reason")),
            "passenger_count": F.col("_passengers"),
        }
    )
    return _keep(scored, requests, "anomaly", "anomaly_status")


def score_unified(
    requests: DataFrame,
    zones: ZoneModel,
    history: DataFrame,
    predict_duration: Predictor,
    predict_demand: Predictor,
    score_anomaly: Callable[[DataFrame], DataFrame],
    duration_model: str = "stacking_ensemble",
    demand_model: str = "boosted_trees",
) -> DataFrame:
    """All three components for every request, one nested row each; a failed part never blocks the others."""
    scored = score_durations(requests, predict_duration, duration_model)
    scored = score_demand(scored, zones, history, predict_demand, demand_model, fallback_to_pickup=True)
    scored = score_anomalies(scored, score_anomaly, unified=True).withColumn("request_mode", rules.mode())
    component_status = F.create_map(
        F.lit("duration"), F.col("duration_status"),
        F.lit("demand"), F.col("demand_status"),
        F.lit("anomaly"), F.col("anomaly_status"),
    )
    return scored.select(
        "request_id",
        "request_mode",
        "duration",
        "demand",
        "anomaly",
        component_status.alias("component_status"),
        rules.insight().alias("operational_insight"),
    )
