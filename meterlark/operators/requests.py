"""Rules for request rows: field constraints, validation reasons, mode, tier, deviation, insight.

A bad request keeps its row and gets a reason; nothing here raises for a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from meterlark import messages, params
from meterlark.functions.numeric import outside
from meterlark.functions.temporal import elapsed_seconds

COORDINATES = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")

# Which fields a component needs, in the order a reason lists them.
DURATION_FIELDS = (
    "pickup_datetime", "pickup_latitude", "pickup_longitude",
    "dropoff_latitude", "dropoff_longitude", "passenger_count", "vendor_id",
)
ANOMALY_FIELDS = (
    "pickup_datetime", "dropoff_datetime",
    "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude",
)


def _shown(name: str, quote: bool = False) -> Column:
    """A value as it appears inside a message."""
    text = F.col(name).cast("string")
    return F.coalesce(F.concat(F.lit("'"), text, F.lit("'")) if quote else text, F.lit("None"))


def _name_list(names: Column) -> Column:
    return F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))


def missing_fields(fields: Sequence[str]) -> Column:
    """Names of the fields that are null, in order."""
    return F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]))


def missing_reason(fields: Sequence[str]) -> Column:
    missing = missing_fields(fields)
    return F.when(F.size(missing) > 0, F.format_string(messages.MISSING_FIELDS, _name_list(missing)))


def store_flag() -> Column:
    """The flag cannot be known before the ride; absent means the usual value."""
    return F.coalesce(F.col("store_and_fwd_flag"), F.lit(params.DEFAULT_STORE_FLAG))


def duration_reason(
    most_passengers: int = params.MAX_PASSENGERS, lat=params.CITY_LAT, lon=params.CITY_LON
) -> Column:
    """First reason why a duration cannot be predicted, null when it can."""
    checks = [
        F.when(
            outside(F.col("passenger_count"), (1, most_passengers)),
            F.format_string(messages.BAD_PASSENGERS, F.lit(str(most_passengers)), _shown("passenger_count")),
        ),
        F.when(
            ~F.coalesce(F.col("vendor_id").isin(*params.VENDOR_CODES), F.lit(False)),
            F.format_string(messages.BAD_VENDOR, _shown("vendor_id")),
        ),
        F.when(
            ~store_flag().isin(*params.STORE_FLAG_CODES),
            F.format_string(messages.BAD_STORE_FLAG, _shown("store_and_fwd_flag", quote=True)),
        ),
    ]
    for name, bounds in (
        ("pickup_latitude", lat), ("dropoff_latitude", lat), ("pickup_longitude", lon), ("dropoff_longitude", lon),
    ):
        low, high = (F.lit(str(b)) for b in bounds)
        text = F.format_string(messages.OUTSIDE_CITY, F.lit(name), _shown(name), low, high)
        checks.append(F.when(outside(F.col(name), bounds), text))
    return F.coalesce(*checks)


def zone_reason(zone: str, n_zones: int = params.N_ZONES) -> Column:
    """Why a resolved zone cannot be served, null when it can."""
    bad = ~F.col(zone).between(0, n_zones - 1)
    return F.coalesce(
        F.when(F.col(zone).isNull(), F.lit(messages.NO_ZONE)),
        F.when(bad, F.format_string(messages.BAD_ZONE, F.lit(str(n_zones - 1)), _shown(zone))),
    )


def history_reason(
    zone: str, target: str, span: Column, lags=params.LAG_HOURS, windows=params.ROLLING_WINDOWS
) -> Column:
    """The first lag, then the first mean, the history cannot provide; ``span`` is struct(first, last)."""
    reach = max([*lags, *windows])
    first, last = span["first"].cast("string"), span["last"].cast("string")
    where = [_shown(zone), _shown(target)]
    checks = [
        F.when(
            F.col(f"demand_lag_{h}h").isNull(),
            F.format_string(messages.NO_LAG, F.lit(str(h)), *where, first, last, F.lit(str(reach))),
        )
        for h in lags
    ] + [
        F.when(
            F.col(f"demand_rolling_mean_{w}h").isNull(),
            F.format_string(messages.NO_WINDOW, F.lit(str(w)), *where, first, last),
        )
        for w in windows
    ]
    return F.coalesce(*checks)


def completed_reason() -> Column:
    """First reason why a finished trip cannot be scored. The city box is deliberately not a reason:
    points outside it are what the detector is for."""
    seconds = elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    missing = missing_fields(COORDINATES)
    checks = [
        F.when(seconds.isNull(), F.lit(messages.NO_TIMES)),
        F.when(seconds <= 0, F.format_string(messages.BAD_ELAPSED, seconds.cast("string"))),
        F.when(F.size(missing) > 0, F.format_string(messages.MISSING_COORDINATES, _name_list(missing))),
    ]
    for names, bounds, text in (
        (("pickup_latitude", "dropoff_latitude"), params.GLOBE_LAT, messages.BAD_LATITUDE),
        (("pickup_longitude", "dropoff_longitude"), params.GLOBE_LON, messages.BAD_LONGITUDE),
    ):
        checks += [
            F.when(outside(F.col(n), bounds), F.format_string(text, F.lit(n), _shown(n))) for n in names
        ]
    negative = F.col("passenger_count") < 0
    checks.append(F.when(negative, F.format_string(messages.NEGATIVE_PASSENGERS, _shown("passenger_count"))))
    return F.coalesce(*checks)


def mode() -> Column:
    return F.when(F.col("dropoff_datetime").isNotNull(), "post_trip").otherwise("pre_trip")


def status(reason: Column) -> Column:
    """struct(status, reason): ok without a reason, unavailable with one."""
    return F.struct(
        F.when(reason.isNull(), "ok").otherwise("unavailable").alias("status"), reason.alias("reason")
    )


def demand_tier(count: Column, quiet=params.QUIET_BELOW, busy=params.BUSY_FROM) -> Column:
    return F.when(count < quiet, "quiet").when(count >= busy, "busy").when(count.isNotNull(), "moderate")


def deviation_pct(actual: Column, predicted: Column) -> Column:
    """How far the actual duration is from the prediction, in percent of the prediction."""
    return F.try_divide(F.abs(actual - predicted), predicted) * 100


def insight(flag_at: float = params.DEVIATION_FLAG_PCT) -> Column:
    """One text from the columns duration, demand, anomaly and their ``*_status``.

    Before a trip: its duration and the zone's demand. After it: the anomaly score first, then how
    the duration estimate bears on it, then the zone as context.
    """
    text = F.format_string
    count, zone = F.col("demand.predicted_pickup_count"), F.col("demand.zone_id").cast("string")
    seconds, reason = F.col("duration.predicted_duration_seconds"), F.col("duration_status.reason")
    has_duration, has_demand, has_score = (F.col(c).isNotNull() for c in ("duration", "demand", "anomaly"))

    before = F.concat_ws(
        " ",
        F.when(has_duration, text(messages.INSIGHT_DURATION, F.col("duration.predicted_duration_minutes")))
        .otherwise(text(messages.INSIGHT_NO_DURATION, reason)),
        F.when(has_demand, text(messages.INSIGHT_DEMAND, zone, count, demand_tier(count)))
        .otherwise(text(messages.INSIGHT_NO_DEMAND, F.col("demand_status.reason"))),
    )

    flagged, actual = F.col("anomaly.is_anomaly"), F.col("anomaly.trip_duration_seconds")
    off = deviation_pct(actual, seconds)
    checked = (
        F.when((off >= flag_at) & flagged, text(messages.INSIGHT_DEVIATED_FLAGGED, actual, off, seconds))
        .when(off >= flag_at, text(messages.INSIGHT_DEVIATED, off))
        .when(flagged, text(messages.INSIGHT_FLAGGED, off))
        .otherwise(text(messages.INSIGHT_NORMAL, off))
    )
    note = F.when(flagged, messages.UNCHECKED_FLAGGED).otherwise(messages.UNCHECKED_NORMAL)
    verdict = F.when(flagged, messages.SCORE_FLAGGED).otherwise(messages.SCORE_NORMAL)
    after = F.concat_ws(
        " ",
        F.when(has_score, text(messages.INSIGHT_SCORE, F.col("anomaly.anomaly_score"), verdict))
        .otherwise(text(messages.INSIGHT_NO_SCORE, F.col("anomaly_status.reason"))),
        F.when(has_score & has_duration, checked).when(has_score, text(messages.INSIGHT_UNCHECKED, reason, note)),
        F.when(has_demand, text(messages.INSIGHT_CONTEXT, zone, count)),
    )
    return F.when(F.col("request_mode") == "pre_trip", before).otherwise(after)


def _within(name: str, bounds, optional: bool = False) -> Column:
    ok = ~outside(F.col(name), bounds)
    return (F.col(name).isNull() | ok) if optional else ok


def _known(name: str) -> Column:
    return F.col(name).isNotNull()


def field_constraints(kind: str) -> dict[str, Column]:
    """Named conditions a request of this kind must meet: duration, demand, anomaly or trip."""
    lat, lon = params.GLOBE_LAT, params.GLOBE_LON
    ends = {n: _within(n, lat if "latitude" in n else lon) for n in COORDINATES}
    flag_ok = F.col("store_and_fwd_flag").isNull() | F.col("store_and_fwd_flag").isin("N", "Y")
    zone_ok = F.coalesce(F.col("zone_id") >= 0, F.lit(True))
    at_least_one = F.coalesce(F.col("passenger_count") >= 1, F.lit(False))
    riders = {"pickup_datetime": _known("pickup_datetime"), "passenger_count": at_least_one, "vendor_id": _known("vendor_id")}
    if kind == "duration":
        return {**ends, **riders, "store_and_fwd_flag": flag_ok}
    if kind == "trip":
        return {**ends, **riders, "store_and_fwd_flag": flag_ok, "zone_id": zone_ok}
    if kind == "anomaly":
        return {
            **ends,
            "pickup_datetime": _known("pickup_datetime"),
            "dropoff_datetime": _known("dropoff_datetime"),
            "passenger_count": F.coalesce(F.col("passenger_count") >= 0, F.lit(True)),
        }
    if kind == "demand":
        return {
            "target_datetime": _known("target_datetime"),
            "zone_id": zone_ok,
            "pickup_latitude": _within("pickup_latitude", lat, optional=True),
            "pickup_longitude": _within("pickup_longitude", lon, optional=True),
            "zone_or_coordinates": _known("zone_id") | (_known("pickup_latitude") & _known("pickup_longitude")),
        }
    raise ValueError(f"unknown request kind {kind!r}")


def with_violations(df: DataFrame, kind: str = "trip") -> DataFrame:
    """Add ``violations``: names of the constraints a row breaks, empty for a valid row."""
    broken = [F.when(~ok, F.lit(name)) for name, ok in field_constraints(kind).items()]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, kind: str = "trip") -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their violations)."""
    checked = with_violations(df, kind)
    return checked.filter(F.size("violations") == 0).drop("violations"), checked.filter(F.size("violations") > 0)


def history_span(history: DataFrame) -> Column:
    """struct(first, last) hour of the history, as a one-value subquery."""
    return history.agg(F.struct(F.min("hour").alias("first"), F.max("hour").alias("last")).alias("span")).scalar()


