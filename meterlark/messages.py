"""Wording of reasons and insights.

Fixed values: callers match on these texts, so wording, order and number formats must not change.
``%s`` takes a value as text, ``%.nf`` a number.
"""

MISSING_FIELDS = "missing required field(s): %s"
MISSING_DEMAND_FIELDS = (
    "missing required field(s): need target_datetime (or pickup_datetime as "
    "a fallback) plus either zone_id or pickup_latitude/pickup_longitude."
)
NOT_COMPLETED = (
    "Trip not yet completed - no dropoff_datetime supplied. "
    "Anomaly detection requires a completed trip's actual outcome."
)

BAD_PASSENGERS = "passenger_count must be between 1 and %s, got %s."
BAD_VENDOR = "vendor_id must be one of [1, 2], got %s."
BAD_STORE_FLAG = "store_and_fwd_flag must be one of ['N', 'Y'], got %s."
OUTSIDE_CITY = "%s=%s is outside expected NYC range (%s, %s)."

NO_ZONE = "Request must include either 'zone_id', or both 'pickup_latitude' and 'pickup_longitude'."
BAD_ZONE = "zone_id must be between 0 and %s, got %s."
NO_TARGET = "Request must include 'target_datetime'."
NO_LAG = (
    "Cannot compute demand_lag_%sh for zone %s at %s: missing historical data. "
    "This demo serves predictions from a static snapshot covering %s to %s - "
    "target_datetime must fall within that range, with at least %sh of preceding history available."
)
NO_WINDOW = (
    "Cannot compute demand_rolling_mean_%sh for zone %s at %s: no historical data available "
    "in that window. Snapshot covers %s to %s."
)

NO_TIMES = "Request must include both 'pickup_datetime' and 'dropoff_datetime'."
BAD_ELAPSED = "dropoff_datetime must be strictly after pickup_datetime, got a computed duration of %ss."
MISSING_COORDINATES = "Request missing coordinate field(s): %s."
BAD_LATITUDE = "%s=%s is not a valid latitude."
BAD_LONGITUDE = "%s=%s is not a valid longitude."
NEGATIVE_PASSENGERS = "passenger_count cannot be negative, got %s."

INSIGHT_DURATION = "Estimated trip duration: %.1f minutes."
INSIGHT_NO_DURATION = "Duration prediction unavailable (%s)."
INSIGHT_DEMAND = "Pickup zone %s is forecast at ~%.1f pickups in the next hour (%s demand)."
INSIGHT_NO_DEMAND = "Zonal demand forecast unavailable (%s)."
INSIGHT_SCORE = "Anomaly score: %.3f (%s)."
SCORE_FLAGGED = "FLAGGED for review"
SCORE_NORMAL = "within normal range"
INSIGHT_NO_SCORE = "Anomaly scoring unavailable (%s)."
INSIGHT_DEVIATED_FLAGGED = (
    "Actual duration (%.0fs) deviated %.0f%% from the pre-trip estimate (%.0fs), reinforcing the "
    "anomaly flag - this looks like a genuine data/meter issue, not just normal trip variance."
)
INSIGHT_DEVIATED = (
    "Actual duration deviated %.0f%% from the pre-trip estimate, but was not flagged anomalous - "
    "likely explainable variance (traffic, routing choice) rather than a data error."
)
INSIGHT_FLAGGED = (
    "Duration matched the pre-trip estimate closely (%.0f%% deviation), so the anomaly flag is "
    "likely driven by distance/speed/routing rather than timing - see route_efficiency_ratio and "
    "average_speed_kmh in the anomaly result."
)
INSIGHT_NORMAL = (
    "Duration matched the pre-trip estimate closely (%.0f%% deviation) and no anomaly signals were "
    "raised - a normal, well-recorded trip."
)
INSIGHT_UNCHECKED = (
    "Duration prediction unavailable (%s). This commonly happens when a trip's coordinates fall "
    "outside the range the duration model trained on - notably consistent with %s."
)
UNCHECKED_FLAGGED = "the anomaly flag raised above"
UNCHECKED_NORMAL = "this trip, even though it was not flagged as anomalous"
INSIGHT_CONTEXT = (
    "(Context: pickup zone %s was forecast at ~%.1f pickups/hour around this trip's start.)"
)
