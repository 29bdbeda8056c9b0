"""Defaults shared by every operator; each is also a keyword argument where it is used."""

# --- Fixed values: thresholds, sizes and tolerances the published results depend on. ---
SEED = 42

MIN_TRIP_SECONDS = 10
MAX_TRIP_SECONDS = 86400
MAX_PASSENGERS = 6
CITY_LAT = (40.4, 41.0)
CITY_LON = (-74.3, -73.6)
GLOBE_LAT = (-90, 90)
GLOBE_LON = (-180, 180)
REMOVAL_WARNING_SHARE = 0.05

RUSH_HOURS = ((7, 10), (16, 19))
EARTH_RADIUS_KM = 6371.0088
COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
RATIO_EPSILON = 1e-6

N_ZONES = 30
ZONE_INITS = 10
LAG_HOURS = (1, 2, 3, 24)
ROLLING_WINDOWS = (3, 6, 24)

DURATION_TEST_SHARE = 0.2
DEMAND_TEST_SHARE = 0.2

FOREST_TREES, FOREST_DEPTH = 200, 16
BOOST_ROUNDS, BOOST_DEPTH, BOOST_RATE = 300, 8, 0.1
DEMAND_FOREST_TREES, DEMAND_FOREST_DEPTH = 200, 14
DEMAND_BOOST_ROUNDS, DEMAND_BOOST_DEPTH = 300, 7
STACK_FOLDS = 3
STACK_FOREST_TREES, STACK_FOREST_DEPTH = 150, 14
STACK_BOOST_ROUNDS, STACK_BOOST_DEPTH = 200, 7
RIDGE_ALPHAS = (0.01, 0.1, 1.0, 10.0, 100.0)

CONTAMINATION = 0.02
ISOLATION_TREES = 100
ISOLATION_SAMPLE = 256

# Smallest denominator of a percentage error: the double-precision machine epsilon.
MAPE_FLOOR = 2.220446049250313e-16
DURATION_DRIFT_SECONDS = 1.0
DEMAND_DRIFT_PICKUPS = 0.1

QUIET_BELOW = 5.0
BUSY_FROM = 20.0
DEVIATION_FLAG_PCT = 50.0

VENDOR_CODES = {1: 0, 2: 1}
STORE_FLAG_CODES = {"N": 0, "Y": 1}
DEFAULT_STORE_FLAG = "N"

# --- Fixed values: column names and their order, which models and outputs rely on. ---
RAW_COLUMNS = (
    "id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "store_and_fwd_flag", "trip_duration",
)
CRITICAL_COLUMNS = (
    "pickup_datetime", "dropoff_datetime",
    "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "passenger_count", "trip_duration",
)
TEMPORAL_COLUMNS = (
    "pickup_hour", "pickup_weekday", "pickup_is_weekend", "pickup_is_rush_hour",
    "pickup_hour_sin", "pickup_hour_cos", "pickup_weekday_sin", "pickup_weekday_cos",
)
SPATIAL_COLUMNS = (
    "trip_distance_km", "manhattan_distance_km", "bearing_degrees",
    "bearing_sin", "bearing_cos", "trip_direction",
)
DURATION_FEATURES = TEMPORAL_COLUMNS + (
    "trip_distance_km", "manhattan_distance_km", "bearing_degrees", "bearing_sin", "bearing_cos",
    "passenger_count", "vendor_id_code", "store_and_fwd_flag_code",
)
CALENDAR_COLUMNS = (
    "hour_of_day", "day_of_week", "is_weekend",
    "hour_of_day_sin", "hour_of_day_cos", "day_of_week_sin", "day_of_week_cos",
)
ANOMALY_FEATURES = (
    "trip_duration", "trip_distance_km", "average_speed_kmh",
    "route_efficiency_ratio", "passenger_count",
)
METRICS = ("mae", "rmse", "mape", "r2")
