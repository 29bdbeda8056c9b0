"""The columns of raw trips in tests."""

RAW = (
    "row_seq bigint, id string, vendor_id string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
    "passenger_count int, pickup_longitude double, pickup_latitude double, dropoff_longitude double, "
    "dropoff_latitude double, store_and_fwd_flag string, trip_duration int"
)
