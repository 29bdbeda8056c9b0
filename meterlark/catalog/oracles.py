"""SQL for DuckDB with the results the queries must give, written without looking at the Spark side.

Queries built on fitted models or random starts have no SQL; tests check their properties.
"""

from __future__ import annotations

from meterlark import messages, params
from meterlark.sources.event_trips import CENTROIDS_SQL, LONGITUDE_FACTOR, REQUESTS_SQL, TRIPS_SQL

ORACLES: dict[str, str] = {}


def r(x: str, places: int = 6) -> str:
    """Rounded, with minus zero turned into zero."""
    return f"(CASE WHEN round({x}, {places}) = 0 THEN 0.0::DOUBLE ELSE round({x}, {places}) END)"


def text(template: str, *values: str) -> str:
    """A message as an expression; values are SQL."""
    pieces = template.replace("%%", "%").split("%s")
    parts = []
    for piece, value in zip(pieces, [*values, None]):
        if piece:
            parts.append("'" + piece.replace("'", "''") + "'")
        if value is not None:
            parts.append(value)
    return " || ".join(parts)


def shown(x: str) -> str:
    return f"coalesce({x}::VARCHAR, 'None')"


LAT, LON = (40.4, 41.0), (-74.3, -73.6)


def box(end: str) -> str:
    return (
        f"NOT coalesce({end}_latitude BETWEEN {LAT[0]} AND {LAT[1]}, false) OR "
        f"NOT coalesce({end}_longitude BETWEEN {LON[0]} AND {LON[1]}, false)"
    )


RULES = {
    "duration_mismatch": "coalesce(abs(date_diff('microsecond', pickup_datetime, dropoff_datetime) / 1e6 - trip_duration) > 1, false)",
    "duration_out_of_bounds": "NOT coalesce(trip_duration BETWEEN 10 AND 86400, false)",
    "pickup_out_of_bounds": box("pickup"),
    "dropoff_out_of_bounds": box("dropoff"),
    "invalid_passenger_count": "coalesce(passenger_count = 0 OR passenger_count > 6, false)",
    "missing_critical_values": " OR ".join(f"{c} IS NULL" for c in params.CRITICAL_COLUMNS),
}
CASES = " ".join(f"WHEN {bad} THEN '{name}'" for name, bad in RULES.items())


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(sin(radians({lat2} - {lat1}) / 2) ** 2 + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* sin(radians({lon2} - {lon1}) / 2) ** 2)"
    )
    return f"(2 * 6371.0088 * atan2(sqrt(least({a}, 1.0)), sqrt(1 - least({a}, 1.0))))"


ENDS = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
P_LAT, P_LON, D_LAT, D_LON = ENDS
KM = haversine(*ENDS)
GRID_KM = f"({haversine(P_LAT, P_LON, D_LAT, P_LON)} + {haversine(D_LAT, P_LON, D_LAT, D_LON)})"
BEARING = (
    f"((degrees(atan2(sin(radians({D_LON}) - radians({P_LON})) * cos(radians({D_LAT})), "
    f"cos(radians({P_LAT})) * sin(radians({D_LAT})) - sin(radians({P_LAT})) * cos(radians({D_LAT})) "
    f"* cos(radians({D_LON}) - radians({P_LON})))) + 360) % 360)"
)


def circle(hour: str, day: str, prefix: str, names: tuple[str, str]) -> str:
    h, d = names
    return (
        f"sin(2 * pi() * {hour} / 24) AS {prefix}{h}_sin, cos(2 * pi() * {hour} / 24) AS {prefix}{h}_cos, "
        f"sin(2 * pi() * {day} / 7) AS {prefix}{d}_sin, cos(2 * pi() * {day} / 7) AS {prefix}{d}_cos"
    )


HOUR, DAY = "hour(pickup_datetime)", "(isodow(pickup_datetime) - 1)"
FACTOR = repr(LONGITUDE_FACTOR)


def unit(key: str, seed: int) -> str:
    """The hash draw of a key: twelve hexadecimal digits of an MD5 as a fraction."""
    return f"(('0x' || substr(md5(concat_ws(':', ({key})::VARCHAR, '{seed}')), 1, 12))::BIGINT / {float(2 ** 48)!r})"


CTES = {
    "trips": TRIPS_SQL.format(events="events"),
    "firsts": "SELECT * FROM trips QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_seq) = 1",
    "judged": f"SELECT *, CASE {CASES} END AS failed FROM firsts",
    "clean": "SELECT * EXCLUDE (failed) FROM judged WHERE failed IS NULL",
    "featured": f"""
        SELECT *, CASE (floor((bearing_degrees + 22.5) / 45)::INT) % 8 WHEN 0 THEN 'N' WHEN 1 THEN 'NE' WHEN 2 THEN 'E'
            WHEN 3 THEN 'SE' WHEN 4 THEN 'S' WHEN 5 THEN 'SW' WHEN 6 THEN 'W' ELSE 'NW' END AS trip_direction,
            sin(radians(bearing_degrees)) AS bearing_sin, cos(radians(bearing_degrees)) AS bearing_cos,
            trip_distance_km / (trip_duration / 3600.0::DOUBLE) AS average_speed_kmh,
            trip_distance_km / (manhattan_distance_km + 1e-6) AS route_efficiency_ratio
        FROM (SELECT *, {HOUR} AS pickup_hour, {DAY} AS pickup_weekday, ({DAY} >= 5)::INT AS pickup_is_weekend,
            ({HOUR} BETWEEN 7 AND 10 OR {HOUR} BETWEEN 16 AND 19)::INT AS pickup_is_rush_hour,
            {circle(HOUR, DAY, 'pickup_', ('hour', 'weekday'))},
            {KM} AS trip_distance_km, {GRID_KM} AS manhattan_distance_km, {BEARING} AS bearing_degrees FROM clean)""",
    "train": f"""
        SELECT * REPLACE (CASE vendor_id WHEN '1' THEN 0 WHEN '2' THEN 1 ELSE -1 END AS vendor_id,
            CASE store_and_fwd_flag WHEN 'N' THEN 0 WHEN 'Y' THEN 1 ELSE -1 END AS store_and_fwd_flag)
        FROM featured WHERE {unit('id', 42)} >= 0.2::DOUBLE""",
    "long": """
        SELECT unnest([pickup_hour, pickup_weekday, pickup_is_weekend, pickup_is_rush_hour, pickup_hour_sin, pickup_hour_cos, pickup_weekday_sin,
            pickup_weekday_cos, trip_distance_km, manhattan_distance_km, bearing_degrees, bearing_sin, bearing_cos, passenger_count,
            vendor_id, store_and_fwd_flag]::DOUBLE[]) AS x, unnest(range(16)) AS feature, ln(1 + trip_duration) AS y FROM train""",
    "centroids": CENTROIDS_SQL,
    "zoned": f"""
        SELECT t.*, (SELECT zone_id FROM centroids c ORDER BY (t.{P_LAT} - c.lat) * (t.{P_LAT} - c.lat)
            + ((t.{P_LON} - c.lon) * {FACTOR}) * ((t.{P_LON} - c.lon) * {FACTOR}), zone_id LIMIT 1) AS pickup_zone
        FROM clean t""",
    "counts": "SELECT pickup_zone, date_trunc('hour', pickup_datetime) AS hour, count(*) AS n FROM zoned GROUP BY ALL",
    "hours": "SELECT unnest(generate_series((SELECT min(hour) FROM counts), (SELECT max(hour) FROM counts), INTERVAL 1 HOUR)) AS hour",
    "grid": """
        SELECT z.zone_id AS pickup_zone, h.hour, coalesce(c.n, 0)::BIGINT AS pickup_count
        FROM centroids z CROSS JOIN hours h LEFT JOIN counts c ON c.pickup_zone = z.zone_id AND c.hour = h.hour""",
    "windowed": "SELECT *, "
    + ", ".join(f"lag(pickup_count, {h}) OVER w AS demand_lag_{h}h" for h in params.LAG_HOURS)
    + ", "
    + ", ".join(
        f"avg(pickup_count) OVER (w ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS demand_rolling_mean_{w}h"
        for w in params.ROLLING_WINDOWS
    )
    + " FROM grid WINDOW w AS (PARTITION BY pickup_zone ORDER BY hour)",
    "calendar": f"""
        SELECT *, hour(hour) AS hour_of_day, isodow(hour) - 1 AS day_of_week, (isodow(hour) >= 6)::INT AS is_weekend,
            {circle('hour(hour)', '(isodow(hour) - 1)', '', ('hour_of_day', 'day_of_week'))} FROM windowed""",
    "demand": "SELECT * FROM calendar WHERE demand_lag_24h IS NOT NULL",
    "forecasts": """
        SELECT pickup_zone, hour, 'lag_24' AS model, pickup_count::DOUBLE AS y_true, demand_lag_24h::DOUBLE AS y_pred FROM demand
        UNION ALL SELECT pickup_zone, hour, 'mean_24', pickup_count::DOUBLE, demand_rolling_mean_24h FROM demand""",
    "metrics": """
        SELECT model, avg(abs(y_true - y_pred)) AS mae, sqrt(avg((y_true - y_pred) ** 2)) AS rmse,
            avg(abs(y_true - y_pred) / greatest(abs(y_true), 2.220446049250313e-16)) AS mape,
            1 - sum((y_true - y_pred) ** 2) / (var_pop(y_true) * count(*)) AS r2, count(*) AS n FROM forecasts GROUP BY model""",
    "scores": """
        SELECT *, average_speed_kmh / (average_speed_kmh + 40) AS anomaly_score_raw FROM featured""",
    "scored": """
        SELECT *, least(greatest((anomaly_score_raw - 0.05) / (0.9 - 0.05 + 1e-6), 0.0), 1.0) AS anomaly_score,
            anomaly_score_raw > 0.6 AS is_anomaly FROM scores""",
    "requests": REQUESTS_SQL.format(trips="trips"),
    "located": f"""
        SELECT q.*, coalesce(q.zone_id, CASE WHEN {P_LAT} IS NOT NULL AND {P_LON} IS NOT NULL THEN
            (SELECT zone_id FROM centroids c ORDER BY (q.{P_LAT} - c.lat) * (q.{P_LAT} - c.lat)
            + ((q.{P_LON} - c.lon) * {FACTOR}) * ((q.{P_LON} - c.lon) * {FACTOR}), zone_id LIMIT 1) END) AS resolved FROM requests q""",
    "unplaced": "SELECT * FROM located WHERE request_id % 13 <> 0 UNION ALL SELECT * REPLACE (zone_id AS resolved) FROM located WHERE request_id % 13 = 0",
}


def with_ctes(sql: str) -> str:
    """Prefix the needed common tables, in order."""
    needed: list[str] = []

    def need(body: str) -> None:
        for name in CTES:
            if f" {name}" in body.replace("\n", " ") and name not in needed and _mentions(body, name):
                need(CTES[name])
                if name not in needed:
                    needed.append(name)

    need(sql)
    if not needed:
        return sql
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in needed) + " " + sql


def _mentions(body: str, name: str) -> bool:
    words = body.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(a.upper() in ("FROM", "JOIN") and b == name for a, b in zip(words, words[1:]))


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = with_ctes(sql)


TRIP_COLUMNS = (
    "id, vendor_id, pickup_datetime, dropoff_datetime, passenger_count::BIGINT AS passenger_count, "
    + ", ".join(f"{r(c)} AS {c}" for c in ENDS)
    + ", store_and_fwd_flag, trip_duration::BIGINT AS trip_duration"
)
oracle("s1_trip_csv", f"SELECT {TRIP_COLUMNS} FROM trips")
oracle("s2_required_columns", "SELECT " + ", ".join(f"count({c}) AS {c}" for c in params.RAW_COLUMNS) + " FROM trips")
oracle("s3_parse_timestamps", "SELECT row_seq, pickup_datetime FROM trips")
oracle(
    "s4_request_rows",
    "SELECT request_id, pickup_datetime, dropoff_datetime, " + ", ".join(f"{r(c)} AS {c}" for c in ENDS)
    + ", passenger_count::BIGINT AS passenger_count, vendor_id::BIGINT AS vendor_id, store_and_fwd_flag, "
    "zone_id::BIGINT AS zone_id, target_datetime FROM requests",
)
oracle("s5_stage_parquet", f"SELECT row_seq, {TRIP_COLUMNS} FROM clean")
METRIC_ROWS = f"SELECT model, {r('mae')} AS mae, {r('rmse')} AS rmse, {r('r2')} AS r2 FROM metrics"
oracle("s6_metric_csv", METRIC_ROWS)
oracle("s7_metric_table", METRIC_ROWS)

REPORT = f"""
    SELECT (SELECT count(*) FROM trips) AS rows_initial,
        (SELECT count(*) FROM trips) - (SELECT count(*) FROM firsts) AS duplicate_ids,
        {', '.join(f"(SELECT count(*) FROM judged WHERE failed = '{n}') AS {n}" for n in RULES)},
        (SELECT count(*) FROM clean) AS rows_final,
        (SELECT count(*) FROM trips) - (SELECT count(*) FROM clean) AS rows_removed_total,
        {r('(1.0 - (SELECT count(*) FROM clean) / (SELECT count(*) FROM trips)::DOUBLE)')} AS pct_removed,
        (1.0 - (SELECT count(*) FROM clean) / (SELECT count(*) FROM trips)::DOUBLE) > 0.05 AS removal_warning"""
oracle("c8_clean_report", REPORT)
oracle("s8_report_json", f"SELECT to_json(x)::VARCHAR AS value FROM ({REPORT} ) x")
oracle("s9_saved_zones", "SELECT id, pickup_zone::BIGINT AS pickup_zone FROM zoned")
oracle("c1_duplicates", "SELECT count(*) - count(DISTINCT id) AS duplicate_ids FROM trips")
for key, rule in (
    ("c2_duration_mismatch", "duration_mismatch"), ("c3_duration_bounds", "duration_out_of_bounds"),
    ("c4_pickup_bounds", "pickup_out_of_bounds"), ("c5_dropoff_bounds", "dropoff_out_of_bounds"),
    ("c6_passengers", "invalid_passenger_count"), ("c7_missing", "missing_critical_values"),
):
    oracle(key, f"SELECT '{rule}' AS rule, count(*) AS n FROM trips WHERE {RULES[rule]}")
oracle("c8_clean_csv", f"SELECT {TRIP_COLUMNS} FROM clean")
oracle("c8_clean_rows", f"SELECT row_seq, {TRIP_COLUMNS} FROM clean")
SHARE_REMOVED = "(1.0 - (SELECT count(*) FROM clean) / (SELECT count(*) FROM trips)::DOUBLE)"
oracle(
    "c9_sanity",
    f"SELECT l::DOUBLE AS \"limit\", {r(SHARE_REMOVED)} AS pct_removed, {SHARE_REMOVED} > l AS removal_warning "
    "FROM (VALUES (0.05), (0.01)) v(l)",
)


def issue(name: str, condition: str) -> str:
    return (
        f"SELECT '{name}' AS issue, count(*) FILTER (WHERE {condition}) AS n, "
        f"{r(f'count(*) FILTER (WHERE {condition}) / count(*)::DOUBLE')} AS share FROM trips"
    )


oracle("e1_duration_outliers", issue("too_short", "trip_duration < 10") + " UNION ALL " + issue("too_long", "trip_duration > 86400"))
oracle("e2_geo_outliers", issue("pickup_outside", box("pickup")) + " UNION ALL " + issue("dropoff_outside", box("dropoff")))
oracle("e3_by_hour", "SELECT hour(pickup_datetime) AS hour, count(*) AS n FROM trips WHERE pickup_datetime IS NOT NULL GROUP BY 1")
oracle("e4_value_counts", "SELECT passenger_count::BIGINT AS passenger_count, count(*) AS n FROM trips WHERE passenger_count IS NOT NULL GROUP BY 1")
oracle("e4_zone_sizes", "SELECT z.zone_id::BIGINT AS pickup_zone, count(t.id) AS n FROM centroids z LEFT JOIN zoned t ON t.pickup_zone = z.zone_id GROUP BY 1")
oracle(
    "e5_missing_pct",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {r(f'avg(({c} IS NULL)::INT) * 100')} AS missing_pct FROM trips" for c in params.RAW_COLUMNS
    ),
)
NUMERIC = ("passenger_count", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "trip_duration")
oracle(
    "e6_correlation",
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {r(f'corr({a}, {b})')} AS corr FROM trips" for a in NUMERIC for b in NUMERIC
    ),
)


def bins(scale: str, value: str) -> str:
    return f"""
        SELECT b.bin::BIGINT AS bin, {r('e.lo + b.bin * ((e.hi - e.lo) / 100)')} AS lower, {r('e.lo + (b.bin + 1) * ((e.hi - e.lo) / 100)')} AS upper,
            coalesce(c.n, 0) AS n, '{scale}' AS scale
        FROM range(100) b(bin) CROSS JOIN (SELECT min({value}) AS lo, max({value}) AS hi FROM trips ) e
        LEFT JOIN (SELECT least(floor(({value} - lo) / (hi - lo) * 100), 99)::BIGINT AS bin, count(*) AS n
            FROM trips , (SELECT min({value}) AS lo, max({value}) AS hi FROM trips ) GROUP BY 1) c ON c.bin = b.bin"""


oracle("e7_histogram", bins("raw", "trip_duration::DOUBLE") + " UNION ALL " + bins("log1p", "ln(1 + trip_duration::DOUBLE)"))
oracle(
    "e8_sample",
    f"SELECT row_seq, id, trip_duration::BIGINT AS trip_duration FROM trips ORDER BY {unit('row_seq', params.SEED)}, row_seq LIMIT 500",
)
oracle(
    "e9_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std,
            {r(f'min({c})::DOUBLE')} AS min, {r(f'quantile_cont({c}, 0.25)')} AS p25, {r(f'quantile_cont({c}, 0.5)')} AS p50,
            {r(f'quantile_cont({c}, 0.75)')} AS p75, {r(f'max({c})::DOUBLE')} AS max FROM trips"""
        for c in NUMERIC
    ),
)
oracle(
    "e9_text_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", sum(n)::BIGINT AS "count", count(*) AS "unique",
            arg_min({c}, (-n, {c})) AS top, max(n) AS freq
            FROM (SELECT {c}, count(*) AS n FROM trips WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in ("id", "vendor_id", "store_and_fwd_flag")
    ),
)
ANY_MISSING = " OR ".join(f"{c} IS NULL" for c in params.RAW_COLUMNS)
oracle(
    "e10_quality_table",
    " UNION ALL ".join(
        [
            issue("duration_too_short", "trip_duration < 10"), issue("duration_too_long", "trip_duration > 86400"),
            issue("pickup_out_of_bounds", box("pickup")), issue("dropoff_out_of_bounds", box("dropoff")),
            issue("duration_mismatch", RULES["duration_mismatch"]), issue("missing_values", ANY_MISSING),
            f"SELECT 'duplicate_ids', count(*) - count(DISTINCT id), {r('(count(*) - count(DISTINCT id)) / count(*)::DOUBLE')} FROM trips",
        ]
    ),
)

INTS = ("pickup_hour", "pickup_weekday", "pickup_is_weekend", "pickup_is_rush_hour")
TEMPORAL = ", ".join([f"{c}::BIGINT AS {c}" for c in INTS] + [f"{r(c)} AS {c}" for c in params.TEMPORAL_COLUMNS[4:]])
SPATIAL = ", ".join([f"{r(c)} AS {c}" for c in params.SPATIAL_COLUMNS[:5]] + ["trip_direction"])
oracle("t6_temporal", f"SELECT id, {TEMPORAL} FROM featured")
oracle("t8_elapsed", f"SELECT row_seq, {r(chr(40) + 'epoch(dropoff_datetime) - epoch(pickup_datetime)' + chr(41))} AS seconds FROM trips")
oracle(
    "t9_hour_offset",
    """SELECT row_seq, date_trunc('hour', pickup_datetime) AS hour, date_trunc('hour', pickup_datetime) - INTERVAL 24 HOUR AS day_before,
        date_trunc('hour', pickup_datetime) + INTERVAL 1 HOUR AS next_hour FROM trips""",
)
oracle(
    "t10_hourly_range",
    """SELECT unnest(generate_series((SELECT min(date_trunc('hour', pickup_datetime)) FROM trips ),
        (SELECT max(date_trunc('hour', pickup_datetime)) FROM trips ), INTERVAL 1 HOUR)) AS hour""",
)
CALENDAR = ", ".join([f"{c}::BIGINT AS {c}" for c in params.CALENDAR_COLUMNS[:3]] + [f"{r(c)} AS {c}" for c in params.CALENDAR_COLUMNS[3:]])
oracle("t11_calendar", f"SELECT pickup_zone::BIGINT AS pickup_zone, hour, {CALENDAR} FROM calendar")
oracle("g6_spatial", f"SELECT id, {SPATIAL} FROM featured")
oracle(
    "g7_log_scale",
    f"""SELECT row_seq, {r('ln(1 + trip_duration)')} AS y_log, {r('greatest(exp(ln(1 + trip_duration)) - 1, 10.0)')} AS seconds,
        CASE WHEN dropoff_latitude IS NOT NULL THEN {r('least(greatest(dropoff_latitude, 40.4), 41.0)')} END AS latitude_in_city FROM trips""",
)
oracle("g9_longitude_factor", f"SELECT {r('cos(radians(avg(pickup_latitude)))')} AS factor FROM clean")
ANOMALY = ", ".join(
    ["trip_duration::BIGINT AS trip_duration"]
    + [f"{r(c)} AS {c}" for c in ("trip_distance_km", "average_speed_kmh", "route_efficiency_ratio")]
    + ["passenger_count::BIGINT AS passenger_count"]
)
oracle("g10_anomaly_features", f"SELECT id, {ANOMALY} FROM featured")
oracle("f1_features", f"SELECT id, {TEMPORAL}, {SPATIAL} FROM featured")
GATED = {
    **{c: "pickup_datetime" for c in params.TEMPORAL_COLUMNS},
    **{c: " + ".join(ENDS) for c in params.SPATIAL_COLUMNS[:5]},
}
oracle(
    "f2_gate_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) FILTER (WHERE ({source}) IS NULL) AS n_missing, 0::BIGINT AS n_infinite FROM trips"
        for c, source in GATED.items()
    ),
)
ORACLES["f1_usable_features"] = ORACLES["f1_features"]
oracle(
    "f2_planted_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count(*) FILTER (WHERE {missing}) AS n_missing, count(*) FILTER (WHERE {infinite}) AS n_infinite FROM featured"""
        for c, missing, infinite in (
            (c, "row_seq % 17 <> 0 AND row_seq % 19 = 0" if c == "bearing_sin" else "false",
             {"trip_distance_km": "row_seq % 13 = 0", "bearing_sin": "row_seq % 17 = 0"}.get(c, "false")) for c in GATED)
    ),
)
VENDOR_CODE = "CASE vendor_id WHEN '1' THEN 0 WHEN '2' THEN 1 ELSE -1 END::BIGINT AS vendor_id_code"
FLAG_CODE = "CASE store_and_fwd_flag WHEN 'N' THEN 0 WHEN 'Y' THEN 1 ELSE -1 END::BIGINT AS store_and_fwd_flag_code"
oracle(
    "f3_duration_matrix",
    f"""SELECT id, {TEMPORAL}, {', '.join(f'{r(c)} AS {c}' for c in params.SPATIAL_COLUMNS[:5])},
        passenger_count::BIGINT AS passenger_count, {VENDOR_CODE}, {FLAG_CODE},
        {r('ln(1 + trip_duration)')} AS label, trip_duration::DOUBLE AS y_raw FROM featured""",
)
oracle(
    "f4_codes",
    """SELECT t.row_seq, v.code AS vendor_id_code, f.code AS store_and_fwd_flag_code FROM trips t
        JOIN (SELECT vendor_id, dense_rank() OVER (ORDER BY vendor_id) - 1 AS code FROM (SELECT DISTINCT vendor_id FROM trips )) v USING (vendor_id)
        JOIN (SELECT store_and_fwd_flag, dense_rank() OVER (ORDER BY store_and_fwd_flag) - 1 AS code
            FROM (SELECT DISTINCT store_and_fwd_flag FROM trips )) f USING (store_and_fwd_flag)""",
)
oracle(
    "f5_codes",
    """SELECT request_id, CASE vendor_id WHEN 1 THEN 0 WHEN 2 THEN 1 END::BIGINT AS vendor_id_code,
        CASE store_and_fwd_flag WHEN 'N' THEN 0 WHEN 'Y' THEN 1 END::BIGINT AS store_and_fwd_flag_code FROM requests""",
)
DUMMIES = ", ".join(f"(pickup_zone = {i})::BIGINT AS zone_{i}" for i in range(params.N_ZONES))
oracle("f6_onehot", f"SELECT id, {DUMMIES} FROM zoned")
HISTORY = ", ".join(
    [f"demand_lag_{h}h" for h in params.LAG_HOURS]
    + [f"{r(f'demand_rolling_mean_{w}h')} AS demand_rolling_mean_{w}h" for w in params.ROLLING_WINDOWS]
)
oracle(
    "f7_demand_matrix",
    f"""SELECT pickup_zone::BIGINT AS pickup_zone, hour, {HISTORY}, {CALENDAR}, {DUMMIES},
        {r('ln(1 + pickup_count)')} AS label, pickup_count::DOUBLE AS y_raw FROM demand""",
)
oracle("f8_duration_scale", f"SELECT id, {r('greatest(60 + trip_distance_km * 120, 10.0)', 4)} AS seconds FROM featured")
oracle("f9_demand_scale", f"SELECT pickup_zone::BIGINT AS pickup_zone, hour, {r('demand_lag_24h::DOUBLE')} AS pickups FROM demand")

oracle("m2_assign_zone", "SELECT id, pickup_zone::BIGINT AS pickup_zone FROM zoned")
oracle("d1_zone_hour_counts", "SELECT pickup_zone::BIGINT AS pickup_zone, hour, n AS pickup_count FROM counts")
oracle("d2_hourly_grid", "SELECT pickup_zone::BIGINT AS pickup_zone, hour, pickup_count FROM grid")
GRID_KEYS = "pickup_zone::BIGINT AS pickup_zone, hour, pickup_count"
oracle("w1_lags", f"SELECT {GRID_KEYS}, " + ", ".join(f"demand_lag_{h}h" for h in params.LAG_HOURS) + " FROM windowed")
MEANS = ", ".join(
    f"CASE WHEN demand_rolling_mean_{w}h IS NOT NULL THEN {r(f'demand_rolling_mean_{w}h')} END AS demand_rolling_mean_{w}h"
    for w in params.ROLLING_WINDOWS
)
oracle("w2_rolling", f"SELECT {GRID_KEYS}, {MEANS} FROM windowed")
oracle("w4_demand_dataset", f"SELECT {GRID_KEYS}, {HISTORY}, {CALENDAR} FROM demand")

oracle("k5_split", f"SELECT id, CASE WHEN {unit('id', params.SEED)} < 0.2::DOUBLE THEN 'test' ELSE 'train' END AS part FROM clean")
CUT = """(SELECT hour FROM (SELECT hour, row_number() OVER (ORDER BY hour) - 1 AS place, count(*) OVER () AS n
    FROM (SELECT DISTINCT hour FROM demand )) WHERE place = floor(n * 0.8::DOUBLE))"""
oracle(
    "k6_chrono_split",
    f"""SELECT CASE WHEN hour < {CUT} THEN 'train' ELSE 'test' END AS part, count(*) AS n, min(hour) AS first, max(hour) AS last,
        sum(pickup_count)::BIGINT AS pickups, {CUT} AS cutoff FROM demand GROUP BY 1""",
)

oracle("v1_metrics", f"SELECT model, {r('mae')} AS mae, {r('rmse')} AS rmse, {r('log10(mape)')} AS mape, {r('r2')} AS r2, n FROM metrics")
oracle("v2_mape_nonzero", f"SELECT model, {r('avg(abs(y_true - y_pred) / abs(y_true))')} AS mape_nonzero_only FROM forecasts WHERE y_true <> 0 GROUP BY model")
oracle("v3_compare", METRIC_ROWS)
oracle(
    "v4_drift",
    f"""SELECT model, {r('rmse + shift')} AS saved_rmse, {r('rmse')} AS recomputed_rmse, {r('shift')} AS difference, shift > 0.1 AS drifted
        FROM (SELECT *, CASE model WHEN 'lag_24' THEN 0.5 ELSE 0.01 END::DOUBLE AS shift FROM metrics)""",
)
oracle(
    "v5_residuals",
    f"""SELECT pickup_zone::BIGINT AS pickup_zone, hour, model, y_true, {r('y_pred')} AS y_pred, {r('(y_true - y_pred)')} AS residual FROM forecasts""",
)
oracle(
    "v6_range",
    f"""SELECT model, {r('least(min(y_true), min(y_pred))')} AS axis_min, {r('greatest(max(y_true), max(y_pred))')} AS axis_max
        FROM forecasts GROUP BY model""",
)
oracle(
    "v7_rank",
    " UNION ALL ".join(
        f"SELECT row_number() OVER (ORDER BY {m} {'DESC' if m == 'r2' else 'ASC'}) AS position, model, {r(m)} AS value, '{m}' AS metric FROM metrics"
        for m in ("mae", "rmse", "r2")
    ),
)
oracle("k4_best", f"SELECT model, {r('rmse')} AS rmse FROM metrics ORDER BY metrics.rmse LIMIT 1")
oracle("j5_model_row", f"SELECT model, {r('mae')} AS mae FROM metrics WHERE model = 'mean_24'")
oracle("d4_zero_share", f"SELECT {r('avg((pickup_count = 0)::INT)')} AS zero_share FROM demand")
oracle("d5_hours", "SELECT DISTINCT hour FROM demand")
oracle(
    "m14_upsert",
    f"""SELECT model, {r('mae')} AS mae, {r('rmse')} AS rmse FROM metrics WHERE model <> 'lag_24'
        UNION ALL SELECT * FROM (VALUES ('lag_24', 0.25::DOUBLE, 9.0::DOUBLE), ('added', 0.25, 9.0))""",
)
TEST_TRIPS = f"(SELECT *, greatest(60 + trip_distance_km * 120, 10.0) AS guess FROM featured WHERE {unit('id', params.SEED)} < 0.2::DOUBLE)"
RMSE = "sqrt(avg((trip_duration - guess) ** 2))"
oracle(
    "v8_duration_evaluation",
    f"""SELECT 'by_distance' AS model, {r(RMSE + ' + 2.0')} AS saved_rmse, {r(RMSE)} AS recomputed_rmse, 2.0::DOUBLE AS difference,
        true AS drifted FROM {TEST_TRIPS}""",
)
oracle(
    "v9_demand_evaluation",
    f"""SELECT 'by_last_day' AS model, {r('avg(abs(pickup_count - demand_lag_24h))')} AS mae, {r('sqrt(avg((pickup_count - demand_lag_24h) ** 2))')} AS rmse,
        {r('1 - sum((pickup_count - demand_lag_24h) ** 2) / (var_pop(pickup_count) * count(*))')} AS r2, count(*) AS n,
        {r('avg(abs(pickup_count - demand_lag_24h) / pickup_count::DOUBLE) FILTER (WHERE pickup_count <> 0)')} AS mape_nonzero_only
        FROM demand WHERE hour >= {CUT}""",
)
ALL_TRIPS = "(SELECT *, greatest(60 + trip_distance_km * 120, 10.0) AS guess FROM featured )"
DURATION_METRICS = f"""(SELECT avg(abs(trip_duration - guess)) AS mae, {RMSE} AS rmse,
    1 - sum((trip_duration - guess) ** 2) / (var_pop(trip_duration) * count(*)) AS r2 FROM {ALL_TRIPS})"""
DEMAND_METRICS = """(SELECT m.model, m.mae, m.rmse, z.v AS mape FROM metrics m JOIN (SELECT model, avg(abs(y_true - y_pred) / abs(y_true)) AS v
    FROM forecasts WHERE y_true <> 0 GROUP BY model) z USING (model) ORDER BY m.rmse LIMIT 1)"""
oracle(
    "v10_summary",
    " UNION ALL ".join(
        [
            f"SELECT 'trip_duration' AS component, 'by_distance' AS model, '{m}' AS metric, {r(m)} AS value, printf('{t}', {m}) AS line FROM {DURATION_METRICS}"
            for m, t in (("mae", "MAE: %.1f seconds"), ("rmse", "RMSE: %.1f seconds"), ("r2", "R2: %.3f"))
        ]
        + [
            f"SELECT 'zonal_demand', model, '{name}', {r(m)}, printf('{t}', {m}) FROM {DEMAND_METRICS}"
            for name, m, t in (
                ("mae", "mae", "MAE: %.2f pickups/hour"), ("rmse", "rmse", "RMSE: %.2f pickups/hour"),
                ("mape_nonzero_only", "mape", "MAPE (non-zero-demand hours only): %.3f"),
            )
        ]
        + ["SELECT 'anomaly_detection', 'isolation_forest', 'contamination', 0.02, 'Contamination assumption: 2.0% of trips flagged for review'"]
    ),
)
IN_TEST = f"({unit('id', params.SEED)} < 0.2::DOUBLE)"
oracle(
    "m4_ols_single",
    f"""SELECT 'linear_regression' AS model, {r('avg(abs(y - guess))', 4)} AS mae, {r('sqrt(avg((y - guess) ** 2))', 4)} AS rmse,
        {r('avg(abs(y - guess) / y)', 4)} AS mape, {r('1 - sum((y - guess) ** 2) / (var_pop(y) * count(*))', 4)} AS r2, count(*) AS n
        FROM (SELECT trip_duration::DOUBLE AS y, greatest(exp(f.a + f.b * trip_distance_km) - 1, 10.0) AS guess
            FROM featured , (SELECT regr_intercept(ln(1 + trip_duration), trip_distance_km) AS a, regr_slope(ln(1 + trip_duration), trip_distance_km) AS b
                FROM featured WHERE NOT {IN_TEST}) f WHERE {IN_TEST})""",
)
oracle(
    "m3_silhouette",
    f"""SELECT count(*) AS n, {r('avg(CASE WHEN a IS NULL THEN 0.0::DOUBLE ELSE (b - a) / greatest(a, b) END)')} AS silhouette
    FROM (SELECT id, max(d * k.n / (k.n - 1)) FILTER (WHERE k.zone = p.zone AND k.n > 1) AS a, min(d) FILTER (WHERE k.zone <> p.zone) AS b
        FROM (SELECT id, pickup_zone AS zone, pickup_latitude AS x, pickup_longitude * 0.757::DOUBLE AS y FROM zoned ) p,
            (SELECT pickup_zone AS zone, count(*) AS n, avg(pickup_latitude) AS mx, avg(pickup_longitude * 0.757::DOUBLE) AS my,
                var_pop(pickup_latitude) + var_pop(pickup_longitude * 0.757::DOUBLE) AS v FROM zoned GROUP BY 1) k,
            LATERAL (SELECT (x - mx) * (x - mx) + (y - my) * (y - my) + v AS d) GROUP BY id)""",
)
# Three features: the normal equations of centred columns by Cramer's rule.
oracle(
    "m4_ols_three",
    f"""SELECT 'linear_regression' AS model, {r('avg(abs(y - guess))', 4)} AS mae, {r('sqrt(avg((y - guess) ** 2))', 4)} AS rmse,
        {r('avg(abs(y - guess) / y)', 4)} AS mape, {r('1 - sum((y - guess) ** 2) / (var_pop(y) * count(*))', 4)} AS r2, count(*) AS n
        FROM (SELECT trip_duration::DOUBLE AS y, greatest(exp(my + wa * (trip_distance_km - ma) + wb * (pickup_hour_sin - mb) + wc * (passenger_count - mc)) - 1, 10.0) AS guess
            FROM featured , (SELECT ma, mb, mc, my,
                    (ay * (bb * cc - bc * bc) - ab * (yb * cc - bc * yc) + ac * (yb * bc - bb * yc)) / det AS wa,
                    (aa * (yb * cc - bc * yc) - ay * (ab * cc - bc * ac) + ac * (ab * yc - yb * ac)) / det AS wb,
                    (aa * (bb * yc - yb * bc) - ab * (ab * yc - yb * ac) + ay * (ab * bc - bb * ac)) / det AS wc
                FROM (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det
                    FROM (SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb, var_pop(c) AS cc,
                            covar_pop(a, b) AS ab, covar_pop(a, c) AS ac, covar_pop(b, c) AS bc, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb, covar_pop(c, y) AS yc
                        FROM (SELECT trip_distance_km AS a, pickup_hour_sin AS b, passenger_count::DOUBLE AS c, ln(1 + trip_duration) AS y
                            FROM featured WHERE NOT {IN_TEST})))) f WHERE {IN_TEST})""",
)
oracle(
    "m1_settled_zones",
    f"""SELECT 30::BIGINT AS zones, count(*) AS n, {r('cos(radians(avg(pickup_latitude)))')} AS factor, 0.0::DOUBLE AS centre_gap,
        0.0::DOUBLE AS inertia_gap, true AS better_than_fixed FROM clean""",
)
# The sixteen features in the order in which a tree counts them, from 0.
FEATURE_NAMES = (
    "pickup_hour", "pickup_weekday", "pickup_is_weekend", "pickup_is_rush_hour", "pickup_hour_sin", "pickup_hour_cos", "pickup_weekday_sin",
    "pickup_weekday_cos", "trip_distance_km", "manhattan_distance_km", "bearing_degrees", "bearing_sin", "bearing_cos", "passenger_count",
    "vendor_id_code", "store_and_fwd_flag_code",
)
# A draw: seed, tree, the root's path in two words, feature and number of the draw, mixed one after the other.
DRAW = """(list_reduce([0, 42, tree, 1, 0, feature, 0]::BIGINT[], lambda h, k: list_reduce(
    [(h + k + 2654435769) % 4294967296, 739982445, 695872825, 1], lambda a, c:
    (xor(a, a >> CASE WHEN c = 695872825 THEN 12 ELSE 15 END) * c) % 4294967296)) / 4294967296.0::DOUBLE)"""
oracle(
    "m6_first_splits",
    f"""SELECT tree::BIGINT AS tree, [{', '.join(repr(c) for c in FEATURE_NAMES)}][arg_max(feature, (g, -feature)) + 1] AS feature,
        {r('arg_max(cut, (g, -feature))')} AS threshold, {r('arg_max(b / l, (g, -feature))')} AS left_value,
        {r('arg_max((sy - b) / (n - l), (g, -feature))')} AS right_value
    FROM (SELECT tree, feature, cut, n, sy, l, b, round(b * b / l + (sy - b) * (sy - b) / (n - l) - sy * sy / n, 9) AS g
        FROM (SELECT tree, d.feature, cut, n, sy, count_if(x <= cut) AS l, sum(y) FILTER (WHERE x <= cut) AS b
            FROM (SELECT tree, feature, n, sy, lo + {DRAW} * (hi - lo) AS cut
                FROM (SELECT feature, min(x) AS lo, max(x) AS hi, count(*) AS n, sum(y) AS sy FROM long GROUP BY feature), range(5) t(tree)
                WHERE lo < hi) d
            JOIN long ON long.feature = d.feature GROUP BY ALL) WHERE l > 0 AND l < n) GROUP BY tree""",
)
# Ridge with two columns: the inverse of the 2x2 matrix is written out.
RIDGE = """
    base AS MATERIALIZED (SELECT ln(1 + demand_lag_24h::DOUBLE) AS a, ln(1 + demand_rolling_mean_24h) AS b, ln(1 + pickup_count::DOUBLE) AS y FROM demand),
    s AS (SELECT count(*)::DOUBLE AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, covar_pop(a, a) * count(*) AS aa, covar_pop(a, b) * count(*) AS ab,
        covar_pop(b, b) * count(*) AS bb, covar_pop(a, y) * count(*) AS ay, covar_pop(b, y) * count(*) AS by_ FROM base),
    k AS (SELECT alpha, s.*, (bb + alpha) / d AS iaa, -ab / d AS iab, (aa + alpha) / d AS ibb FROM
        (SELECT alpha, s.*, (aa + alpha) * (bb + alpha) - ab * ab AS d FROM s, (VALUES (0.01::DOUBLE), (0.1), (1.0), (10.0), (100.0)) v(alpha)) s),
    w AS MATERIALIZED (SELECT *, iaa * ay + iab * by_ AS wa, iab * ay + ibb * by_ AS wb FROM k),
    e AS MATERIALIZED (SELECT alpha, avg((((y - my) - (a - ma) * wa - (b - mb) * wb)
        / (1 - (1 / n + (a - ma) * (a - ma) * iaa + 2 * (a - ma) * (b - mb) * iab + (b - mb) * (b - mb) * ibb))) ** 2) AS loo
        FROM base, w GROUP BY alpha)"""
DEMAND_CTES = with_ctes("SELECT 1 FROM demand").removesuffix(" SELECT 1 FROM demand")
ORACLES["m11_ridge_loo"] = f"{DEMAND_CTES}, {RIDGE} SELECT alpha, {r('loo')} AS loo_mse FROM e"
ORACLES["m12_meta_weights"] = f"""{DEMAND_CTES}, {RIDGE}, best AS (SELECT alpha FROM e ORDER BY loo LIMIT 1)
    SELECT 'lag_24' AS base_model, {r('wa')} AS weight FROM w JOIN best USING (alpha)
    UNION ALL SELECT 'mean_24', {r('wb')} FROM w JOIN best USING (alpha)"""

oracle("a4_normalise", f"SELECT id, {r('anomaly_score_raw')} AS anomaly_score_raw, {r('anomaly_score')} AS anomaly_score, is_anomaly FROM scored")
THRESHOLD = "(SELECT quantile_cont(anomaly_score_raw, 0.98) FROM scores )"
oracle(
    "a5_flag",
    f"""SELECT count(*) FILTER (WHERE anomaly_score_raw > {THRESHOLD}) AS n_flagged, count(*) AS n,
        {r(f'avg((anomaly_score_raw > {THRESHOLD})::INT)')} AS share, {r('min(anomaly_score_raw)')} AS low, {r('max(anomaly_score_raw)')} AS high,
        {r(THRESHOLD)} AS threshold FROM scores""",
)
oracle(
    "a6_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {r(f'avg({c}) FILTER (WHERE NOT is_anomaly)')} AS mean_normal,
            {r(f'avg({c}) FILTER (WHERE is_anomaly)')} AS mean_flagged FROM scored"""
        for c in params.ANOMALY_FEATURES
    ),
)
oracle("k2_top20", f"SELECT id, {ANOMALY}, {r('anomaly_score')} AS anomaly_score, is_anomaly FROM (SELECT * FROM scored ORDER BY anomaly_score DESC, id LIMIT 20)")
oracle(
    "k3_preview",
    f"SELECT id, {ANOMALY}, {r('anomaly_score')} AS anomaly_score, is_anomaly, 0.02::DOUBLE AS contamination FROM (SELECT * FROM scored ORDER BY anomaly_score DESC, id LIMIT 5)",
)

# The fixed trees as conditions, and the usual path of 256 rows.
USUAL = "(2 * (ln(255) + 0.5772156649015329) - 2 * 255 / 256.0::DOUBLE)"


def forest_score(seconds: str, km: str, speed: str, ratio: str, riders: str) -> str:
    return f"""pow(2.0::DOUBLE, -((CASE WHEN {speed} <= 30 THEN 9.5 WHEN {km} <= 12 THEN 6.0 ELSE 3.5 END)::DOUBLE
        + (CASE WHEN {seconds} > 900 THEN 7.25 WHEN {ratio} <= 0.75 THEN 5.5 ELSE 8.0 END)::DOUBLE + (CASE WHEN {riders} <= 5 THEN 8.5 ELSE 4.0 END)::DOUBLE) / 3 / {USUAL})"""


def forest_normal(raw: str) -> str:
    return f"least(greatest(({raw} - 0.5) / (0.8 - 0.5 + 1e-6), 0.0), 1.0)"


oracle(
    "a3_path_scores",
    f"""SELECT id, {r('raw')} AS anomaly_score_raw, {r(forest_normal('raw'))} AS anomaly_score, raw > 0.65 AS is_anomaly
    FROM (SELECT id, {forest_score('trip_duration', 'trip_distance_km', 'average_speed_kmh', 'route_efficiency_ratio', 'passenger_count')} AS raw FROM featured )""",
)
oracle(
    "a2_planted",
    """SELECT count(*) AS n, count_if(row_seq % 150 = 0)::BIGINT AS n_planted, count_if(row_seq % 150 = 0)::BIGINT AS n_found, 0::BIGINT AS n_outside,
        true AS within_share FROM featured""",
)
oracle(
    "a7_detector",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) AS n, {r(f'avg({c})')} AS mean, 20::BIGINT AS n_top, 0::BIGINT AS flags_changed FROM featured"
        for c in params.ANOMALY_FEATURES
    ),
)

# --- requests ---
CITY_CHECKS = " ".join(
    f"WHEN NOT coalesce({c} BETWEEN {lo} AND {hi}, false) THEN {text(messages.OUTSIDE_CITY, repr(c), shown(c), repr(str(lo)), repr(str(hi)))}"
    for c, (lo, hi) in ((P_LAT, LAT), (D_LAT, LAT), (P_LON, LON), (D_LON, LON))
)
DURATION_REASON = f"""CASE WHEN NOT coalesce(passenger_count BETWEEN 1 AND 6, false) THEN {text(messages.BAD_PASSENGERS, "'6'", shown('passenger_count'))}
    WHEN NOT coalesce(vendor_id IN (1, 2), false) THEN {text(messages.BAD_VENDOR, shown('vendor_id'))}
    WHEN coalesce(store_and_fwd_flag, 'N') NOT IN ('N', 'Y') THEN {text(messages.BAD_STORE_FLAG, shown('store_and_fwd_flag'))}
    {CITY_CHECKS} END"""


def missing(fields) -> tuple[str, str]:
    """(list of the missing names as SQL, condition that there are any)."""
    cells = ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in fields)
    listed = f"concat_ws(''', ''', {cells})"
    return f"'[''' || {listed} || ''']'", "(" + " OR ".join(f"{f} IS NULL" for f in fields) + ")"


DURATION_NAMES, DURATION_ABSENT = missing(
    ("pickup_datetime", P_LAT, P_LON, D_LAT, D_LON, "passenger_count", "vendor_id")
)
ANOMALY_NAMES, ANOMALY_ABSENT = missing(("pickup_datetime", "dropoff_datetime", P_LAT, P_LON, D_LAT, D_LON))
POINT_NAMES, POINT_ABSENT = missing(ENDS)
FULL_DURATION_REASON = f"CASE WHEN {DURATION_ABSENT} THEN {text(messages.MISSING_FIELDS, DURATION_NAMES)} ELSE {DURATION_REASON} END"
SECONDS = "(date_diff('microsecond', pickup_datetime, dropoff_datetime) / 1e6)"
GLOBE_CHECKS = " ".join(
    f"WHEN NOT ({c} BETWEEN {lo} AND {hi}) THEN {text(t, repr(c), shown(c))}"
    for t, (lo, hi), names in (
        (messages.BAD_LATITUDE, params.GLOBE_LAT, (P_LAT, D_LAT)), (messages.BAD_LONGITUDE, params.GLOBE_LON, (P_LON, D_LON)),
    )
    for c in names
)
COMPLETED_REASON = f"""CASE WHEN {SECONDS} IS NULL THEN {text(messages.NO_TIMES)}
    WHEN {SECONDS} <= 0 THEN {text(messages.BAD_ELAPSED, SECONDS + '::DOUBLE::VARCHAR')}
    WHEN {POINT_ABSENT} THEN {text(messages.MISSING_COORDINATES, POINT_NAMES)}
    {GLOBE_CHECKS} WHEN passenger_count < 0 THEN {text(messages.NEGATIVE_PASSENGERS, shown('passenger_count'))} END"""
ZONE_REASON = f"""CASE WHEN resolved IS NULL THEN {text(messages.NO_ZONE)}
    WHEN NOT (resolved BETWEEN 0 AND 29) THEN {text(messages.BAD_ZONE, "'29'", shown('resolved'))} END"""

oracle("q1_validate", f"SELECT request_id, {DURATION_REASON} AS reason FROM requests")
GUESS = f"greatest(60 + {KM} * 120, 10.0)"


def status_of(reason: str) -> str:
    return f"CASE WHEN {reason} IS NULL THEN 'ok' ELSE 'unavailable' END"


DURATIONS = f"""SELECT request_id, CASE WHEN reason IS NULL THEN {r('guess', 4)} END AS predicted_duration_seconds,
    CASE WHEN reason IS NULL THEN {r('guess / 60', 4)} END AS predicted_duration_minutes, CASE WHEN reason IS NULL THEN 'by_distance' END AS model_name,
    {status_of('reason')} AS status, reason FROM (SELECT request_id, {GUESS} AS guess, {FULL_DURATION_REASON} AS reason FROM requests)"""
oracle("q2_durations", DURATIONS)
oracle("st2_stream_scores", DURATIONS)
oracle("q3_nan_requests", f"SELECT request_id, resolved::BIGINT AS pickup_zone, {ZONE_REASON} AS reason FROM unplaced")
oracle("q3_zone", f"SELECT request_id, resolved::BIGINT AS pickup_zone, {ZONE_REASON} AS reason FROM located")

CTES["back"] = """SELECT request_id, max(CASE WHEN o = 1 THEN c END) AS demand_lag_1h, max(CASE WHEN o = 2 THEN c END) AS demand_lag_2h,
    max(CASE WHEN o = 3 THEN c END) AS demand_lag_3h, max(CASE WHEN o = 24 THEN c END) AS demand_lag_24h,
    avg(CASE WHEN o <= 3 THEN c END) AS demand_rolling_mean_3h, avg(CASE WHEN o <= 6 THEN c END) AS demand_rolling_mean_6h,
    avg(c) AS demand_rolling_mean_24h
    FROM (SELECT l.request_id, o.o, d.pickup_count AS c FROM located l CROSS JOIN range(1, 25) o(o)
        LEFT JOIN demand d ON d.pickup_zone = l.resolved
            AND d.hour = date_trunc('hour', coalesce(l.target_datetime, l.pickup_datetime)) - o.o * INTERVAL 1 HOUR)
    GROUP BY request_id"""
CTES["served"] = """SELECT l.*, date_trunc('hour', coalesce(target_datetime, pickup_datetime)) AS hour, b.* EXCLUDE (request_id),
    (SELECT min(hour) FROM demand )::VARCHAR AS first_hour, (SELECT max(hour) FROM demand )::VARCHAR AS last_hour
    FROM located l JOIN back b USING (request_id)"""
LAG_CHECKS = " ".join(
    f"WHEN demand_lag_{h}h IS NULL THEN {text(messages.NO_LAG, repr(str(h)), shown('resolved'), shown('hour'), 'first_hour', 'last_hour', repr('24'))}"
    for h in params.LAG_HOURS
)
DEMAND_REASON = f"""CASE WHEN ({ZONE_REASON}) IS NOT NULL THEN ({ZONE_REASON}) WHEN hour IS NULL THEN {text(messages.NO_TARGET)} {LAG_CHECKS} END"""


def opt(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN {r(c)} END AS {c}"


oracle(
    "q4_request_features",
    f"""SELECT request_id, resolved::BIGINT AS pickup_zone, hour AS target_hour, {', '.join(f'demand_lag_{h}h' for h in params.LAG_HOURS)},
        {', '.join(opt(f'demand_rolling_mean_{w}h') for w in params.ROLLING_WINDOWS)},
        hour(hour) AS hour_of_day, isodow(hour) - 1 AS day_of_week, (isodow(hour) >= 6)::BIGINT AS is_weekend,
        {', '.join(opt(c) for c in params.CALENDAR_COLUMNS[3:])}
        FROM (SELECT *, {circle('hour(hour)', '(isodow(hour) - 1)', '', ('hour_of_day', 'day_of_week'))} FROM served)""",
)
oracle("q5_servable", f"SELECT request_id, {DEMAND_REASON} AS reason FROM served")
# Without a fallback only requests with their own target hour can be served.
CTES["targeted"] = f"""SELECT *, CASE WHEN ({ZONE_REASON}) IS NOT NULL THEN ({ZONE_REASON}) WHEN target_datetime IS NULL THEN 'no target'
    ELSE {DEMAND_REASON} END AS reason FROM served"""
oracle(
    "q6_demand",
    f"""SELECT request_id, CASE WHEN reason IS NULL THEN {r('demand_lag_24h::DOUBLE')} END AS predicted_pickup_count,
        CASE WHEN reason IS NULL THEN resolved END::BIGINT AS zone_id,
        CASE WHEN reason IS NULL THEN strftime(hour, '%Y-%m-%dT%H:%M:%S') END AS target_hour,
        CASE WHEN reason IS NULL THEN 'by_last_day' END AS model_name, {status_of('reason')} AS status FROM targeted""",
)
oracle("q7_validate_completed", f"SELECT request_id, {COMPLETED_REASON} AS reason FROM requests")
CTES["finished"] = f"""SELECT *, km / (seconds / 3600) AS speed, km / (grid + 1e-6) AS ratio FROM
    (SELECT *, {SECONDS} AS seconds, {KM} AS km, {GRID_KM} AS grid, {COMPLETED_REASON} AS reason FROM requests)"""
RAW = "speed / (speed + 40)"
NORMAL = f"least(greatest(({RAW} - 0.05) / (0.9 - 0.05 + 1e-6), 0.0), 1.0)"
oracle(
    "q8_completed_scores",
    f"""SELECT request_id, CASE WHEN reason IS NULL THEN {r(NORMAL)} END AS anomaly_score, CASE WHEN reason IS NULL THEN {RAW} > 0.6 END AS is_anomaly,
        CASE WHEN reason IS NULL THEN {r('seconds')} END AS trip_duration_seconds, CASE WHEN reason IS NULL THEN {r('km')} END AS trip_distance_km,
        CASE WHEN reason IS NULL THEN {r('speed')} END AS average_speed_kmh, CASE WHEN reason IS NULL THEN {r('ratio')} END AS route_efficiency_ratio,
        {status_of('reason')} AS status FROM finished""",
)
MODE = "CASE WHEN dropoff_datetime IS NOT NULL THEN 'post_trip' ELSE 'pre_trip' END"
oracle("q9_mode", f"SELECT request_id, {MODE} AS request_mode FROM requests")
CTES["composed"] = f"""SELECT s.*, {MODE} AS request_mode, f.km, f.seconds, f.speed, f.ratio, {RAW.replace('speed', 'f.speed')} AS raw,
    greatest(60 + f.km * 120, 10.0) AS guess,
    {FULL_DURATION_REASON.replace('request_id', 's.request_id')} AS duration_reason,
    CASE WHEN coalesce(target_datetime, pickup_datetime) IS NULL OR (zone_id IS NULL AND ({P_LAT} IS NULL OR {P_LON} IS NULL))
        THEN {text(messages.MISSING_DEMAND_FIELDS)} ELSE {DEMAND_REASON} END AS demand_reason,
    CASE WHEN dropoff_datetime IS NULL THEN {text(messages.NOT_COMPLETED)} WHEN {ANOMALY_ABSENT} THEN {text(messages.MISSING_FIELDS, ANOMALY_NAMES)}
        ELSE f.reason END AS anomaly_reason
    FROM served s JOIN (SELECT request_id, km, seconds, speed, ratio, reason FROM finished ) f USING (request_id)"""
oracle(
    "q10_status",
    "SELECT request_id, "
    + ", ".join(f"{status_of(f'{c}_reason')} AS {c}_status, {c}_reason" for c in ("duration", "demand", "anomaly"))
    + " FROM composed",
)
oracle(
    "q11_tier",
    f"""SELECT pickup_zone::BIGINT AS pickup_zone, hour, {r('demand_lag_24h * 8.0::DOUBLE')} AS pickups,
        CASE WHEN demand_lag_24h * 8 < 5 THEN 'quiet' WHEN demand_lag_24h * 8 >= 20 THEN 'busy' ELSE 'moderate' END AS tier FROM demand""",
)
OFF = "abs(trip_duration - (60 + trip_distance_km * 120)) / (60 + trip_distance_km * 120) * 100"
oracle("q12_deviation", f"SELECT id, {r(OFF)} AS deviation_pct, {OFF} >= 50 AS deviates FROM featured")


def fmt(template: str, *values: str) -> str:
    """A message whose numbers are formatted by printf."""
    return f"printf('{template.replace(chr(39), chr(39) * 2)}', {', '.join(values)})"


D = "(abs(seconds - guess) / guess * 100)"
TIER = "CASE WHEN demand_lag_24h < 5 THEN 'quiet' WHEN demand_lag_24h >= 20 THEN 'busy' ELSE 'moderate' END"
ZONE_TEXT, COUNT = "resolved::VARCHAR", "demand_lag_24h::DOUBLE"
BEFORE = f"""concat_ws(' ',
    CASE WHEN duration_reason IS NULL THEN {fmt(messages.INSIGHT_DURATION, 'guess / 60')} ELSE {fmt(messages.INSIGHT_NO_DURATION, 'duration_reason')} END,
    CASE WHEN demand_reason IS NULL THEN {fmt(messages.INSIGHT_DEMAND, ZONE_TEXT, COUNT, TIER)} ELSE {fmt(messages.INSIGHT_NO_DEMAND, 'demand_reason')} END)"""
AFTER = f"""concat_ws(' ',
    CASE WHEN anomaly_reason IS NULL THEN {fmt(messages.INSIGHT_SCORE, NORMAL, f"CASE WHEN raw > 0.6 THEN '{messages.SCORE_FLAGGED}' ELSE '{messages.SCORE_NORMAL}' END")}
        ELSE {fmt(messages.INSIGHT_NO_SCORE, 'anomaly_reason')} END,
    CASE WHEN anomaly_reason IS NOT NULL THEN NULL
        WHEN duration_reason IS NOT NULL THEN {fmt(messages.INSIGHT_UNCHECKED, 'duration_reason', f"CASE WHEN raw > 0.6 THEN '{messages.UNCHECKED_FLAGGED}' ELSE '{messages.UNCHECKED_NORMAL}' END")}
        WHEN {D} >= 50 AND raw > 0.6 THEN {fmt(messages.INSIGHT_DEVIATED_FLAGGED, 'seconds', D, 'guess')}
        WHEN {D} >= 50 THEN {fmt(messages.INSIGHT_DEVIATED, D)}
        WHEN raw > 0.6 THEN {fmt(messages.INSIGHT_FLAGGED, D)} ELSE {fmt(messages.INSIGHT_NORMAL, D)} END,
    CASE WHEN demand_reason IS NULL THEN {fmt(messages.INSIGHT_CONTEXT, ZONE_TEXT, COUNT)} END)"""
oracle("q13_insight", f"SELECT request_id, CASE WHEN request_mode = 'pre_trip' THEN {BEFORE} ELSE {AFTER} END AS operational_insight FROM composed")
oracle(
    "q14_unified",
    f"""SELECT request_id, request_mode, CASE WHEN duration_reason IS NULL THEN {r('guess', 4)} END AS duration_seconds,
        CASE WHEN demand_reason IS NULL THEN {r(COUNT, 4)} END AS pickups, CASE WHEN demand_reason IS NULL THEN resolved END::BIGINT AS zone,
        CASE WHEN anomaly_reason IS NULL THEN {r(NORMAL, 4)} END AS score, CASE WHEN anomaly_reason IS NULL THEN raw > 0.6 END AS flagged FROM composed""",
)
CONSTRAINTS = {
    **{c: f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in zip(ENDS, [params.GLOBE_LAT, params.GLOBE_LON] * 2)},
    "pickup_datetime": "pickup_datetime IS NOT NULL",
    "passenger_count": "passenger_count >= 1",
    "vendor_id": "vendor_id IS NOT NULL",
    "store_and_fwd_flag": "store_and_fwd_flag IS NULL OR store_and_fwd_flag IN ('N', 'Y')",
    "zone_id": "zone_id IS NULL OR zone_id >= 0",
}
oracle(
    "q15_constraints",
    "SELECT request_id, concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({ok}, false) THEN '{c}' END" for c, ok in CONSTRAINTS.items())
    + ") AS violations FROM requests",
)
for kind, checks in {
    "duration": {c: CONSTRAINTS[c] for c in (*ENDS, "pickup_datetime", "passenger_count", "vendor_id", "store_and_fwd_flag")},
    "anomaly": {
        **{c: CONSTRAINTS[c] for c in (*ENDS, "pickup_datetime")},
        "dropoff_datetime": "dropoff_datetime IS NOT NULL",
        "passenger_count": "passenger_count IS NULL OR passenger_count >= 0",
    },
    "demand": {
        "target_datetime": "target_datetime IS NOT NULL",
        "zone_id": CONSTRAINTS["zone_id"],
        "pickup_latitude": "pickup_latitude IS NULL OR pickup_latitude BETWEEN -90 AND 90",
        "pickup_longitude": "pickup_longitude IS NULL OR pickup_longitude BETWEEN -180 AND 180",
        "zone_or_coordinates": "zone_id IS NOT NULL OR (pickup_latitude IS NOT NULL AND pickup_longitude IS NOT NULL)",
    },
}.items():
    broken = ", ".join(f"CASE WHEN NOT coalesce({ok}, false) THEN '{c}' END" for c, ok in checks.items())
    oracle(f"q15_{kind}", f"SELECT request_id, concat_ws(',', {broken}) AS violations FROM requests")

# --- jobs over saved artifacts: straight lines through one feature ---
DURATION_LINE = f"""(SELECT regr_intercept(ln(1 + trip_duration), trip_distance_km) AS a, regr_slope(ln(1 + trip_duration), trip_distance_km) AS b
    FROM featured WHERE NOT {IN_TEST})"""
DEMAND_LINE = f"""(SELECT regr_intercept(ln(1 + pickup_count), demand_lag_24h) AS a, regr_slope(ln(1 + pickup_count), demand_lag_24h) AS b
    FROM demand WHERE hour < {CUT})"""
LINE_SECONDS = "greatest(exp(t.a + t.b * {}) - 1, 10.0)"
LINE_COUNT = "greatest(exp(d.a + d.b * demand_lag_24h) - 1, 0.0)"
COMPOSED_SCORE = forest_score("seconds", "km", "speed", "ratio", "coalesce(passenger_count, 0)")
oracle(
    "q14_from_artifacts",
    f"""SELECT request_id, request_mode, CASE WHEN duration_reason IS NULL THEN {r(LINE_SECONDS.format('km'), 4)} END AS duration_seconds,
        CASE WHEN demand_reason IS NULL THEN {r(LINE_COUNT, 4)} END AS pickups, CASE WHEN demand_reason IS NULL THEN resolved END::BIGINT AS zone,
        CASE WHEN anomaly_reason IS NULL THEN {r(forest_normal(COMPOSED_SCORE), 4)} END AS score,
        CASE WHEN anomaly_reason IS NULL THEN {COMPOSED_SCORE} > 0.65 END AS flagged FROM composed , {DURATION_LINE} t, {DEMAND_LINE} d""",
)
TESTED_TRIPS = f"(SELECT trip_duration::DOUBLE AS y, {LINE_SECONDS.format('trip_distance_km')} AS guess FROM featured , {DURATION_LINE} t WHERE {IN_TEST})"
TESTED_HOURS = f"(SELECT pickup_count::DOUBLE AS y, {LINE_COUNT} AS guess FROM demand , {DEMAND_LINE} d WHERE hour >= {CUT})"
for name, tested in (("v8_from_artifacts", TESTED_TRIPS), ("v9_from_artifacts", TESTED_HOURS)):
    error = r("sqrt(avg((y - guess) ** 2))", 4)
    oracle(name, f"""SELECT 'linear_regression' AS model, {error} AS saved_rmse, {error} AS recomputed_rmse, 0.0::DOUBLE AS difference, false AS drifted FROM {tested}""")
LINES = (
    ("trip_duration", TESTED_TRIPS, "mae", "avg(abs(y - guess))", "MAE: %.1f seconds"),
    ("trip_duration", TESTED_TRIPS, "rmse", "sqrt(avg((y - guess) ** 2))", "RMSE: %.1f seconds"),
    ("trip_duration", TESTED_TRIPS, "r2", "1 - sum((y - guess) ** 2) / (var_pop(y) * count(*))", "R2: %.3f"),
    ("zonal_demand", TESTED_HOURS, "mae", "avg(abs(y - guess))", "MAE: %.2f pickups/hour"),
    ("zonal_demand", TESTED_HOURS, "rmse", "sqrt(avg((y - guess) ** 2))", "RMSE: %.2f pickups/hour"),
    ("zonal_demand", TESTED_HOURS, "mape_nonzero_only", "avg(abs(y - guess) / y) FILTER (WHERE y <> 0)", "MAPE (non-zero-demand hours only): %.3f"),
)
oracle(
    "v10_from_artifacts",
    " UNION ALL ".join(
        f"SELECT '{part}' AS component, 'linear_regression' AS model, '{metric}' AS metric, {r(value, 4)} AS value, printf('{line}', {value}) AS line FROM {tested}"
        for part, tested, metric, value, line in LINES
    ) + """ UNION ALL SELECT 'anomaly_detection', 'isolation_forest', 'contamination', 0.02::DOUBLE,
        'Contamination assumption: 2.0% of trips flagged for review' FROM (SELECT 1)""",
)
oracle("st1_stream_counts", "SELECT pickup_zone::BIGINT AS pickup_zone, hour, n AS pickup_count FROM counts")
ORACLES["st1_kept_history"] = ORACLES["w4_demand_dataset"]
ORACLES["st2_completed_scores"] = ORACLES["q8_completed_scores"]
ORACLES["st2_unified"] = ORACLES["q14_unified"]
