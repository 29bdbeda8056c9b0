"""Queries: (spark, folder of tables) -> DataFrame. Doubles are rounded to six places for comparison."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterlark import params
from meterlark.functions import numeric, spatial, temporal
from meterlark.models import regressors, zone_fit
from meterlark.models.extra_trees import ExtraTrees
from meterlark.models.isolation import IsolationForest
from meterlark.models.nodes import Trees
from meterlark.models.ridge import fit_ridge
from meterlark.models.stacking import base_models, fit_stacking
from meterlark.operators import anomaly, cleaning, demand, encoding, features, metrics, profiling, splits, zones
from meterlark.operators import requests as rules
from meterlark.operators.zones import ZoneModel
from meterlark.plans import jobs, report, scoring
from meterlark.session import shared_folder, stage
from meterlark.sources import tables, trips as trip_files
from meterlark.sources.event_trips import fixed_zones, load_trips, requests_from_trips
from meterlark.sources.models import load_model, save_model
from meterlark.streaming.history import keep_history, kept_history, read_scores, score_with_history
from meterlark.streaming.requests import hourly_counts, score_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to six places, counts to one integer type: what both engines can agree on."""
    fields = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, places)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        fields.append(c.alias(f.name))
    return df.select(*fields)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/catalog/{name}-{uuid.uuid4().hex}"


# --- inputs -------------------------------------------------------------------------------------

def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_trips(spark, sf_dir)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips that survive cleaning; each event has a number of its own, so places are unique."""
    trips = raw(spark, sf_dir)
    return cleaning.clean_trips(trips, firsts=cleaning.first_places(trips))


def clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = raw(spark, sf_dir)
    return cleaning.cleaning_report(trips, firsts=cleaning.first_places(trips))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_features(clean(spark, sf_dir))


def zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.assign_zone(clean(spark, sf_dir), fixed_zones())


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.demand_dataset(zoned(spark, sf_dir))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from_trips(raw(spark, sf_dir))


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two naive forecasts of the hourly counts in long form."""
    cells = [
        F.struct(F.lit(name).alias("model"), F.col(c).cast("double").alias("y_pred"))
        for name, c in (("lag_24", "demand_lag_24h"), ("mean_24", "demand_rolling_mean_24h"))
    ]
    grid = hourly(spark, sf_dir).withColumn("m", F.explode(F.array(*cells)))
    return grid.select("pickup_zone", "hour", "m.model", F.col("pickup_count").cast("double").alias("y_true"), "m.y_pred")


def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric table, written once as the training jobs do: some queries look at it several times."""
    return stage(metrics.compare_models(metrics.regression_metrics(forecasts(spark, sf_dir))), "comparison")


def by_distance(df: DataFrame) -> DataFrame:
    """A stand-in duration model: a minute plus two minutes per kilometre."""
    return df.withColumn("prediction", numeric.to_log(60 + F.col("trip_distance_km") * 120))


def by_last_day(df: DataFrame) -> DataFrame:
    """A stand-in demand model: the same hour of the day before."""
    return df.withColumn("prediction", numeric.to_log(F.col("demand_lag_24h").cast("double")))


FIXED_SCALE = anomaly.ScoreScale(0.05, 0.9, 0.6)


def by_speed(df: DataFrame) -> DataFrame:
    """A stand-in detector: faster is odder."""
    speed = F.col("average_speed_kmh")
    return FIXED_SCALE.apply(df.withColumn(anomaly.RAW, speed / (speed + 40)))


def speed_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_speed(spatial.with_anomaly_features(featured(spark, sf_dir)))


# --- sources and sinks --------------------------------------------------------------------------

@query
def s1_trip_csv(spark, sf_dir):
    path = scratch(spark, "trips-csv")
    raw(spark, sf_dir).select(*params.RAW_COLUMNS).write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return rounded(trip_files.read_trips_csv(spark, path).drop("row_seq"))


@query
def s2_required_columns(spark, sf_dir):
    trips = trip_files.require_columns(raw(spark, sf_dir))
    return trips.agg(*[F.count(c).alias(c) for c in params.RAW_COLUMNS])


@query
def s3_parse_timestamps(spark, sf_dir):
    text = raw(spark, sf_dir).select("row_seq", F.col("pickup_datetime").cast("string").alias("pickup_datetime"))
    return trip_files.parse_timestamps(text, ["pickup_datetime"])


@query
def s4_request_rows(spark, sf_dir):
    lines = requests(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    return rounded(tables.parse_requests(lines))


@query
def s5_stage_parquet(spark, sf_dir):
    path = scratch(spark, "cleaned")
    days = clean(spark, sf_dir).withColumn("day", F.to_date("pickup_datetime"))
    trip_files.write_stage(days, path, partition_by="day")
    return rounded(trip_files.read_stage(spark, path).drop("day"))


@query
def s6_metric_csv(spark, sf_dir):
    path = scratch(spark, "metrics")
    tables.write_csv(comparison(spark, sf_dir).select("model", "mae", "rmse", "r2"), path)
    return rounded(spark.read.schema("model string, mae double, rmse double, r2 double").option("header", True).csv(path))


@query
def s7_metric_table(spark, sf_dir):
    path = scratch(spark, "metrics")
    tables.write_csv(comparison(spark, sf_dir).select("model", "mae", "rmse", "r2"), path)
    return rounded(tables.read_metric_table(spark, path, "the training job"))


@query
def s8_report_json(spark, sf_dir):
    return tables.report_json(rounded(clean_report(spark, sf_dir)))


@query
def s9_saved_zones(spark, sf_dir):
    path = scratch(spark, "zones")
    save_model(spark, fixed_zones(), path)
    saved = load_model(spark, path, zones.ZoneModel)
    return rounded(zones.assign_zone(clean(spark, sf_dir), saved).select("id", "pickup_zone"))


# --- cleaning -----------------------------------------------------------------------------------

@query
def c1_duplicates(spark, sf_dir):
    return cleaning.duplicate_count(raw(spark, sf_dir))


def _rule(name: str) -> Query:
    def run(spark, sf_dir):
        rule = [r for r in cleaning.default_rules() if r[0] == name]
        return cleaning.flag_counts(raw(spark, sf_dir), rule)

    return run


QUERIES.update(
    {
        "c2_duration_mismatch": _rule("duration_mismatch"),
        "c3_duration_bounds": _rule("duration_out_of_bounds"),
        "c4_pickup_bounds": _rule("pickup_out_of_bounds"),
        "c5_dropoff_bounds": _rule("dropoff_out_of_bounds"),
        "c6_passengers": _rule("invalid_passenger_count"),
        "c7_missing": _rule("missing_critical_values"),
    }
)


@query
def c8_clean_report(spark, sf_dir):
    return rounded(clean_report(spark, sf_dir))


@query
def c8_clean_rows(spark, sf_dir):
    return rounded(clean(spark, sf_dir))


@query
def c8_clean_csv(spark, sf_dir):
    """The trips written as CSV files, read again and cleaned: what a user of files gets."""
    path = scratch(spark, "trips-csv")
    raw(spark, sf_dir).select(*params.RAW_COLUMNS).write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    trips = trip_files.read_trips_csv(spark, path)
    return rounded(cleaning.clean_trips(trips, firsts=cleaning.first_places(trips)).drop("row_seq"))


@query
def c9_sanity(spark, sf_dir):
    limits = F.explode(F.array(F.lit(0.05), F.lit(0.01))).alias("limit")
    found = clean_report(spark, sf_dir).select(limits, "pct_removed")
    return rounded(found.withColumn("removal_warning", cleaning.too_many_removed(F.col("pct_removed"), F.col("limit"))))


# --- profiles -----------------------------------------------------------------------------------

@query
def e1_duration_outliers(spark, sf_dir):
    return rounded(profiling.duration_outliers(raw(spark, sf_dir)))


@query
def e2_geo_outliers(spark, sf_dir):
    return rounded(profiling.geographic_outliers(raw(spark, sf_dir)))


@query
def e3_by_hour(spark, sf_dir):
    return rounded(profiling.trips_by_hour(raw(spark, sf_dir)))


@query
def e4_value_counts(spark, sf_dir):
    return rounded(profiling.value_counts(raw(spark, sf_dir), "passenger_count"))


@query
def e4_zone_sizes(spark, sf_dir):
    return rounded(zones.zone_sizes(zoned(spark, sf_dir)))


@query
def e5_missing_pct(spark, sf_dir):
    return rounded(profiling.missing_share(raw(spark, sf_dir), params.RAW_COLUMNS))


@query
def e6_correlation(spark, sf_dir):
    return rounded(profiling.correlation_matrix(raw(spark, sf_dir).drop("row_seq")))


@query
def e7_histogram(spark, sf_dir):
    return rounded(profiling.duration_histograms(raw(spark, sf_dir)))


@query
def e8_sample(spark, sf_dir):
    return rounded(splits.sample_rows(raw(spark, sf_dir).select("row_seq", "id", "trip_duration"), 500, key="row_seq"))


@query
def e9_summary(spark, sf_dir):
    return rounded(profiling.numeric_summary(raw(spark, sf_dir).drop("row_seq")))


@query
def e9_text_summary(spark, sf_dir):
    return profiling.text_summary(raw(spark, sf_dir), ["id", "vendor_id", "store_and_fwd_flag"])


@query
def e10_quality_table(spark, sf_dir):
    return rounded(profiling.quality_table(raw(spark, sf_dir)))


# --- time, space, projections -------------------------------------------------------------------

@query
def t6_temporal(spark, sf_dir):
    return rounded(temporal.with_temporal_features(clean(spark, sf_dir)).select("id", *params.TEMPORAL_COLUMNS))


@query
def t8_elapsed(spark, sf_dir):
    seconds = temporal.elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return rounded(raw(spark, sf_dir).select("row_seq", seconds.alias("seconds")))


@query
def t9_hour_offset(spark, sf_dir):
    hour = temporal.floor_hour(F.col("pickup_datetime"))
    return raw(spark, sf_dir).select(
        "row_seq", hour.alias("hour"),
        temporal.hours_before(hour, 24).alias("day_before"), temporal.hours_after(hour, 1).alias("next_hour"),
    )


@query
def t10_hourly_range(spark, sf_dir):
    hour = temporal.floor_hour(F.col("pickup_datetime"))
    span = raw(spark, sf_dir).agg(F.min(hour).alias("first"), F.max(hour).alias("last"))
    return span.select(F.explode(temporal.hourly_range(F.col("first"), F.col("last"))).alias("hour"))


@query
def t11_calendar(spark, sf_dir):
    grid = temporal.with_calendar(demand.hourly_demand(zoned(spark, sf_dir)))
    return rounded(grid.select("pickup_zone", "hour", *params.CALENDAR_COLUMNS))


@query
def g6_spatial(spark, sf_dir):
    return rounded(spatial.with_spatial_features(clean(spark, sf_dir)).select("id", *params.SPATIAL_COLUMNS))


@query
def g7_log_scale(spark, sf_dir):
    log = numeric.to_log(F.col("trip_duration"))
    return rounded(
        raw(spark, sf_dir).select(
            "row_seq", log.alias("y_log"), numeric.from_log(log, params.MIN_TRIP_SECONDS).alias("seconds"),
            numeric.clip(F.col("dropoff_latitude"), *params.CITY_LAT).alias("latitude_in_city"),
        )
    )


@query
def g9_longitude_factor(spark, sf_dir):
    return rounded(spark.range(1).select(F.lit(zones.longitude_factor(clean(spark, sf_dir))).alias("factor")))


@query
def g10_anomaly_features(spark, sf_dir):
    return rounded(spatial.with_anomaly_features(featured(spark, sf_dir)).select("id", *params.ANOMALY_FEATURES))


@query
def f1_features(spark, sf_dir):
    return rounded(featured(spark, sf_dir).select("id", *params.TEMPORAL_COLUMNS, *params.SPATIAL_COLUMNS))


@query
def f2_gate_counts(spark, sf_dir):
    return features.gate_counts(features.build_features(raw(spark, sf_dir)))


@query
def f2_planted_counts(spark, sf_dir):
    """The gate over features of which some are made infinite, some NaN."""
    planted = featured(spark, sf_dir).withColumns({
        "trip_distance_km": F.when(F.col("row_seq") % 13 == 0, F.lit(float("inf"))).otherwise(F.col("trip_distance_km")),
        "bearing_sin": F.when(F.col("row_seq") % 17 == 0, F.lit(float("-inf"))).when(F.col("row_seq") % 19 == 0, F.lit(float("nan")))
        .otherwise(F.col("bearing_sin")),
    })
    return features.gate_counts(planted)


@query
def f1_usable_features(spark, sf_dir):
    """The features behind the gate that the training job writes through."""
    built = features.usable_features(clean(spark, sf_dir))
    return rounded(built.select("id", *params.TEMPORAL_COLUMNS, *params.SPATIAL_COLUMNS))


@query
def f3_duration_matrix(spark, sf_dir):
    return rounded(encoding.duration_matrix(featured(spark, sf_dir)))


@query
def f4_codes(spark, sf_dir):
    trips = encoding.with_category_code(raw(spark, sf_dir), "vendor_id")
    return rounded(encoding.with_category_code(trips, "store_and_fwd_flag").select("row_seq", "vendor_id_code", "store_and_fwd_flag_code"))


@query
def f5_codes(spark, sf_dir):
    coded = encoding.with_request_codes(requests(spark, sf_dir))
    return rounded(coded.select("request_id", "vendor_id_code", "store_and_fwd_flag_code"))


@query
def f6_onehot(spark, sf_dir):
    return rounded(encoding.with_zone_dummies(zoned(spark, sf_dir)).select("id", *encoding.zone_dummies()))


@query
def f7_demand_matrix(spark, sf_dir):
    return rounded(encoding.demand_matrix(hourly(spark, sf_dir)))


@query
def f8_duration_scale(spark, sf_dir):
    scored = by_distance(featured(spark, sf_dir))
    return rounded(scored.select("id", numeric.from_log(F.col("prediction"), params.MIN_TRIP_SECONDS).alias("seconds")), 4)


@query
def f9_demand_scale(spark, sf_dir):
    scored = by_last_day(hourly(spark, sf_dir))
    return rounded(scored.select("pickup_zone", "hour", numeric.from_log(F.col("prediction"), 0.0).alias("pickups")))


# --- zones and demand ---------------------------------------------------------------------------

@query
def m2_assign_zone(spark, sf_dir):
    return rounded(zoned(spark, sf_dir).select("id", "pickup_zone"))


@query
def d1_zone_hour_counts(spark, sf_dir):
    return rounded(demand.zone_hour_counts(zoned(spark, sf_dir)))


@query
def d2_hourly_grid(spark, sf_dir):
    return rounded(demand.hourly_demand(zoned(spark, sf_dir)))


@query
def w1_lags(spark, sf_dir):
    return rounded(demand.with_lags(demand.hourly_demand(zoned(spark, sf_dir))))


@query
def w2_rolling(spark, sf_dir):
    return rounded(demand.with_rolling_means(demand.hourly_demand(zoned(spark, sf_dir))))


@query
def w4_demand_dataset(spark, sf_dir):
    return rounded(hourly(spark, sf_dir))


# --- splits -------------------------------------------------------------------------------------

@query
def k5_split(spark, sf_dir):
    train, test = splits.random_split(clean(spark, sf_dir))
    return train.select("id", F.lit("train").alias("part")).unionByName(test.select("id", F.lit("test").alias("part")))


@query
def k6_chrono_split(spark, sf_dir):
    train, test, cutoff = splits.chronological_split(stage(hourly(spark, sf_dir), "hourly"))
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("hour").alias("first"), F.max("hour").alias("last"), F.sum("pickup_count").alias("pickups")
    ).withColumn("cutoff", F.lit(cutoff).cast("timestamp_ntz"))


# --- metrics ------------------------------------------------------------------------------------

@query
def v1_metrics(spark, sf_dir):
    table = metrics.regression_metrics(forecasts(spark, sf_dir))
    # The plain percentage error divides by the machine epsilon at zero counts; its size is compared.
    return rounded(table.withColumn("mape", F.log10("mape")))


@query
def v2_mape_nonzero(spark, sf_dir):
    return rounded(metrics.mape_nonzero(forecasts(spark, sf_dir)))


@query
def v3_compare(spark, sf_dir):
    return rounded(comparison(spark, sf_dir).drop("mape"))


@query
def v4_drift(spark, sf_dir):
    recomputed = comparison(spark, sf_dir)
    saved = recomputed.withColumn("rmse", F.when(F.col("model") == "lag_24", F.col("rmse") + 0.5).otherwise(F.col("rmse") + 0.01))
    return rounded(metrics.drift(saved, recomputed, params.DEMAND_DRIFT_PICKUPS))


@query
def v5_residuals(spark, sf_dir):
    return rounded(metrics.residuals(forecasts(spark, sf_dir)))


@query
def v6_range(spark, sf_dir):
    return rounded(metrics.axis_range(forecasts(spark, sf_dir)))


@query
def v7_rank(spark, sf_dir):
    table = comparison(spark, sf_dir)
    ranked = [metrics.rank_models(table, m).withColumn("metric", F.lit(m)) for m in ("mae", "rmse", "r2")]
    return rounded(ranked[0].unionByName(ranked[1]).unionByName(ranked[2]))


@query
def k4_best(spark, sf_dir):
    return rounded(metrics.best_model(comparison(spark, sf_dir)).select("model", "rmse"))


@query
def j5_model_row(spark, sf_dir):
    return rounded(metrics.model_row(comparison(spark, sf_dir), "mean_24").select("model", "mae"))


@query
def d4_zero_share(spark, sf_dir):
    return rounded(metrics.zero_share(hourly(spark, sf_dir)))


@query
def d5_hours(spark, sf_dir):
    return hourly(spark, sf_dir).select("hour").distinct().orderBy("hour")


@query
def m14_upsert(spark, sf_dir):
    table = comparison(spark, sf_dir).select("model", "mae", "rmse")
    changed = metrics.model_row(table, "lag_24").withColumns({"mae": F.lit(0.25), "rmse": F.lit(9.0)})
    added = changed.withColumn("model", F.lit("added"))
    return rounded(metrics.upsert_model(table, changed.unionByName(added)))


@query
def v8_duration_evaluation(spark, sf_dir):
    matrix = encoding.duration_matrix(featured(spark, sf_dir))
    _, test = splits.random_split(matrix)
    scored = regressors.predictions(by_distance, test, "by_distance", params.MIN_TRIP_SECONDS, keep=("id",))
    saved = metrics.regression_metrics(scored).withColumn("rmse", F.col("rmse") + 2.0)
    return rounded(report.evaluate(scored, saved, params.DURATION_DRIFT_SECONDS)["drift"])


@query
def v9_demand_evaluation(spark, sf_dir):
    _, test, _ = splits.chronological_split(stage(hourly(spark, sf_dir), "hourly"))
    scored = regressors.predictions(by_last_day, encoding.demand_matrix(test), "by_last_day", 0.0)
    saved = metrics.regression_metrics(scored)
    recomputed = report.evaluate(scored, saved, params.DEMAND_DRIFT_PICKUPS, nonzero=True)["recomputed"]
    return rounded(recomputed.drop("mape"))


@query
def v10_summary(spark, sf_dir):
    matrix = encoding.duration_matrix(featured(spark, sf_dir))
    durations = regressors.predictions(by_distance, matrix, "by_distance", params.MIN_TRIP_SECONDS)
    demand_table = stage(metrics.regression_metrics(forecasts(spark, sf_dir), nonzero=True), "demand-metrics")
    return rounded(report.summary(metrics.regression_metrics(durations), metrics.best_model(demand_table)))


# --- models -------------------------------------------------------------------------------------

def _duration_parts(spark, sf_dir):
    matrix = stage(encoding.duration_matrix(featured(spark, sf_dir)), "matrix")
    return splits.random_split(matrix)


def _duration_model(estimator, name: str) -> Query:
    def run(spark, sf_dir):
        train, test = _duration_parts(spark, sf_dir)
        _, row = regressors.train_and_evaluate(estimator(), name, train, test, params.DURATION_FEATURES, params.MIN_TRIP_SECONDS)
        return rounded(row)

    return run


QUERIES.update(
    {
        "m4_linear": _duration_model(regressors.linear, "linear_regression"),
        "m5_forest": _duration_model(lambda: regressors.forest(10, 6), "random_forest"),
        "m6_extra_trees": _duration_model(lambda: ExtraTrees(8, 5), "extra_trees"),
        "m7_boosted": _duration_model(lambda: regressors.boosted(10, 4), "boosted_trees"),
    }
)


@query
def m6_first_splits(spark, sf_dir):
    """The root of five extra trees: the split with the largest gain among one random threshold per feature."""
    train, _ = _duration_parts(spark, sf_dir)
    trees = ExtraTrees(5, 1).fit_table(train, params.DURATION_FEATURES).trees
    rows = [
        (t, params.DURATION_FEATURES[trees.feature[t][0]], trees.threshold[t][0], trees.value[t][trees.left[t][0]], trees.value[t][trees.right[t][0]])
        for t in range(len(trees))
    ]
    return rounded(spark.createDataFrame(rows, "tree int, feature string, threshold double, left_value double, right_value double"))


@query
def m4_ols_single(spark, sf_dir):
    matrix = stage(encoding.duration_matrix(featured(spark, sf_dir)).select("id", "trip_distance_km", "label", "y_raw"), "one-feature")
    train, test = splits.random_split(matrix)
    _, row = regressors.train_and_evaluate(regressors.linear(), "linear_regression", train, test, ["trip_distance_km"], params.MIN_TRIP_SECONDS)
    return rounded(row, 4)


@query
def m4_ols_three(spark, sf_dir):
    columns = ["trip_distance_km", "pickup_hour_sin", "passenger_count"]
    matrix = stage(encoding.duration_matrix(featured(spark, sf_dir)).select("id", *columns, "label", "y_raw"), "three-features")
    train, test = splits.random_split(matrix)
    _, row = regressors.train_and_evaluate(regressors.linear(), "linear_regression", train, test, columns, params.MIN_TRIP_SECONDS)
    return rounded(row, 4)


@query
def m1_kmeans(spark, sf_dir):
    """Thirty zones, the best of two starts, settled."""
    return rounded(zone_fit.fit_zones(clean(spark, sf_dir), inits=2, iterations=20).to_table(spark))


@query
def m1_settled_zones(spark, sf_dir):
    """What must hold of fitted zones: every centre is the mean of its rows, the inertia is theirs and below that of the fixed zones."""
    points = stage(clean(spark, sf_dir).select("pickup_latitude", "pickup_longitude"), "points")
    fitted = zone_fit.fit_zones(points, inits=2, iterations=20)

    def inertia(model):
        """Squared straightened distances of all rows to the centres they are assigned to."""
        centres = F.broadcast(model.to_table(spark).select(F.col("zone_id").alias("pickup_zone"), "lat", "lon"))
        gaps = (F.col("pickup_latitude") - F.col("lat")) ** 2 + ((F.col("pickup_longitude") - F.col("lon")) * model.longitude_factor) ** 2
        return zones.assign_zone(points, model).join(centres, "pickup_zone", "left").agg(F.sum(gaps).alias("inertia"))

    means = zone_fit.members(points, fitted).withColumnRenamed("lat", "mean_lat").withColumnRenamed("lon", "mean_lon")
    centres = fitted.to_table(spark).select(F.col("zone_id").alias("pickup_zone"), "lat", "lon")
    gap = F.greatest(F.abs(F.col("lat") - F.col("mean_lat")), F.abs(F.col("lon") - F.col("mean_lon")))
    fixed = ZoneModel(fixed_zones().centroids, fitted.longitude_factor)
    held = means.join(centres, "pickup_zone", "left").agg(F.sum("n").alias("n"), F.max(gap).alias("centre_gap"))
    compared = held.crossJoin(inertia(fitted)).crossJoin(inertia(fixed).withColumnRenamed("inertia", "fixed"))
    return rounded(compared.select(
        F.lit(fitted.n_zones).alias("zones"), "n", F.lit(fitted.longitude_factor).alias("factor"), "centre_gap",
        F.abs(F.col("inertia") / F.lit(fitted.inertia) - 1).alias("inertia_gap"), (F.col("inertia") < F.col("fixed")).alias("better_than_fixed")))


@query
def m3_k_sweep(spark, sf_dir):
    return rounded(zone_fit.sweep_zones(clean(spark, sf_dir), [5, 10], inits=1, iterations=10))


@query
def m3_silhouette(spark, sf_dir):
    """The silhouette of all trips in the fixed zones."""
    plane = stage(zoned(spark, sf_dir).select(
        F.col("pickup_latitude").alias("north"), (F.col("pickup_longitude") * F.lit(fixed_zones().longitude_factor)).alias("east"), "pickup_zone"), "plane")
    return rounded(zone_fit.silhouette_of_all(plane))


@query
def m8_demand_models(spark, sf_dir):
    train, test, _ = splits.chronological_split(stage(hourly(spark, sf_dir), "hourly"))
    train, test = stage(encoding.demand_matrix(train), "train"), stage(encoding.demand_matrix(test), "test")
    rows = None
    for name, estimator in regressors.demand_model_set(6, 6, 8, 4).items():
        _, row = regressors.train_and_evaluate(estimator, name, train, test, regressors.demand_columns(name), 0.0, nonzero=True)
        rows = row if rows is None else rows.unionByName(row)
    return rounded(rows)


@query
def m10_stacking(spark, sf_dir):
    train, test = _duration_parts(spark, sf_dir)
    stacked = fit_stacking(train, params.DURATION_FEATURES, base_models(4, 4, 4, 3))
    scored = regressors.predictions(stacked, test, "stacking_ensemble", params.MIN_TRIP_SECONDS)
    return rounded(metrics.regression_metrics(scored))


def _two_bases(spark, sf_dir):
    grid = encoding.demand_matrix(hourly(spark, sf_dir))
    return stage(
        grid.select(
            numeric.to_log(F.col("demand_lag_24h")).alias("lag_24"),
            numeric.to_log(F.col("demand_rolling_mean_24h")).alias("mean_24"),
            "label",
        ),
        "bases",
    )


@query
def m11_ridge_loo(spark, sf_dir):
    return rounded(fit_ridge(_two_bases(spark, sf_dir), ["lag_24", "mean_24"]).loo_table(spark))


@query
def m12_meta_weights(spark, sf_dir):
    return rounded(fit_ridge(_two_bases(spark, sf_dir), ["lag_24", "mean_24"]).weights(spark))


@query
def m13_importance(spark, sf_dir):
    train, _ = _duration_parts(spark, sf_dir)
    fitted = regressors.fit(regressors.forest(6, 5), train, params.DURATION_FEATURES)
    return rounded(regressors.importance_table(spark, fitted))


# --- anomalies ----------------------------------------------------------------------------------

# Three small trees over trip_duration, trip_distance_km, average_speed_kmh, route_efficiency_ratio and passenger_count,
# numbered from 0 in this order, as a fit leaves them; the SQL states the same trees as conditions.
FIXED_TREES = Trees(
    feature=[[2, -1, 1, -1, -1], [0, 3, -1, -1, -1], [4, -1, -1]],
    threshold=[[30.0, 0.0, 12.0, 0.0, 0.0], [900.0, 0.75, 0.0, 0.0, 0.0], [5.0, 0.0, 0.0]],
    left=[[1, -1, 3, -1, -1], [1, 3, -1, -1, -1], [1, -1, -1]],
    right=[[2, -1, 4, -1, -1], [2, 4, -1, -1, -1], [2, -1, -1]],
    value=[[0.0, 9.5, 0.0, 6.0, 3.5], [0.0, 0.0, 7.25, 5.5, 8.0], [0.0, 8.5, 4.0]],
)


def fixed_detector() -> IsolationForest:
    return IsolationForest(n_trees=3, trees=FIXED_TREES, size=256, scale=anomaly.ScoreScale(0.5, 0.8, 0.65))


@query
def a3_path_scores(spark, sf_dir):
    """Every trip walked down fixed trees that were saved and read back: raw score, normalised score and flag."""
    folder = scratch(spark, "detector")
    save_model(spark, fixed_detector(), folder)
    detector = load_model(spark, folder, IsolationForest)
    trips = spatial.with_anomaly_features(featured(spark, sf_dir))
    return rounded(detector.score(trips).select("id", anomaly.RAW, "anomaly_score", "is_anomaly"))


@query
def a2_planted(spark, sf_dir):
    """A fitted forest among trips of which every 150th is made 30 times as fast and detours in the extreme: all of those are flagged."""
    odd = F.col("row_seq") % 150 == 0
    trips = stage(spatial.with_anomaly_features(featured(spark, sf_dir)).select(
        "id", odd.alias("planted"), *[F.when(odd, F.col(c) * times).otherwise(F.col(c)).alias(c) for c, times in (
            ("trip_duration", 20), ("trip_distance_km", 30), ("average_speed_kmh", 30.0), ("route_efficiency_ratio", 0.1), ("passenger_count", 1))]), "planted")
    scored = IsolationForest().fit(trips).score(trips)
    within = F.col("anomaly_score").between(0.0, 1.0)
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("planted").alias("n_planted"), F.count_if(F.col("planted") & F.col("is_anomaly")).alias("n_found"),
        F.count_if(~F.coalesce(within, F.lit(False))).alias("n_outside"), (F.count_if("is_anomaly") <= F.ceil(F.count(F.lit(1)) * params.CONTAMINATION)).alias("within_share"))


@query
def a7_detector(spark, sf_dir):
    """The detector job: its group means weigh up to those of the table, and the saved detector gives its flags and its top 20 again."""
    work = scratch(spark, "detector-job")
    trip_files.write_stage(featured(spark, sf_dir), f"{work}/train_features")
    jobs.train_anomalies(spark, work)
    trips = spatial.with_anomaly_features(trip_files.read_stage(spark, f"{work}/train_features"))
    again = stage(load_model(spark, f"{work}/models/anomaly", IsolationForest).score(trips).select("id", *params.ANOMALY_FEATURES, "anomaly_score", "is_anomaly"), "again")

    def saved(name):
        return spark.read.option("header", True).option("inferSchema", True).csv(f"{work}/reports/{name}")

    listed = saved("top_20_flagged_trips").select("id", F.col("anomaly_score").alias("listed"))
    kept = anomaly.top_anomalies(again).select("id", "anomaly_score").join(listed, "id").filter(F.abs(F.col("anomaly_score") - F.col("listed")) < 1e-9)
    counts = saved("flag_share").select("n", "n_flagged").crossJoin(kept.agg(F.count(F.lit(1)).alias("n_top"))).crossJoin(
        again.agg(F.count_if("is_anomaly").alias("flagged_again")))
    mean = (F.col("mean_normal") * (F.col("n") - F.col("n_flagged")) + F.col("mean_flagged") * F.col("n_flagged")) / F.col("n")
    # One row of counts beside five of means.
    return rounded(saved("flagged_summary").crossJoin(counts).select(
        "feature", F.col("n").cast("long").alias("n"), mean.alias("mean"), "n_top", (F.col("flagged_again") - F.col("n_flagged")).cast("long").alias("flags_changed")))

@query
def a2_forest_scores(spark, sf_dir):
    trips = stage(spatial.with_anomaly_features(featured(spark, sf_dir)), "anomaly-features")
    scored = IsolationForest().fit(trips).score(trips)
    return rounded(scored.select("id", "anomaly_score_raw", "anomaly_score", "is_anomaly"))


@query
def a4_normalise(spark, sf_dir):
    return rounded(speed_scored(spark, sf_dir).select("id", "anomaly_score_raw", "anomaly_score", "is_anomaly"))


@query
def a5_flag(spark, sf_dir):
    scores = stage(speed_scored(spark, sf_dir).select("id", anomaly.RAW), "raw-scores")
    scale = anomaly.fit_scale(scores)
    flagged = anomaly.flag_share(scale.apply(scores))
    return rounded(flagged.select("*", F.lit(scale.low).alias("low"), F.lit(scale.high).alias("high"), F.lit(scale.threshold).alias("threshold")))


@query
def a6_summary(spark, sf_dir):
    return rounded(anomaly.flagged_summary(speed_scored(spark, sf_dir)))


@query
def k2_top20(spark, sf_dir):
    return rounded(anomaly.top_anomalies(speed_scored(spark, sf_dir)))


@query
def k3_preview(spark, sf_dir):
    return rounded(report.summarise_anomalies(speed_scored(spark, sf_dir)))


# --- requests -----------------------------------------------------------------------------------

def _history(spark, sf_dir):
    """The hourly table, written once: what the scorers read it for is its span and its counts."""
    return stage(_lazy_history(spark, sf_dir), "history")


def _lazy_history(spark, sf_dir):
    return hourly(spark, sf_dir).select("pickup_zone", "hour", "pickup_count")


@query
def q1_validate(spark, sf_dir):
    return requests(spark, sf_dir).select("request_id", rules.duration_reason().alias("reason"))


@query
def q2_durations(spark, sf_dir):
    scored = scoring.score_durations(requests(spark, sf_dir), by_distance, "by_distance")
    return rounded(scored.select("request_id", "duration.*", "duration_status.status", "duration_status.reason"), 4)


@query
def q3_nan_requests(spark, sf_dir):
    """Requests as JSON, some of them with NaN for a latitude: unknown, not zone 0."""
    odd = F.when(F.col("request_id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("pickup_latitude"))
    lines = requests(spark, sf_dir).withColumn("pickup_latitude", odd).select(F.to_json(F.struct("*")).alias("value"))
    located = tables.parse_requests(lines).withColumn("pickup_zone", scoring.resolved_zone(fixed_zones()))
    return rounded(located.select("request_id", "pickup_zone", rules.zone_reason("pickup_zone").alias("reason")))


@query
def q3_zone(spark, sf_dir):
    located = requests(spark, sf_dir).withColumn("pickup_zone", scoring.resolved_zone(fixed_zones()))
    return rounded(located.select("request_id", "pickup_zone", rules.zone_reason("pickup_zone").alias("reason")))


def _request_features(spark, sf_dir):
    target = F.coalesce(F.col("target_datetime"), F.col("pickup_datetime"))
    return scoring.with_request_demand(requests(spark, sf_dir), fixed_zones(), _history(spark, sf_dir), target=target)


@query
def q4_request_features(spark, sf_dir):
    return rounded(_request_features(spark, sf_dir).select("request_id", "pickup_zone", "target_hour", *encoding.demand_feature_columns()))


@query
def q5_servable(spark, sf_dir):
    return _request_features(spark, sf_dir).select("request_id", F.col("demand_reason").alias("reason"))


@query
def q6_demand(spark, sf_dir):
    scored = scoring.score_demand(requests(spark, sf_dir), fixed_zones(), _history(spark, sf_dir), by_last_day, "by_last_day")
    return rounded(scored.select("request_id", "demand.*", "demand_status.status"))


@query
def q7_validate_completed(spark, sf_dir):
    return requests(spark, sf_dir).select("request_id", rules.completed_reason().alias("reason"))


@query
def q8_completed_scores(spark, sf_dir):
    scored = scoring.score_anomalies(requests(spark, sf_dir), by_speed)
    return rounded(scored.select("request_id", "anomaly.*", "anomaly_status.status"))


@query
def q9_mode(spark, sf_dir):
    return requests(spark, sf_dir).select("request_id", rules.mode().alias("request_mode"))


def _unified(spark, sf_dir, history=_history):
    return scoring.score_unified(
        requests(spark, sf_dir), fixed_zones(), history(spark, sf_dir), by_distance, by_last_day, by_speed,
        "by_distance", "by_last_day",
    )


@query
def q10_status(spark, sf_dir):
    parts = [
        F.col("component_status")[c][f].alias(f"{c}_{f}")
        for c in ("duration", "demand", "anomaly") for f in ("status", "reason")
    ]
    return _unified(spark, sf_dir).select("request_id", *parts)


@query
def q11_tier(spark, sf_dir):
    # Counts are small here; scaled so that all three tiers occur.
    count = F.col("demand_lag_24h") * 8.0
    return rounded(hourly(spark, sf_dir).select("pickup_zone", "hour", count.alias("pickups"), rules.demand_tier(count).alias("tier")))


@query
def q12_deviation(spark, sf_dir):
    scored = by_distance(featured(spark, sf_dir))
    off = rules.deviation_pct(F.col("trip_duration"), F.expm1("prediction"))
    return rounded(scored.select("id", off.alias("deviation_pct"), (off >= params.DEVIATION_FLAG_PCT).alias("deviates")))


@query
def q13_insight(spark, sf_dir):
    return _unified(spark, sf_dir, _lazy_history).select("request_id", "operational_insight")


def _unified_columns(scored):
    return scored.select(
        "request_id", "request_mode",
        F.col("duration.predicted_duration_seconds").alias("duration_seconds"),
        F.col("demand.predicted_pickup_count").alias("pickups"),
        F.col("demand.zone_id").alias("zone"),
        F.col("anomaly.anomaly_score").alias("score"),
        F.col("anomaly.is_anomaly").alias("flagged"),
    )


@query
def q14_unified(spark, sf_dir):
    return rounded(_unified_columns(_unified(spark, sf_dir)), 4)


@query
def q15_constraints(spark, sf_dir):
    checked = rules.with_violations(requests(spark, sf_dir), "trip")
    return checked.select("request_id", F.array_join("violations", ",").alias("violations"))


for _kind in ("duration", "demand", "anomaly"):

    def _constraints(spark, sf_dir, kind=_kind):
        checked = rules.with_violations(requests(spark, sf_dir), kind)
        return checked.select("request_id", F.array_join("violations", ",").alias("violations"))

    QUERIES[f"q15_{_kind}"] = _constraints


# --- jobs over saved artifacts ------------------------------------------------------------------

def _artifacts(spark, sf_dir) -> str:
    """A work folder as the training jobs leave it; the models have one feature each, so that SQL can say what they give."""
    work = scratch(spark, "work")
    trip_files.write_stage(featured(spark, sf_dir), f"{work}/train_features")
    trip_files.write_stage(hourly(spark, sf_dir), f"{work}/demand_hourly")
    save_model(spark, fixed_zones(), f"{work}/models/zones")
    save_model(spark, fixed_detector(), f"{work}/models/anomaly")
    duration = splits.random_split(stage(encoding.duration_matrix(trip_files.read_stage(spark, f"{work}/train_features")), "matrix"))
    history = splits.chronological_split(trip_files.read_stage(spark, f"{work}/demand_hourly"))[:2]
    for kind, (train, test), column, floor in (
        ("duration", duration, "trip_distance_km", params.MIN_TRIP_SECONDS), ("demand", history, "demand_lag_24h", 0.0)):
        if kind == "demand":
            train, test = encoding.demand_matrix(train), encoding.demand_matrix(test)
        fitted, row = regressors.train_and_evaluate(regressors.linear(), "linear_regression", train, test, [column], floor, nonzero=kind == "demand")
        save_model(spark, fitted, f"{work}/models/{kind}/linear_regression")
        columns = params.METRICS + (("mape_nonzero_only",) if kind == "demand" else ())
        tables.write_csv(row.select("model", *columns), f"{work}/models/{kind}_comparison")
    return work


def _reported(spark, sf_dir, name: str) -> DataFrame:
    work = _artifacts(spark, sf_dir)
    jobs.report(spark, work)
    return spark.read.option("header", True).option("inferSchema", True).csv(f"{work}/reports/{name}")


@query
def q14_from_artifacts(spark, sf_dir):
    """All three parts of every request by the scoring job, from what is saved alone."""
    work = _artifacts(spark, sf_dir)
    scorer = jobs.load_scorer(spark, work, "linear_regression")
    trip_files.write_stage(scorer(requests(spark, sf_dir)), f"{work}/scored_requests")
    return rounded(_unified_columns(trip_files.read_stage(spark, f"{work}/scored_requests")), 4)


@query
def v8_from_artifacts(spark, sf_dir):
    """The report job's check of the saved duration model on its test part."""
    return rounded(_reported(spark, sf_dir, "duration_drift"), 4)


@query
def v9_from_artifacts(spark, sf_dir):
    """The report job's check of the saved demand model on the last hours."""
    return rounded(_reported(spark, sf_dir, "demand_drift"), 4)


@query
def v10_from_artifacts(spark, sf_dir):
    """The report job's summary of both winners and the detector."""
    return rounded(_reported(spark, sf_dir, "pipeline_metrics"), 4)


# --- streams ------------------------------------------------------------------------------------

def _trip_counts(spark, sf_dir):
    """The hours of a stream of the cleaned trips. One trip years later closes all hours; its own hour stays open."""
    source = scratch(spark, "trip-stream")
    trips = clean(spark, sf_dir)
    trips.write.parquet(f"{source}/trips")
    later = F.lit("2099-01-01 00:00:00").cast("timestamp_ntz")
    spark.read.parquet(f"{source}/trips").limit(1).withColumn("pickup_datetime", later).write.parquet(f"{source}/closing")
    stream = spark.readStream.schema(trips.schema).parquet(f"{source}/*")
    # A month of lateness, whatever the order in which the files are read.
    return hourly_counts(stream, fixed_zones(), lateness="40 days")


@query
def st1_stream_counts(spark, sf_dir):
    """The batch counts, from a stream of the cleaned trips; every hour that closed is emitted once."""
    out = scratch(spark, "hour-counts")
    score_stream(_trip_counts(spark, sf_dir), lambda counts: counts, out, scratch(spark, "counts-state")).awaitTermination()
    return rounded(spark.read.parquet(out))


def _kept(spark, sf_dir) -> str:
    """The folder of a history that a stream of the cleaned trips keeps."""
    folder = scratch(spark, "kept-history")
    keep_history(_trip_counts(spark, sf_dir), folder, scratch(spark, "kept-state")).awaitTermination()
    return folder


@query
def st1_kept_history(spark, sf_dir):
    """Lags and means over the history that a stream keeps: those of the batch job."""
    grid = stage(kept_history(spark, _kept(spark, sf_dir)), "kept")
    return rounded(demand.drop_short_history(temporal.with_calendar(demand.with_rolling_means(demand.with_lags(grid)))))


@query
def st2_stream_scores(spark, sf_dir):
    source, out = scratch(spark, "request-stream"), scratch(spark, "request-scores")
    rows = requests(spark, sf_dir)
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)

    def score(df):
        scored = scoring.score_durations(df, by_distance, "by_distance")
        return scored.select("request_id", "duration.*", "duration_status.status", "duration_status.reason")

    score_stream(stream, score, out, scratch(spark, "scores-state")).awaitTermination()
    return rounded(spark.read.parquet(out), 4)


def _request_stream(spark, sf_dir):
    """Requests as a stream of several micro-batches."""
    source = scratch(spark, "request-stream")
    rows = requests(spark, sf_dir)
    rows.repartition(3, "request_id").write.parquet(source)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)


@query
def st2_completed_scores(spark, sf_dir):
    """Completed trips scored as they arrive."""
    out = scratch(spark, "completed-scores")

    def score(df):
        return scoring.score_anomalies(df, by_speed).select("request_id", "anomaly.*", "anomaly_status.status")

    score_stream(_request_stream(spark, sf_dir), score, out, scratch(spark, "completed-state")).awaitTermination()
    return rounded(spark.read.parquet(out))


@query
def st2_unified(spark, sf_dir):
    """All three parts for a stream of requests, against the history that another stream keeps."""
    out, folder = scratch(spark, "unified-scores"), _kept(spark, sf_dir)

    def score(df, history):
        scored = scoring.score_unified(df, fixed_zones(), history, by_distance, by_last_day, by_speed, "by_distance", "by_last_day")
        return _unified_columns(scored)

    def history():
        # The batch job's table starts a day after the first hour, and messages name its span.
        return demand.drop_short_history(demand.with_lags(kept_history(spark, folder)))

    score_with_history(_request_stream(spark, sf_dir), score, history, out, scratch(spark, "unified-state")).awaitTermination()
    return rounded(read_scores(spark, out).drop("batch"), 4)
