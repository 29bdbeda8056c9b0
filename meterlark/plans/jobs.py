"""The batch jobs, stage by stage; each reads and writes tables under one work folder."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from meterlark import params
from meterlark.errors import DataValidationError
from meterlark.functions.spatial import with_anomaly_features
from meterlark.models import regressors
from meterlark.models.isolation import IsolationForest
from meterlark.models.stacking import base_models, fit_stacking
from meterlark.models.zone_fit import fit_zones
from meterlark.operators import cleaning, metrics
from meterlark.operators.anomaly import flag_share, flagged_summary, top_anomalies
from meterlark.operators.demand import demand_dataset
from meterlark.operators.encoding import demand_matrix, duration_matrix
from meterlark.operators.features import UNUSABLE, usable_features
from meterlark.operators.splits import chronological_split, random_split
from meterlark.operators.zones import ZoneModel, assign_zone, zone_sizes
from meterlark.plans import report as evaluation
from meterlark.plans.scoring import score_unified
from meterlark.session import stage
from meterlark.sources.models import load_model, save_model
from meterlark.sources.tables import read_metric_table, report_json, write_csv
from meterlark.sources.trips import read_stage, write_stage


def prepare(spark: SparkSession, raw: DataFrame, work: str, unique_places: bool = False) -> None:
    """Raw trips to ``train_cleaned`` and ``train_features``, with the cleaning report as JSON.

    ``unique_places``: no two rows of an id share a place, as the readers number them. The repeated ids are then written once, so that the
    join with them is planned by their true size and a small table of them spares the trips a shuffle.
    """
    firsts = stage(cleaning.first_places(raw), "first-places") if unique_places else None
    write_stage(cleaning.clean_trips(raw, firsts=firsts), f"{work}/train_cleaned")
    report_json(cleaning.cleaning_report(raw, firsts=firsts)).coalesce(1).write.mode("overwrite").text(f"{work}/cleaning_report")
    try:
        write_stage(usable_features(read_stage(spark, f"{work}/train_cleaned")), f"{work}/train_features")
    except PySparkException as error:
        if UNUSABLE not in str(error):
            raise
        raise DataValidationError(f"{work}/train_cleaned: {UNUSABLE}; gate_counts tells which") from error


def train_zones(spark: SparkSession, work: str, k: int = params.N_ZONES, **settings: Any) -> None:
    """Fit and save the zones, write ``train_zoned`` and the zone sizes."""
    features = read_stage(spark, f"{work}/train_features")
    zones = fit_zones(features, k, **settings)
    save_model(spark, zones, f"{work}/models/zones")
    write_stage(assign_zone(features, zones), f"{work}/train_zoned")
    write_csv(zone_sizes(read_stage(spark, f"{work}/train_zoned"), k), f"{work}/reports/zone_sizes")


def build_demand(spark: SparkSession, work: str, n_zones: int = params.N_ZONES) -> None:
    """Zoned trips to ``demand_hourly``, sorted by zone and hour."""
    dataset = demand_dataset(read_stage(spark, f"{work}/train_zoned"), n_zones)
    write_stage(dataset.orderBy("pickup_zone", "hour"), f"{work}/demand_hourly")


def train_durations(
    spark: SparkSession, work: str, models: dict[str, Any] | None = None, bases: dict[str, Any] | None = None
) -> None:
    """Fit, save and compare the duration models, the stacking ensemble added last."""
    matrix = stage(duration_matrix(read_stage(spark, f"{work}/train_features")), "duration-matrix")
    train, test = random_split(matrix)
    columns = params.DURATION_FEATURES
    rows = None
    for name, estimator in (models or regressors.duration_model_set()).items():
        fitted, row = regressors.train_and_evaluate(estimator, name, train, test, columns, params.MIN_TRIP_SECONDS)
        save_model(spark, fitted, f"{work}/models/duration/{name}")
        rows = row if rows is None else rows.unionByName(row)
    table = f"{work}/models/duration_comparison"
    write_csv(metrics.compare_models(rows), table)
    winner = metrics.best_model(read_metric_table(spark, table, "train_durations")).first()["model"]
    fitted = load_model(spark, f"{work}/models/duration/{winner}")
    write_csv(regressors.importance_table(spark, fitted), f"{work}/reports/duration_importance")

    stacked = fit_stacking(train, columns, bases or base_models())
    save_model(spark, stacked, f"{work}/models/duration/stacking_ensemble")
    write_csv(stacked.meta.weights(spark), f"{work}/reports/stacking_weights")
    scored = regressors.predictions(stacked, test, "stacking_ensemble", params.MIN_TRIP_SECONDS)
    row = metrics.compare_models(metrics.regression_metrics(scored))
    saved = stage(read_metric_table(spark, table, "train_durations"), "comparison")
    write_csv(metrics.upsert_model(saved, row), table)


def train_demand(spark: SparkSession, work: str, models: dict[str, Any] | None = None, n_zones: int = params.N_ZONES) -> None:
    """Fit, save and compare the demand models on the chronological split."""
    train, test, _ = chronological_split(read_stage(spark, f"{work}/demand_hourly"))
    train, test = stage(demand_matrix(train, n_zones), "demand-train"), stage(demand_matrix(test, n_zones), "demand-test")
    rows = None
    for name, estimator in (models or regressors.demand_model_set()).items():
        columns = regressors.demand_columns(name, n_zones)
        fitted, row = regressors.train_and_evaluate(estimator, name, train, test, columns, 0.0, nonzero=True)
        save_model(spark, fitted, f"{work}/models/demand/{name}")
        rows = row if rows is None else rows.unionByName(row)
    table = rows.select("model", *params.METRICS, "mape_nonzero_only").orderBy("rmse", "model")
    write_csv(table, f"{work}/models/demand_comparison")


def train_anomalies(spark: SparkSession, work: str, **settings: Any) -> IsolationForest:
    """Fit and save the detector; write the flag share, the group means and the top 20."""
    features = with_anomaly_features(read_stage(spark, f"{work}/train_features"))
    detector = IsolationForest(**settings).fit(features)
    save_model(spark, detector, f"{work}/models/anomaly")
    scored = stage(detector.score(features).select("id", *params.ANOMALY_FEATURES, "anomaly_score", "is_anomaly"), "scored")
    write_csv(flag_share(scored), f"{work}/reports/flag_share")
    write_csv(flagged_summary(scored), f"{work}/reports/flagged_summary")
    write_csv(top_anomalies(scored), f"{work}/reports/top_20_flagged_trips")
    return detector


DURATION_TABLE, DEMAND_TABLE = "models/duration_comparison", "models/demand_comparison"


def load_scorer(spark: SparkSession, work: str, duration_model: str = "stacking_ensemble") -> Callable[[DataFrame], DataFrame]:
    """The unified scorer over everything the training jobs left under ``work``; batch and streaming alike.

    The demand model is the one with the lowest RMSE of the comparison; a missing table names the job that makes it.
    """
    zones = load_model(spark, f"{work}/models/zones", ZoneModel)
    demand_name = evaluation.winner_name(read_metric_table(spark, f"{work}/{DEMAND_TABLE}", "train_demand"))
    durations = load_model(spark, f"{work}/models/duration/{duration_model}")
    demand = load_model(spark, f"{work}/models/demand/{demand_name}")
    detector = load_model(spark, f"{work}/models/anomaly", IsolationForest)
    history = read_stage(spark, f"{work}/demand_hourly").select("pickup_zone", "hour", "pickup_count")

    def score(requests: DataFrame) -> DataFrame:
        return score_unified(requests, zones, history, durations, demand, detector.score, duration_model, demand_name)

    return score


def score_requests(spark: SparkSession, work: str, requests: DataFrame, name: str = "scored_requests") -> DataFrame:
    """Score a table of requests with the saved models and write the result as ``name``."""
    write_stage(load_scorer(spark, work)(requests), f"{work}/{name}")
    return read_stage(spark, f"{work}/{name}")


def report(spark: SparkSession, work: str, n_zones: int = params.N_ZONES, sample: int = 50_000) -> None:
    """Re-evaluate both winners on their test parts and write the tables of the report under ``reports``.

    ``pipeline_metrics`` (the summary lines), and for duration and demand ``drift``, ``ranking`` and ``residual_sample``.
    """
    saved = {
        "duration": stage(read_metric_table(spark, f"{work}/{DURATION_TABLE}", "train_durations"), "duration-table"),
        "demand": stage(read_metric_table(spark, f"{work}/{DEMAND_TABLE}", "train_demand"), "demand-table"),
    }
    models = {kind: {(n := evaluation.winner_name(table)): load_model(spark, f"{work}/models/{kind}/{n}")} for kind, table in saved.items()}
    matrix = duration_matrix(read_stage(spark, f"{work}/train_features"))
    history = read_stage(spark, f"{work}/demand_hourly")
    tables = {
        "duration": evaluation.evaluate_duration(matrix, saved["duration"], models["duration"], sample),
        "demand": evaluation.evaluate_demand(history, saved["demand"], models["demand"], n_zones, sample),
    }
    for kind, made in tables.items():
        write_csv(made["drift"], f"{work}/reports/{kind}_drift")
        write_csv(made["ranking"], f"{work}/reports/{kind}_ranking")
        write_stage(made["residuals"], f"{work}/reports/{kind}_residual_sample")
    write_csv(evaluation.summary(saved["duration"].orderBy("rmse", "model").limit(1), saved["demand"].orderBy("rmse", "model").limit(1)), f"{work}/reports/pipeline_metrics")
