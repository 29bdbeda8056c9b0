"""Evaluation of saved models on regenerated test parts, and the summary over all three components."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, functions as F

from meterlark import params
from meterlark.models.regressors import predictions
from meterlark.operators import metrics
from meterlark.operators.anomaly import top_anomalies
from meterlark.operators.encoding import demand_matrix
from meterlark.operators.splits import chronological_split, random_split


def evaluate(test_predictions: DataFrame, saved: DataFrame, tolerance: float, nonzero: bool = False) -> dict[str, DataFrame]:
    """Recompute the winner's metrics on its test part and hold them against the saved table.

    Returns the tables behind the report: winner, recomputed metrics, drift, ranking by RMSE,
    residuals and the common axis range.
    """
    recomputed = metrics.regression_metrics(test_predictions, nonzero=nonzero)
    return {
        "winner": metrics.best_model(saved),
        "recomputed": recomputed,
        "drift": metrics.drift(saved, recomputed, tolerance),
        "ranking": metrics.rank_models(saved, "rmse"),
        "residuals": metrics.residuals(test_predictions),
        "axis": metrics.axis_range(test_predictions),
    }


def winner_name(saved: DataFrame) -> str:
    return metrics.best_model(saved).first()["model"]


def evaluate_duration(matrix: DataFrame, saved: DataFrame, models: dict[str, Any], sample: int = 50_000) -> dict[str, DataFrame]:
    """The winning duration model on the hash-chosen test rows."""
    name = winner_name(saved)
    _, test = random_split(matrix)
    scored = predictions(models[name], test, name, params.MIN_TRIP_SECONDS, keep=("id",))
    tables = evaluate(scored, saved, params.DURATION_DRIFT_SECONDS)
    tables["residuals"] = metrics.prediction_sample(tables["residuals"], sample)
    return tables


def evaluate_demand(
    dataset: DataFrame, saved: DataFrame, models: dict[str, Any], n_zones: int = params.N_ZONES, sample: int = 50_000
) -> dict[str, DataFrame]:
    """The winning demand model on the last share of the hours."""
    name = winner_name(saved)
    _, test, _ = chronological_split(dataset)
    scored = predictions(models[name], demand_matrix(test, n_zones), name, 0.0, keep=("pickup_zone", "hour"))
    tables = evaluate(scored, saved, params.DEMAND_DRIFT_PICKUPS, nonzero=True)
    keyed = tables["residuals"].withColumn("cell", F.concat_ws("@", "pickup_zone", "hour"))
    tables["residuals"] = metrics.prediction_sample(keyed, sample, key="cell").drop("cell")
    return tables


def summarise_anomalies(scored: DataFrame, contamination: float = params.CONTAMINATION, preview: int = 5) -> DataFrame:
    """The first of the top anomalies next to the contamination setting."""
    top = top_anomalies(scored).orderBy(F.desc("anomaly_score"), "id").limit(preview)
    return top.withColumn("contamination", F.lit(contamination))


def summary(duration_winner: DataFrame, demand_winner: DataFrame, contamination: float = params.CONTAMINATION) -> DataFrame:
    """(component, model, metric, value, line): the numbers each decision rests on, also as text."""

    def lines(component: str, row: DataFrame, parts: list[tuple[str, str]]) -> DataFrame:
        cells = [
            F.struct(
                F.lit(metric).alias("metric"),
                F.col(metric).alias("value"),
                F.format_string(text, F.col(metric)).alias("line"),
            )
            for metric, text in parts
        ]
        return row.select(F.lit(component).alias("component"), "model", F.explode(F.array(*cells)).alias("c")).select(
            "component", "model", "c.metric", "c.value", "c.line"
        )

    duration = lines(
        "trip_duration", duration_winner,
        [("mae", "MAE: %.1f seconds"), ("rmse", "RMSE: %.1f seconds"), ("r2", "R2: %.3f")],
    )
    demand = lines(
        "zonal_demand", demand_winner,
        [
            ("mae", "MAE: %.2f pickups/hour"), ("rmse", "RMSE: %.2f pickups/hour"),
            ("mape_nonzero_only", "MAPE (non-zero-demand hours only): %.3f"),
        ],
    )
    spark = duration_winner.sparkSession
    share = spark.range(1).select(
        F.lit("anomaly_detection").alias("component"),
        F.lit("isolation_forest").alias("model"),
        F.lit("contamination").alias("metric"),
        F.lit(contamination).alias("value"),
        F.format_string("Contamination assumption: %.1f%% of trips flagged for review", F.lit(contamination * 100)).alias("line"),
    )
    return duration.unionByName(demand).unionByName(share)

