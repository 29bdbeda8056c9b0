"""Regression metrics and model tables over predictions in long form (model, y_true, y_pred)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlark import params
from meterlark.operators.splits import sample_rows


def _nonzero_error() -> Column:
    y = F.col("y_true")
    return F.avg(F.when(y != 0, F.abs(F.try_divide(y - F.col("y_pred"), y)))).alias("mape_nonzero_only")


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ("model",), nonzero: bool = False) -> DataFrame:
    """One row per group: mae, rmse, mape, r2, n and, with ``nonzero``, mape_nonzero_only. One aggregate, combined before the shuffle.

    Percentage errors divide by at least the machine epsilon; a constant truth gives r2 1 when met
    exactly, else 0. Truth and prediction sit on one row, so their lengths cannot differ.
    """
    y, error = F.col("y_true"), F.col("y_true") - F.col("y_pred")
    squares, spread = F.sum(error * error), F.var_pop(y) * F.count(y)
    r2 = F.when(spread == 0, F.when(squares == 0, 1.0).otherwise(0.0)).otherwise(1 - F.try_divide(squares, spread))
    return predictions.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(params.MAPE_FLOOR))).alias("mape"),
        r2.alias("r2"),
        F.count(F.lit(1)).alias("n"),
        *([_nonzero_error()] if nonzero else []),
    )


def mape_nonzero(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Percentage error over rows whose truth is not zero; null when all are."""
    return predictions.groupBy(*by).agg(_nonzero_error())


def zero_share(df: DataFrame, column: str = "pickup_count") -> DataFrame:
    """Share of rows whose value is zero."""
    return df.agg(F.avg((F.col(column) == 0).cast("int")).alias("zero_share"))


def compare_models(metrics: DataFrame) -> DataFrame:
    """The metric columns in their fixed order, lowest RMSE first; other columns are dropped."""
    return metrics.select("model", *params.METRICS).orderBy("rmse", "model")


def best_model(table: DataFrame) -> DataFrame:
    """The row with the lowest RMSE."""
    return table.orderBy("rmse", "model").limit(1)


def model_row(table: DataFrame, name: str) -> DataFrame:
    return table.filter(F.col("model") == name)


def upsert_model(table: DataFrame, row: DataFrame) -> DataFrame:
    """Replace or add the models of ``row`` and re-sort by RMSE."""
    kept = table.join(F.broadcast(row.select("model")), "model", "left_anti")
    return kept.unionByName(row.select(table.columns)).orderBy("rmse", "model")


def drift(saved: DataFrame, recomputed: DataFrame, tolerance: float) -> DataFrame:
    """Models whose recomputed RMSE left the saved one by more than the tolerance are marked."""
    both = saved.select("model", F.col("rmse").alias("saved_rmse")).join(
        recomputed.select("model", F.col("rmse").alias("recomputed_rmse")), "model"
    )
    gap = F.abs(F.col("recomputed_rmse") - F.col("saved_rmse"))
    return both.withColumns({"difference": gap, "drifted": gap > tolerance})


def rank_models(table: DataFrame, metric: str) -> DataFrame:
    """(position, model, value), best first: r2 from the top, the others from the bottom."""
    if metric not in table.columns or metric == "model":
        raise ValueError(f"unknown metric {metric!r}")
    order = F.desc(metric) if metric == "r2" else F.asc(metric)
    return table.select(
        F.row_number().over(Window.orderBy(order, "model")).cast("bigint").alias("position"),
        "model",
        F.col(metric).alias("value"),
    )


def residuals(predictions: DataFrame) -> DataFrame:
    """Truth minus prediction, next to the prediction."""
    return predictions.withColumn("residual", F.col("y_true") - F.col("y_pred"))


def axis_range(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """The common range of truth and prediction."""
    return predictions.groupBy(*by).agg(
        F.least(F.min("y_true"), F.min("y_pred")).alias("axis_min"),
        F.greatest(F.max("y_true"), F.max("y_pred")).alias("axis_max"),
    )


def prediction_sample(predictions: DataFrame, n: int = 50_000, key: str = "id", seed: int = params.SEED) -> DataFrame:
    """Rows to draw: all of them up to n, else a seeded sample."""
    return sample_rows(predictions, n, key, seed)
