"""Regressors of Spark ML on the logarithmic scale, and one way to fit, predict and compare any of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Estimator
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from meterlark import params
from meterlark.functions.numeric import from_log
from meterlark.operators.encoding import assemble, demand_feature_columns, zone_dummies
from meterlark.operators.metrics import regression_metrics
from meterlark.session import ensure_checkpoints

FEATURES = "features"


def linear(ridge: float = 0.0) -> Estimator:
    """Ordinary least squares from one pass of cross products."""
    return LinearRegression(featuresCol=FEATURES, labelCol="label", solver="normal", regParam=ridge)


def forest(trees: int = params.FOREST_TREES, depth: int = params.FOREST_DEPTH, seed: int = params.SEED, bins: int = 128) -> Estimator:
    """Random forest that considers every feature at every split."""
    return RandomForestRegressor(
        featuresCol=FEATURES, labelCol="label", numTrees=trees, maxDepth=depth, seed=seed,
        featureSubsetStrategy="all", maxBins=bins, maxMemoryInMB=512,
    )


def boosted(
    rounds: int = params.BOOST_ROUNDS, depth: int = params.BOOST_DEPTH, rate: float = params.BOOST_RATE,
    seed: int = params.SEED, bins: int = 128,
) -> Estimator:
    """Gradient-boosted trees on squared error over binned features."""
    return GBTRegressor(
        featuresCol=FEATURES, labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed,
        lossType="squared", maxBins=bins, maxMemoryInMB=512,
    )


@dataclass
class Regressor:
    """A fitted Spark ML model with the columns it was fitted on; callable as a predictor."""

    model: Any
    columns: tuple[str, ...]

    def __call__(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``; rows with unknown features get a value the caller must not use."""
        return self.model.transform(assemble(df, self.columns, FEATURES)).drop(FEATURES)

    @property
    def importances(self) -> list[tuple[str, float]] | None:
        weights = getattr(self.model, "featureImportances", None)
        return None if weights is None else [(c, float(w)) for c, w in zip(self.columns, weights.toArray())]


def fit(estimator: Any, train: DataFrame, columns: Sequence[str]) -> Any:
    """Fit on the columns ``features`` + ``label``.

    Takes a Spark ML estimator, or any object with ``fit_table(train, columns)`` such as the extra
    trees, and returns something callable as a predictor.
    """
    if hasattr(estimator, "fit_table"):
        return estimator.fit_table(train, columns)
    ensure_checkpoints(train.sparkSession)
    ready = assemble(train.select(*columns, "label"), columns, FEATURES).select(FEATURES, "label")
    return Regressor(estimator.fit(ready), tuple(columns))


def predictions(fitted: Any, test: DataFrame, name: str, floor: float, keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, model, y_true, y_pred) on the original scale."""
    scored = fitted(test)
    return scored.select(
        *keep, F.lit(name).alias("model"), F.col("y_raw").alias("y_true"), from_log(F.col("prediction"), floor).alias("y_pred")
    )


def train_and_evaluate(
    estimator: Any, name: str, train: DataFrame, test: DataFrame, columns: Sequence[str], floor: float,
    nonzero: bool = False,
) -> tuple[Any, DataFrame]:
    """Fit on the log target, score against the raw one: (fitted model, one metric row)."""
    fitted = fit(estimator, train, columns)
    scored = predictions(fitted, test, name, floor)
    return fitted, regression_metrics(scored, nonzero=nonzero)


def duration_model_set(trees=params.FOREST_TREES, depth=params.FOREST_DEPTH, rounds=params.BOOST_ROUNDS,
                       boost_depth=params.BOOST_DEPTH, seed=params.SEED) -> dict[str, Any]:
    """The candidates for trip duration by name."""
    from meterlark.models.extra_trees import ExtraTrees

    return {
        "linear_regression": linear(),
        "random_forest": forest(trees, depth, seed),
        "extra_trees": ExtraTrees(trees, depth, seed),
        "boosted_trees": boosted(rounds, boost_depth, params.BOOST_RATE, seed),
    }


def demand_model_set(trees=params.DEMAND_FOREST_TREES, depth=params.DEMAND_FOREST_DEPTH,
                     rounds=params.DEMAND_BOOST_ROUNDS, boost_depth=params.DEMAND_BOOST_DEPTH,
                     seed=params.SEED) -> dict[str, Any]:
    """The candidates for zone demand by name."""
    return {
        "linear_regression": linear(),
        "random_forest": forest(trees, depth, seed),
        "boosted_trees": boosted(rounds, boost_depth, params.BOOST_RATE, seed),
    }


def demand_columns(name: str, n_zones: int = params.N_ZONES, lags=params.LAG_HOURS, windows=params.ROLLING_WINDOWS) -> list[str]:
    """Features of a demand model. All zone dummies and an intercept are collinear, so the linear
    model leaves the first one out; its fitted values are the same."""
    dummies = zone_dummies(n_zones)
    return demand_feature_columns(lags, windows) + (dummies[1:] if name == "linear_regression" else dummies)


def importance_table(spark, fitted: Any) -> DataFrame:
    """(feature, importance), highest first; empty for models without importances."""
    rows = getattr(fitted, "importances", None) or []
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
