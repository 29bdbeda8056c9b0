"""Saving and loading fitted models together with the constants they need."""

from __future__ import annotations

import json
from typing import Any

import numpy as np
from pyspark.ml.regression import (
    GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel,
)
from pyspark.sql import SparkSession

from meterlark.models.extra_trees import ExtraTreesModel
from meterlark.models.isolation import IsolationForest
from meterlark.models.nodes import Trees
from meterlark.models.regressors import Regressor
from meterlark.models.ridge import Ridge
from meterlark.models.stacking import Stacking
from meterlark.operators.anomaly import ScoreScale
from meterlark.operators.zones import ZoneModel

ML_MODELS = {c.__name__: c for c in (LinearRegressionModel, RandomForestRegressionModel, GBTRegressionModel)}


def _write_meta(spark: SparkSession, path: str, kind: str, **values: Any) -> None:
    row = [(kind, json.dumps(values))]
    spark.createDataFrame(row, "kind string, settings string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def save_model(spark: SparkSession, model: Any, path: str) -> None:
    """Write a model to a folder: its tables (or Spark ML files) and one row of settings."""
    if isinstance(model, ZoneModel):
        _write_meta(spark, path, "zones")
        model.to_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    elif isinstance(model, IsolationForest):
        _write_meta(
            spark, path, "isolation", columns=model.columns, contamination=model.contamination, n_trees=model.n_trees,
            sample=model.sample, seed=model.seed, size=model.size, scale=vars(model.scale),
        )
        model.trees.to_table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
    elif isinstance(model, ExtraTreesModel):
        _write_meta(spark, path, "extra_trees", columns=model.columns, gains=[float(g) for g in model.gains])
        model.trees.to_table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
    elif isinstance(model, Regressor):
        _write_meta(spark, path, "regressor", columns=model.columns, ml=type(model.model).__name__)
        model.model.write().overwrite().save(f"{path}/ml")
    elif isinstance(model, Stacking):
        _write_meta(spark, path, "stacking", bases=list(model.bases), meta=vars(model.meta))
        for name, base in model.bases.items():
            save_model(spark, base, f"{path}/bases/{name}")
    else:
        raise TypeError(f"cannot save a {type(model).__name__}")


def load_model(spark: SparkSession, path: str, expected: type | None = None) -> Any:
    """Read a model back; ``expected`` guards against a folder that holds something else."""
    row = spark.read.parquet(f"{path}/meta").first()
    settings = json.loads(row["settings"])
    model = _LOADERS[row["kind"]](spark, path, settings)
    if expected is not None and not isinstance(model, expected):
        raise TypeError(f"{path} holds a {type(model).__name__}, not a {expected.__name__}")
    return model


def _zones(spark, path, settings) -> ZoneModel:
    table = spark.read.parquet(f"{path}/centroids")
    one = table.first()
    zones = ZoneModel.from_table(table, one["longitude_factor"])
    return ZoneModel(zones.centroids, zones.longitude_factor, one["inertia"])


def _isolation(spark, path, settings) -> IsolationForest:
    scale = ScoreScale(**settings.pop("scale"))
    columns = tuple(settings.pop("columns"))
    return IsolationForest(columns=columns, scale=scale, trees=_trees(spark, path), **settings)


def _trees(spark, path) -> Trees:
    return Trees.from_table(spark.read.parquet(f"{path}/nodes"))


def _extra_trees(spark, path, settings) -> ExtraTreesModel:
    return ExtraTreesModel(_trees(spark, path), tuple(settings["columns"]), np.array(settings["gains"]))


def _regressor(spark, path, settings) -> Regressor:
    return Regressor(ML_MODELS[settings["ml"]].load(f"{path}/ml"), tuple(settings["columns"]))


def _stacking(spark, path, settings) -> Stacking:
    meta = settings["meta"]
    ridge = Ridge(
        tuple(meta["columns"]), tuple(meta["coefficients"]), meta["intercept"], meta["alpha"],
        tuple(tuple(e) for e in meta["errors"]),
    )
    return Stacking({name: load_model(spark, f"{path}/bases/{name}") for name in settings["bases"]}, ridge)


_LOADERS = {
    "zones": _zones,
    "isolation": _isolation,
    "extra_trees": _extra_trees,
    "regressor": _regressor,
    "stacking": _stacking,
}
