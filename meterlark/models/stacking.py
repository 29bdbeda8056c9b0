"""Stacking: out-of-fold predictions of several base models feed a ridge regression.

Folds are hashes of the row key, so no row is ever predicted by a model that saw it, on any
partitioning. The bases are fitted again on all rows for later use.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame

from meterlark import params
from meterlark.models.extra_trees import ExtraTrees
from meterlark.models.regressors import boosted, fit, forest
from meterlark.models.ridge import Ridge, fit_ridge
from meterlark.operators.splits import fold_of
from meterlark.session import stage


def base_models(
    trees=params.STACK_FOREST_TREES, depth=params.STACK_FOREST_DEPTH,
    rounds=params.STACK_BOOST_ROUNDS, boost_depth=params.STACK_BOOST_DEPTH, seed=params.SEED,
) -> dict[str, Any]:
    return {
        "random_forest": forest(trees, depth, seed),
        "extra_trees": ExtraTrees(trees, depth, seed),
        "boosted_trees": boosted(rounds, boost_depth, params.BOOST_RATE, seed),
    }


def _with_bases(df: DataFrame, fitted: dict[str, Any]) -> DataFrame:
    for name, model in fitted.items():
        df = model(df).withColumnRenamed("prediction", name)
    return df


@dataclass
class Stacking:
    bases: dict[str, Any]
    meta: Ridge

    def __call__(self, df: DataFrame) -> DataFrame:
        scored = _with_bases(df, self.bases).withColumn("prediction", self.meta.predict())
        return scored.drop(*self.bases)


def out_of_fold(
    train: DataFrame, columns: Sequence[str], bases: dict[str, Any], key: str = "id",
    folds: int = params.STACK_FOLDS, seed: int = params.SEED,
) -> DataFrame:
    """(key, label, one column per base): each row predicted by bases fitted on the other folds."""
    fold = fold_of(key, folds, seed)
    parts = []
    for i in range(folds):
        fitted = {name: fit(model, train.filter(fold != i), columns) for name, model in bases.items()}
        parts.append(_with_bases(train.filter(fold == i), fitted).select(key, "label", *bases))
    return reduce(DataFrame.unionByName, parts)


def fit_stacking(
    train: DataFrame, columns: Sequence[str], bases: dict[str, Any] | None = None, key: str = "id",
    folds: int = params.STACK_FOLDS, seed: int = params.SEED, alphas=params.RIDGE_ALPHAS,
) -> Stacking:
    """``train`` should be a stage table: every base and fold reads it again."""
    bases = base_models(seed=seed) if bases is None else bases
    held_out = stage(out_of_fold(train, columns, bases, key, folds, seed), "out-of-fold")
    meta = fit_ridge(held_out, list(bases), "label", alphas)
    return Stacking({name: fit(model, train, columns) for name, model in bases.items()}, meta)
