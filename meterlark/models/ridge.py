"""Ridge regression whose penalty is chosen by leave-one-out error, from two aggregates.

With centred columns the leave-one-out residual of a row is its residual over one minus its
leverage, so no model is fitted twice: one pass gives the cross products, a second one adds up the
squared errors of all penalties at once. Only p x p numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterlark import params


@dataclass(frozen=True)
class Ridge:
    columns: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    alpha: float
    errors: tuple[tuple[float, float], ...]

    def predict(self) -> Column:
        total = F.lit(self.intercept)
        for name, weight in zip(self.columns, self.coefficients):
            total = total + F.col(name) * F.lit(weight)
        return total

    def weights(self, spark: SparkSession) -> DataFrame:
        """(base_model, weight)."""
        return spark.createDataFrame(list(zip(self.columns, self.coefficients)), "base_model string, weight double")

    def loo_table(self, spark: SparkSession) -> DataFrame:
        """(alpha, loo_mse) of every penalty tried."""
        return spark.createDataFrame(list(self.errors), "alpha double, loo_mse double")


def _inner(left: Sequence[Column], right: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for column, weight in zip(left, right):
        total = total + column * F.lit(float(weight))
    return total


def fit_ridge(df: DataFrame, columns: Sequence[str], label: str = "label", alphas=params.RIDGE_ALPHAS) -> Ridge:
    columns = list(columns)
    everything = [*columns, label]
    pairs = [(a, b) for i, a in enumerate(everything) for b in everything[i:]]
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"mean_{i}") for i, c in enumerate(everything)],
        *[F.covar_pop(a, b).alias(f"cov_{i}") for i, (a, b) in enumerate(pairs)],
    ).first()
    n, p = row["n"], len(columns)
    if not n:
        raise ValueError("no rows to fit on")
    means = np.array([row[f"mean_{i}"] for i in range(p + 1)])
    moments = np.zeros((p + 1, p + 1))
    for i, (a, b) in enumerate(pairs):
        j, k = everything.index(a), everything.index(b)
        moments[j, k] = moments[k, j] = row[f"cov_{i}"] * n
    gram, cross = moments[:p, :p], moments[:p, p]

    centred = [F.col(c) - F.lit(float(m)) for c, m in zip(columns, means)]
    target = F.col(label) - F.lit(float(means[p]))
    solved, errors = [], []
    for alpha in alphas:
        inverse = np.linalg.inv(gram + alpha * np.eye(p))
        weights = inverse @ cross
        leverage = F.lit(1.0 / n)
        for i in range(p):
            leverage = leverage + centred[i] * _inner(centred, inverse[i])
        left_out = (target - _inner(centred, weights)) / (F.lit(1.0) - leverage)
        solved.append(weights)
        errors.append(F.avg(left_out * left_out).alias(f"e{len(errors)}"))
    losses = df.agg(*errors).first()
    best = int(np.argmin(list(losses)))
    coefficients = solved[best]
    return Ridge(
        tuple(columns),
        tuple(float(w) for w in coefficients),
        float(means[p] - coefficients @ means[:p]),
        float(alphas[best]),
        tuple((float(a), float(e)) for a, e in zip(alphas, losses)),
    )
