"""Isolation forest: short paths to isolation mean odd trips.

A tree needs only a small uniform sample, so the table is read once for a bounded pool of rows, the
trees are grown in parallel from it, and scoring sends the finished trees to the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from meterlark import params
from meterlark.errors import ModelNotFittedError
from meterlark.functions.numeric import stable_unit
from meterlark.models.nodes import NODE_SCHEMA, Trees, predict_mean
from meterlark.operators.anomaly import RAW, ScoreScale, fit_scale
from meterlark.session import stage

EULER = 0.5772156649015329


def usual_path(n: float) -> float:
    """Average path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def tree_samples(df: DataFrame, key: str, columns: Sequence[str], trees: int, sample: int, seed: int) -> tuple[DataFrame, int]:
    """(tree, draw, features) with min(sample, rows) distinct rows per tree, and that number.

    The pool is a uniform sample of about trees x sample rows; each tree draws from it without
    replacement. Draws are hashes of the key, so the same rows come back on every run.
    """
    rows = df.count()
    if rows == 0:
        raise ValueError("no rows to fit on")
    size = min(sample, rows)
    most = trees * sample
    wanted = most + 10 * math.sqrt(most) + 10
    pool = df.select(F.col(key).cast("string").alias("key"), *[F.col(c).cast("double").alias(c) for c in columns])
    if rows > wanted:
        pool = pool.filter(stable_unit(F.col("key"), seed) < wanted / rows)
    share = min(1.0, (size + 10 * math.sqrt(size) + 10) / min(rows, most))
    draws = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn(
        "draw", stable_unit(F.concat_ws("/", "tree", "key"), seed)
    )
    place = F.row_number().over(Window.partitionBy("tree").orderBy("draw", "key"))
    # The samples are small enough to be merged into one task; trees should grow side by side.
    tasks = min(trees, 2 * df.sparkSession.sparkContext.defaultParallelism)
    drawn = draws.filter(F.col("draw") < share).repartition(tasks, "tree")
    drawn = drawn.withColumn("place", place).filter(F.col("place") <= size)
    return drawn.drop("key", "place"), size


def grow_tree(x: np.ndarray, tree: int, seed: int, depth: int) -> pd.DataFrame:
    """Random splits of a small sample until rows are alone or the depth is reached."""
    rng = np.random.default_rng([seed, tree])
    trees, pending = Trees.roots(1), [(0, np.arange(len(x)), 0)]
    while pending:
        node, rows, level = pending.pop()
        spread = np.flatnonzero(x[rows].max(axis=0) > x[rows].min(axis=0)) if len(rows) > 1 else []
        if level == depth or not len(spread):
            trees.value[0][node] = level + usual_path(len(rows))
            continue
        feature = int(rng.choice(spread))
        values = x[rows, feature]
        threshold = rng.uniform(values.min(), values.max())
        goes_left = values <= threshold
        if goes_left.all():
            goes_left = values < values.max()
            threshold = values[goes_left].max()
        children = trees.split(0, node, feature, threshold, 0.0, 0.0)
        pending += [(children[1], rows[~goes_left], level + 1), (children[0], rows[goes_left], level + 1)]
    n = trees.size(0)
    return pd.DataFrame(
        {
            "tree": np.full(n, tree), "node": np.arange(n), "feature": trees.feature[0], "threshold": trees.threshold[0],
            "left": trees.left[0], "right": trees.right[0], "value": trees.value[0],
        }
    )


def grow(samples: DataFrame, columns: Sequence[str], size: int, seed: int) -> DataFrame:
    """Node table of all trees; each group is one tree's small sample."""
    depth, names = max(1, math.ceil(math.log2(max(size, 2)))), list(columns)

    def one_tree(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values(["draw", *names])
        return grow_tree(ordered[names].to_numpy(np.float64), int(rows["tree"].iloc[0]), seed, depth)

    return samples.groupBy("tree").applyInPandas(one_tree, NODE_SCHEMA)


@dataclass
class IsolationForest:
    """Detector with the score range and threshold of its training table, kept as one unit."""

    columns: tuple[str, ...] = params.ANOMALY_FEATURES
    contamination: float = params.CONTAMINATION
    n_trees: int = params.ISOLATION_TREES
    sample: int = params.ISOLATION_SAMPLE
    seed: int = params.SEED
    trees: Trees | None = None
    size: int | None = None
    scale: ScoreScale | None = None

    def fit(self, df: DataFrame, key: str = "id") -> "IsolationForest":
        samples, self.size = tree_samples(df, key, self.columns, self.n_trees, self.sample, self.seed)
        self.trees = Trees.from_table(grow(samples, self.columns, self.size, self.seed))
        # Range and threshold read the scores several times; the trees are walked once.
        self.scale = fit_scale(stage(self.raw(df).select(RAW), "raw-scores"), self.contamination)
        return self

    def raw(self, df: DataFrame) -> DataFrame:
        """Add the raw score in (0, 1), higher = odder."""
        if self.trees is None:
            raise ModelNotFittedError("fit or load the detector before scoring")
        path = predict_mean(df.sparkSession, self.trees, self.columns)
        usual = usual_path(self.size) or 1.0
        return df.withColumn(RAW, F.pow(F.lit(2.0), -path / usual))

    def score(self, df: DataFrame) -> DataFrame:
        """Add raw score, normalised score and flag."""
        if self.scale is None:
            raise ModelNotFittedError("fit or load the detector before scoring")
        return self.scale.apply(self.raw(df))

    __call__ = score
