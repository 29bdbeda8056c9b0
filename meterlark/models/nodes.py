"""Binary trees as arrays: routing of rows and vectorised scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double"


@dataclass
class Trees:
    """Per tree parallel lists; ``feature`` -1 marks a leaf. Rows at or below a threshold go left."""

    feature: list[list[int]]
    threshold: list[list[float]]
    left: list[list[int]]
    right: list[list[int]]
    value: list[list[float]]

    @classmethod
    def roots(cls, n: int) -> "Trees":
        return cls(*[[[empty] for _ in range(n)] for empty in (-1, 0.0, -1, -1, 0.0)])

    def __len__(self) -> int:
        return len(self.feature)

    def size(self, tree: int) -> int:
        return len(self.feature[tree])

    def split(self, tree: int, node: int, feature: int, threshold: float, low: float, high: float) -> tuple[int, int]:
        """Turn a leaf into an inner node; returns the ids of its two new leaves."""
        first = self.size(tree)
        self.feature[tree][node], self.threshold[tree][node] = feature, float(threshold)
        self.left[tree][node], self.right[tree][node] = first, first + 1
        for value in (low, high):
            for column, empty in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, float(value))):
                column[tree].append(empty)
        return first, first + 1

    def split_all(self, tree: np.ndarray, node: np.ndarray, feature: np.ndarray, threshold: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Split many leaves at once; returns the id of each one's first new leaf, the second is the next."""
        first = np.empty(len(tree), np.int64)
        for t in np.unique(tree):
            own = np.flatnonzero(tree == t)
            size = self.size(t)
            first[own] = size + 2 * np.arange(len(own))
            for i, at in zip(own.tolist(), node[own].tolist()):
                self.feature[t][at], self.threshold[t][at] = int(feature[i]), float(threshold[i])
                self.left[t][at], self.right[t][at] = int(first[i]), int(first[i]) + 1
            new = 2 * len(own)
            for column, empty in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1)):
                column[t].extend([empty] * new)
            self.value[t].extend(np.column_stack([low[own], high[own]]).ravel().tolist())
        return first

    def packed(self, only=None) -> "Trees":
        """The same trees as arrays, smaller to send and ready to route rows; of other trees than ``only`` nothing."""
        parts = (self.feature, self.threshold, self.left, self.right, self.value)
        types = (np.int32, np.float64, np.int32, np.int32, np.float64)
        return Trees(*[
            [np.asarray(column, kind) if only is None or t in only else None for t, column in enumerate(part)] for part, kind in zip(parts, types)])

    def leaf_of(self, x: np.ndarray, tree: int) -> np.ndarray:
        """Node where each row ends."""
        feature, threshold = np.asarray(self.feature[tree]), np.asarray(self.threshold[tree])
        left, right = np.asarray(self.left[tree]), np.asarray(self.right[tree])
        node = np.zeros(len(x), np.int64)
        moving = np.flatnonzero(feature[node] >= 0)
        while len(moving):
            at = node[moving]
            goes_left = x[moving, feature[at]] <= threshold[at]
            node[moving] = np.where(goes_left, left[at], right[at])
            moving = moving[feature[node[moving]] >= 0]
        return node

    def mean(self, x: np.ndarray) -> np.ndarray:
        """Average over the trees of the leaf values."""
        total = np.zeros(len(x))
        for tree in range(len(self)):
            total += np.asarray(self.value[tree])[self.leaf_of(x, tree)]
        return total / len(self)

    def to_table(self, spark: SparkSession) -> DataFrame:
        frames = [
            pd.DataFrame(
                {
                    "tree": t, "node": range(self.size(t)), "feature": self.feature[t], "threshold": self.threshold[t],
                    "left": self.left[t], "right": self.right[t], "value": self.value[t],
                }
            )
            for t in range(len(self))
        ]
        return spark.createDataFrame(pd.concat(frames, ignore_index=True), NODE_SCHEMA)

    @classmethod
    def from_table(cls, nodes: DataFrame) -> "Trees":
        """Reads a model: as many rows as the forest has nodes."""
        found = nodes.toPandas().sort_values(["tree", "node"])
        grouped = [g for _, g in found.groupby("tree")]
        return cls(*[[g[c].tolist() for g in grouped] for c in ("feature", "threshold", "left", "right", "value")])


def predict_mean(spark: SparkSession, trees: Trees, columns) -> Column:
    """Column with the forest's average for each row; the forest travels once per executor.

    Rows with an unknown feature get null.
    """
    shared = spark.sparkContext.broadcast(trees.packed())

    @F.pandas_udf("double")
    def forest_mean(*features: pd.Series) -> pd.Series:
        x = np.column_stack([f.to_numpy(np.float64, na_value=np.nan) for f in features])
        known = ~np.isnan(x).any(axis=1)
        result = np.full(len(x), np.nan)
        result[known] = shared.value.mean(x[known])
        return pd.Series(result).where(known, None)

    return forest_mean(*[F.col(c).cast("double") for c in columns])
