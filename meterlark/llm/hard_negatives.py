"""Hard-negative mining by segment summaries.

For every vector the mean and the deviation of each of its segments are stored. The product of two vectors over a segment is the
product of the means times the segment's length, plus or minus at most the product of the deviations (Cauchy-Schwarz), so summaries bound
a score from both sides. A pair starts with one segment; only pairs that the bounds cannot settle are looked at in finer ones, and only
what is left is scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlark.session import stage

# Segments of the levels, coarse to fine. Every level cuts the segments of the one before.
LEVELS = (1, 4, 16)
# Anchors and vectors that one task compares: its bounds are a few matrices of 1,024 x 2,048 doubles.
ANCHOR_BLOCK = 1024
VECTOR_BLOCK = 2048
# Relative room for rounding in the bounds; exact scores are whole numbers.
SLACK = 1e-9
NEVER = np.iinfo(np.int64)


@dataclass(frozen=True)
class Mining:
    """How many positives an anchor has, how many negatives each of these, and the window of scores in hundredths of the positive's."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    anchor_every: int = 100
    relabel_every: int = 7
    labels: int = 10
    scale: int = 256


def bounds_of(width: int, segments: int) -> np.ndarray:
    """Where the segments of a vector begin, with its end; fewer than asked for where the vector is shorter."""
    return np.unique(np.arange(segments + 1) * width // segments)


def largest(width: int) -> int:
    """The largest component whose products of such a width stay within a long (and within an int themselves)."""
    return min((1 << 31) - 1, math.isqrt(((1 << 63) - 1) // max(1, width)))


def summaries(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations (root of the summed squared differences) of the segments of all levels, one row per vector."""
    means, deviations = [], []
    for segments in LEVELS:
        at = bounds_of(q.shape[1], segments)
        size = np.diff(at)
        mean = np.add.reduceat(q, at[:-1], axis=1) / size
        means.append(mean)
        deviations.append(np.sqrt(np.add.reduceat((q - np.repeat(mean, size, axis=1)) ** 2, at[:-1], axis=1)))
    return np.concatenate(means, axis=1), np.concatenate(deviations, axis=1)


VECTORS = "vec_id long, label long, width int, q array<int>, mean array<double>, deviation array<double>"


def vectors_of(rows: DataFrame, rule: Mining) -> DataFrame:
    """``VECTORS`` of the rows that take part: whole components, and the summaries of all levels.

    One row per vec_id: of rows that share one, the smallest (label, vector) speaks for it.
    """
    vector = F.col("embedding").cast("array<double>")
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.when(F.col("vec_id") % rule.relabel_every == 0, (F.col("label").cast("long") + 1) % rule.labels).otherwise(F.col("label"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    plain = rows.filter(usable).select("vec_id", label.cast("long").alias("label"), vector.alias("v")).filter(finite)
    one = plain.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.*")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for width, part in frame.groupby(frame["v"].map(len)):
                most = largest(width)
                # Held at the bound before scaling, where a huge component would overflow.
                x = np.stack(part["v"].tolist()).reshape(len(part), width)
                q = np.clip(np.floor(np.clip(x, -most, most) * rule.scale), -most, most)
                mean, deviation = summaries(q) if width else (q, q)
                yield pd.DataFrame({
                    "vec_id": part["vec_id"].to_numpy(), "label": part["label"].to_numpy(), "width": np.int32(width),
                    "q": list(q.astype(np.int32)), "mean": list(mean), "deviation": list(deviation),
                })

    return one.mapInPandas(run, VECTORS)


class Side:
    """The vectors of one side of a block pair as matrices."""

    def __init__(self, frame: pd.DataFrame):
        self.ids = frame["vec_id"].to_numpy()
        self.labels = frame["label"].to_numpy()
        self.q = np.stack(frame["q"].tolist()).astype(np.int64)
        self.mean = np.stack(frame["mean"].tolist()).astype(np.float64)
        self.deviation = np.stack(frame["deviation"].tolist()).astype(np.float64)


def level_columns(width: int) -> list[tuple[slice, np.ndarray]]:
    """The summary columns of each level and the lengths of its segments."""
    out, at = [], 0
    for segments in LEVELS:
        size = np.diff(bounds_of(width, segments))
        out.append((slice(at, at + len(size)), size))
        at += len(size)
    return out


def exact(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whole-number scores of the pairs (i, j)."""
    out = np.empty(len(i), dtype=np.int64)
    for at in range(0, len(i), 1 << 17):
        part = slice(at, at + (1 << 17))
        out[part] = np.einsum("nd,nd->n", a.q[i[part]], b.q[j[part]])
    return out


def first_pairs(i: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Which pairs are among the first ``most`` of their anchor: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, i))
    place = np.arange(len(order)) - np.searchsorted(i[order], i[order])
    return order[place < most]


def least_of(i: np.ndarray, score: np.ndarray, anchors: int, most: int) -> np.ndarray:
    """For every anchor its ``most``-th highest score among the pairs; minus infinity where it has fewer."""
    out = np.full(anchors, -np.inf)
    order = np.lexsort((-score, i))
    place = np.arange(len(order)) - np.searchsorted(i[order], i[order])
    last = order[place == most - 1]
    out[i[last]] = score[last]
    return out


def search(a: Side, b: Side, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window, anchor, vector, score): for every anchor and window of scores low..high its first ``most`` allowed pairs.

    ``low`` and ``high`` are whole numbers, anchors x windows; a window that is not wanted has low > high. Bounds by one segment
    come first, for all pairs at once; finer ones only for pairs that are left. At every level the ``most``-th best lower bound of the pairs
    that surely lie in a window is a floor that its other pairs must be able to reach. What is left is scored exactly.
    """
    levels = level_columns(a.q.shape[1])
    scale = np.sqrt((a.q.astype(np.float64) ** 2).sum(axis=1))[:, None] * np.sqrt((b.q.astype(np.float64) ** 2).sum(axis=1))[None, :]
    room = scale * SLACK + 1e-6
    columns, size = levels[0]
    middle = (a.mean[:, columns] * size) @ b.mean[:, columns].T
    spread = a.deviation[:, columns] @ b.deviation[:, columns].T + room
    alive = allowed & (middle + spread >= low.min(axis=1)[:, None]) & (middle - spread <= high.max(axis=1)[:, None])
    i, j = np.nonzero(alive)
    middle, spread, room = middle[i, j], spread[i, j], room[i, j]
    floor = low.astype(np.float64)
    for level in range(len(levels)):
        if level:
            columns, size = levels[level]
            am, ad, bm, bd = a.mean[:, columns] * size, a.deviation[:, columns], b.mean[:, columns], b.deviation[:, columns]
            middle, spread = np.empty(len(i)), room.copy()
            for at in range(0, len(i), 1 << 17):
                part = slice(at, at + (1 << 17))
                middle[part] = np.einsum("nd,nd->n", am[i[part]], bm[j[part]])
                spread[part] += np.einsum("nd,nd->n", ad[i[part]], bd[j[part]])
        # Pairs that certainly lie in a window, by their lower bound: the most-th best of these bounds is a floor for the window.
        useful = np.zeros(len(i), dtype=bool)
        for w in range(low.shape[1]):
            sure = (middle - spread >= low[i, w]) & (middle + spread <= high[i, w])
            floor[:, w] = np.maximum(floor[:, w], least_of(i[sure], (middle - spread)[sure], len(a.ids), most))
            useful |= (middle + spread >= floor[i, w]) & (middle - spread <= high[i, w])
        i, j, middle, spread, room = (x[useful] for x in (i, j, middle, spread, room))
    score = exact(a, b, i, j)
    found = []
    for w in range(low.shape[1]):
        inside = np.flatnonzero((score >= low[i, w]) & (score <= high[i, w]))
        first = inside[first_pairs(i[inside], score[inside], b.ids[j[inside]], most)]
        found.append((np.full(len(first), w), i[first], j[first], score[first]))
    return tuple(np.concatenate(x) for x in zip(*found))


FOUND = "anchor_id long, window int, vec_id long, score long"


def found_frame(a: Side, b: Side, found: tuple) -> pd.DataFrame:
    w, i, j, score = found
    return pd.DataFrame({"anchor_id": a.ids[i], "window": w.astype(np.int32), "vec_id": b.ids[j], "score": score})


def dealt(anchors: DataFrame, vectors: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``own`` and ``other`` blocks: every block of anchors meets every block of vectors that shares ``keys``.

    Numbers of rows are counted per key and join back, so a key that holds a third of all rows is cut into as many blocks as it needs.
    """
    sizes = vectors.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / VECTOR_BLOCK).cast("int").alias("others")).join(
        anchors.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / ANCHOR_BLOCK).cast("int").alias("owns")), keys)

    def block(of: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.col(of)).cast("int")

    def copies(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    left = anchors.join(sizes, keys).withColumn("own", block("owns")).withColumn("other", copies("others"))
    right = vectors.join(sizes, keys).withColumn("other", block("others")).withColumn("own", copies("owns"))
    # Columns of their own on either side, since both come from one table.
    return tuple(df.select(*[F.col(c).alias(c) for c in df.columns if c not in ("owns", "others")]) for df in (left, right))


def best(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of every key with their ``rank``; the limit acts before the shuffle too."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def positives_of(anchors: DataFrame, vectors: DataFrame, rule: Mining) -> DataFrame:
    """(anchor_id, positives): the first rows of the anchor's label as an array of (vec_id, score), best first."""
    keys = ["label", "width"]
    left, right = dealt(anchors, vectors, keys)

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({c.split()[0]: [] for c in FOUND.split(", ")}, dtype="int64")
        one, two = Side(a), Side(b)
        every = np.full((len(one.ids), 1), NEVER.min), np.full((len(one.ids), 1), NEVER.max)
        return found_frame(one, two, search(one, two, one.ids[:, None] != two.ids, *every, rule.positives))

    groups = [*keys, "own", "other"]
    found = left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInPandas(run, FOUND)
    return best(found.drop("window"), ["anchor_id"], rule.positives).groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))


def mine(rows: DataFrame, rule: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` needs vec_id, embedding and label; other columns are ignored whatever their names. Rows with a null vec_id, label or vector, or
    with a component that is null or not finite, take no part; of rows that share a vec_id the smallest (label, vector) does. Vectors meet
    those of their own width; an empty vector scores 0 with its like. Components become floor(scale * x), held within the largest number whose
    products fit a long (+-379,625,062 for 64 components). Ties go to the smaller vec_id. A positive without a row in its
    window of scores gives no rows; so does an empty table.

    Anchors (one in ``anchor_every``) meet all rows, block by block: first those of their label, cut into blocks however many there are,
    for the positives, then all others. Each block returns at most the first few of each anchor and window.
    """
    vectors = stage(vectors_of(rows, rule), "mining-vectors")
    anchors = vectors.filter(F.col("vec_id") % rule.anchor_every == 0)
    positives = stage(positives_of(anchors, vectors, rule), "mining-positives")
    wanting = anchors.join(positives.withColumnRenamed("anchor_id", "vec_id"), "vec_id").withColumn(
        "high", F.transform("positives", lambda p: p["score"])).drop("positives")
    left, right = dealt(wanting, vectors, ["width"])

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({c.split()[0]: [] for c in FOUND.split(", ")}, dtype="int64")
        one, two = Side(a), Side(b)
        low = np.full((len(a), rule.positives), NEVER.max)
        high = np.full((len(a), rule.positives), NEVER.min)
        for n, scores in enumerate(a["high"]):
            for w, p in enumerate(int(s) for s in scores):
                # Whole numbers with low * p <= 100 * score <= high * p.
                low[n, w], high[n, w] = -(-rule.low * p // 100), rule.high * p // 100
        return found_frame(one, two, search(one, two, one.labels[:, None] != two.labels, low, high, rule.negatives))

    groups = ["width", "own", "other"]
    found = left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInPandas(run, FOUND)
    ranked = best(found, ["anchor_id", "window"], rule.negatives)
    known = positives.select("anchor_id", F.posexplode("positives").alias("window", "p")).select(
        "anchor_id", "window", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return ranked.join(known, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
