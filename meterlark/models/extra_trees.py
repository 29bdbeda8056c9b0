"""Extremely randomised trees, grown side by side over the whole cluster with one read of the table per level.

A random threshold must be uniform between the smallest and the largest value of its feature in the node, and that range is known only
after the rows were read. So a node is looked at with a box that surely holds it (its parent's range, cut at the split), and the same read
gathers the true range and the label sums below a few draws from the box. The first draw that falls into the true range is uniform there;
when a feature has none, the node waits for the next read, whose box is the true range. Tasks send sums per (node, feature),
never rows; Spark adds them up and picks each node's best split. The driver holds the trees and the open nodes of one
read; trees beyond that wait, so its size depends on the model, not on the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from meterlark import params
from meterlark.models.nodes import Trees, predict_mean

# Open (tree, node) pairs handled per read; deep levels take several reads instead of more memory.
PAIRS_PER_READ = 10_000
# Thresholds drawn from a node's box per feature and read.
DRAWS = 4
# Pairs whose sums a task hands over at once.
HANDED = 1000
# Steps of the 32-bit mixing that makes a draw of its keys; any engine with whole numbers can repeat them.
MIX_STEP, MIX_FIRST, MIX_SECOND = 0x9E3779B9, 0x2C1B3C6D, 0x297A2D39


@dataclass(frozen=True)
class ExtraTrees:
    """Settings; no bootstrap, every feature considered at every node."""

    trees: int = params.FOREST_TREES
    depth: int = params.FOREST_DEPTH
    seed: int = params.SEED
    min_rows: int = 2
    pairs_per_read: int = PAIRS_PER_READ

    def fit_table(self, train: DataFrame, columns: Sequence[str]) -> "ExtraTreesModel":
        return grow(train, tuple(columns), self)


@dataclass
class ExtraTreesModel:
    trees: Trees
    columns: tuple[str, ...]
    gains: np.ndarray = field(repr=False, default=None)
    reads: int = 0

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", predict_mean(df.sparkSession, self.trees, self.columns))

    @property
    def importances(self) -> list[tuple[str, float]]:
        """Share of the total variance reduction each feature brought."""
        total = self.gains.sum()
        return [(c, float(g / total) if total else 0.0) for c, g in zip(self.columns, self.gains)]


def unit(*keys) -> np.ndarray:
    """Numbers in [0, 1) fixed by whole-number keys that broadcast against each other."""
    word = np.uint64(0xFFFFFFFF)
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for key in keys:
            h = (h + np.asarray(key).astype(np.uint64) + np.uint64(MIX_STEP)) & word
            h = ((h ^ (h >> np.uint64(15))) * np.uint64(MIX_FIRST)) & word
            h = ((h ^ (h >> np.uint64(12))) * np.uint64(MIX_SECOND)) & word
            h = h ^ (h >> np.uint64(15))
    return h.astype(np.float64) / 2.0**32


@dataclass
class Pairs:
    """Open nodes: where they are, how often they waited, and a box that holds the features of their rows."""

    tree: np.ndarray
    node: np.ndarray
    path: np.ndarray  # 1 for a root, 2i and 2i + 1 for the children of i
    waits: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def __len__(self) -> int:
        return len(self.tree)

    def at(self, where) -> "Pairs":
        return Pairs(*[v[where] for v in vars(self).values()])

    def cuts(self, seed: int) -> np.ndarray:
        """Thresholds drawn for every pair and feature, one layer per draw; never the box's upper end."""
        feature = np.arange(self.low.shape[1])
        keys = self.path[:, None] & 0xFFFFFFFF, self.path[:, None] >> 32, feature
        drawn = np.stack([
            self.low + unit(seed, self.tree[:, None], *keys, (self.waits * DRAWS + k)[:, None]) * (self.high - self.low) for k in range(DRAWS)
        ])
        return np.where(drawn >= self.high, self.low, drawn)

    def slots(self, trees: Trees) -> dict[int, np.ndarray]:
        """For each tree, the position of an open node among the pairs, -1 for other nodes."""
        found = {int(t): np.full(trees.size(t), -1, np.int64) for t in np.unique(self.tree)}
        for t, slot in found.items():
            own = np.flatnonzero(self.tree == t)
            slot[self.node[own]] = own
        return found


def joined(parts: list[Pairs]) -> Pairs:
    return Pairs(*[np.concatenate([getattr(p, name) for p in parts]) for name in vars(parts[0])])


def sums_of(train: DataFrame, columns: Sequence[str], trees: Trees, pairs: Pairs, seed: int) -> DataFrame:
    """Per pair and feature: rows, label sums, true range, and for every draw its threshold and the rows and label sum at or below it."""
    slots = pairs.slots(trees)
    shared = train.sparkSession.sparkContext.broadcast((trees.packed(slots), slots, pairs))
    p, n_pairs = len(columns), len(pairs)
    drawn = [(f"left{k}", f"sum{k}", f"cut{k}") for k in range(DRAWS)]

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes, slot_tables, held = shared.value
        cuts = held.cuts(seed)
        n, sy, syy = np.zeros(n_pairs), np.zeros(n_pairs), np.zeros(n_pairs)
        lo, hi = np.full((n_pairs, p), np.inf), np.full((n_pairs, p), -np.inf)
        left, sums = np.zeros((DRAWS, n_pairs, p)), np.zeros((DRAWS, n_pairs, p))
        for batch in batches:
            every = batch[list(columns)].to_numpy(np.float64)
            label = batch["label"].to_numpy(np.float64)
            for tree, slot_of_node in slot_tables.items():
                slot = slot_of_node[nodes.leaf_of(every, tree)]
                rows = np.flatnonzero(slot >= 0)
                if not len(rows):
                    continue
                rows = rows[np.argsort(slot[rows], kind="stable")]
                slot, x, y = slot[rows], every[rows], label[rows]
                seen, starts = np.unique(slot, return_index=True)
                n += np.bincount(slot, minlength=n_pairs)
                sy += np.bincount(slot, y, n_pairs)
                syy += np.bincount(slot, y * y, n_pairs)
                lo[seen] = np.minimum(lo[seen], np.minimum.reduceat(x, starts, axis=0))
                hi[seen] = np.maximum(hi[seen], np.maximum.reduceat(x, starts, axis=0))
                for k in range(DRAWS):
                    below = x <= cuts[k][slot]
                    left[k][seen] += np.add.reduceat(below, starts, axis=0, dtype=np.float64)
                    sums[k][seen] += np.add.reduceat(below * y[:, None], starts, axis=0)
        seen = np.flatnonzero(n > 0)
        for some in np.array_split(seen, max(1, -(-len(seen) // HANDED))):
            frame = {"pair": np.repeat(some, p), "feature": np.tile(np.arange(p), len(some))}
            frame |= {name: np.repeat(v[some], p) for name, v in (("n", n), ("sy", sy), ("syy", syy))}
            frame |= {"lo": lo[some].ravel(), "hi": hi[some].ravel()}
            for k, names in enumerate(drawn):
                frame |= dict(zip(names, (left[k][some].ravel(), sums[k][some].ravel(), cuts[k][some].ravel())))
            yield pd.DataFrame(frame)

    added = ["n", "sy", "syy", *[c for names in drawn for c in names[:2]]]
    schema = "pair long, feature int, n double, sy double, syy double, lo double, hi double, " + ", ".join(
        f"{c} double" for names in drawn for c in names)
    # Every task sums before it hands over, so rows go straight to where their pair's split is chosen.
    return train.mapInPandas(task, schema).repartition("pair").groupBy("pair", "feature").agg(
        *[F.sum(c).alias(c) for c in added], F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        *[F.min(names[2]).alias(names[2]) for names in drawn])


def best_splits(sums: DataFrame, min_rows: int) -> DataFrame:
    """One row per pair: rows and label sum, whether it can be split and must wait, its true ranges, and its best split.

    A feature's threshold is its first draw within the true range. Sums arrive in any order; rounding keeps equal gains equal, and
    the first feature wins.
    """
    inside = [(F.col(f"cut{k}") >= F.col("lo")) & (F.col(f"cut{k}") < F.col("hi")) for k in range(DRAWS)]

    def first(kind: str):
        return F.coalesce(*[F.when(ok, F.col(f"{kind}{k}")) for k, ok in enumerate(inside)])

    varied = F.col("hi") > F.col("lo")
    impure = (F.col("n") >= min_rows) & (F.col("syy") - F.col("sy") * F.col("sy") / F.col("n") > 1e-12 * F.col("n"))
    chosen = sums.select(
        "pair", "feature", "n", "sy", "lo", "hi", (varied & impure).alias("varied"),
        first("left").alias("left"), first("sum").alias("below"), first("cut").alias("cut"))
    right, above = F.col("n") - F.col("left"), F.col("sy") - F.col("below")
    gain = F.col("below") ** 2 / F.col("left") + above**2 / right - F.col("sy") ** 2 / F.col("n")
    gained = chosen.withColumn("gain", F.when(F.col("varied") & F.col("cut").isNotNull(), gain))
    rank = F.when(F.col("gain").isNotNull(), F.struct(F.round("gain", 9), -F.col("feature")))
    split = F.max_by(F.struct("feature", "cut", "left", "below", "gain"), rank)
    return gained.groupBy("pair").agg(
        F.first("n").alias("n"), F.first("sy").alias("sy"), F.bool_or("varied").alias("open"),
        F.bool_or(F.col("varied") & F.col("cut").isNull()).alias("waits"), split.alias("split"),
        F.array_sort(F.collect_list(F.struct("feature", "lo", "hi"))).alias("ranges"),
    ).select("pair", "n", "sy", "open", "waits", "split.*", "ranges.lo", "ranges.hi")


def grow(train: DataFrame, columns: tuple[str, ...], settings: ExtraTrees) -> ExtraTreesModel:
    """Fit on ``columns`` and ``label``; ``train`` should be a stage table, since it is read per level."""
    data = train.select(*columns, "label")
    p = len(columns)
    ends = data.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    trees, gains, reads = Trees.roots(settings.trees), np.zeros(p), 1
    if ends["lo0"] is None:
        raise ValueError("no rows to fit on")
    low, high = (np.tile([float(ends[f"{n}{i}"]) for i in range(p)], (settings.trees, 1)) for n in ("lo", "hi"))
    zeros, roots = np.zeros(settings.trees, np.int64), np.arange(settings.trees)
    frontier = Pairs(roots, zeros, zeros + 1, zeros, low, high)
    while len(frontier) and settings.depth:
        # The first trees first: a read meets few trees as they get deep, and the others wait at a low level.
        order = np.lexsort((frontier.path, frontier.tree))
        pairs, later = frontier.at(order[: settings.pairs_per_read]), frontier.at(order[settings.pairs_per_read :])
        found = best_splits(sums_of(data, columns, trees, pairs, settings.seed), settings.min_rows).toPandas().sort_values("pair")
        reads += 1
        pairs = pairs.at(found["pair"].to_numpy())
        n, total = found["n"].to_numpy(), found["sy"].to_numpy()
        lo, hi = np.stack(found["lo"].to_numpy()), np.stack(found["hi"].to_numpy())
        for i in np.flatnonzero(pairs.path == 1):
            trees.value[pairs.tree[i]][0] = total[i] / n[i]
        waits = found["waits"].to_numpy(bool)
        ready = np.flatnonzero(found["open"].to_numpy(bool) & ~waits)
        again = pairs.at(waits)
        queue = [later, Pairs(again.tree, again.node, again.path, again.waits + 1, lo[waits], hi[waits])]
        if len(ready):
            split, own = found.iloc[ready], pairs.at(ready)
            f, cut, left, below = (split[c].to_numpy() for c in ("feature", "cut", "left", "below"))
            f = f.astype(np.int64)
            np.add.at(gains, f, np.maximum(split["gain"].to_numpy(), 0.0))
            right = n[ready] - left
            first = trees.split_all(own.tree, own.node, f, cut, below / left, (total[ready] - below) / right)
            for side, rows in ((0, left), (1, right)):
                box_low, box_high = lo[ready].copy(), hi[ready].copy()
                (box_low if side else box_high)[np.arange(len(f)), f] = cut
                child = Pairs(own.tree, first + side, 2 * own.path + side, np.zeros(len(f), np.int64), box_low, box_high)
                queue.append(child.at((rows >= settings.min_rows) & (child.path < 1 << settings.depth)))
        frontier = joined(queue)
    return ExtraTreesModel(trees, columns, gains, reads)
