"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosines, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from meterlark.llm.components import connected_components
from meterlark.session import stage

LEAST_COSINE = 0.93
# Share of the pairs at exactly the least cosine that some table must bring together.
RECALL = 0.998
# Vectors that meet in one bucket of one table, about; more bits keep it so as the table grows.
BUCKET = 48
# Vectors that one task compares with as many others.
BLOCK = 512
SEED = 9

LINKS = "rep long, n long, a long, b long"


def sizes(vectors: int, least: float = LEAST_COSINE, recall: float = RECALL, bucket: int = BUCKET) -> tuple[int, int]:
    """(bits, tables) for the largest group: bits by its size, then tables by the wanted recall."""
    bits = max(4, math.ceil(math.log2(max(1, vectors) / bucket))) if vectors > bucket else 4
    same = (1 - math.acos(least) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def usable(embedding: Column) -> Column:
    """Neither null nor empty nor zero, and every component a finite number."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(embedding.isNotNull() & ~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def planes(bits: int, tables: int, width: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((width, bits * tables))


def unit(rows: list[np.ndarray]) -> np.ndarray:
    x = np.stack(rows).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def codes(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The bucket of every vector in every table."""
    signs = (x @ planes(bits, tables, x.shape[1]) > 0).reshape(len(x), tables, bits)
    return (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)


def bucketed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """(label, rep, copies, unit, codes) with the vector at length one in double precision."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for width, rows in frame.groupby(frame["v"].map(len)):
                x = unit(rows["v"].tolist())
                yield pd.DataFrame({
                    "label": rows["label"].to_numpy(), "rep": rows["rep"].to_numpy(), "copies": rows["copies"].to_numpy(),
                    "width": np.int32(width), "unit": list(x), "codes": list(codes(x, bits, tables)),
                })

    schema = "label long, rep long, copies long, width int, unit array<double>, codes array<long>"
    return classes.mapInPandas(run, schema)


def compare(left: pd.DataFrame, right: pd.DataFrame | None, table: int, least: float) -> tuple[np.ndarray, np.ndarray, pd.DataFrame, pd.DataFrame]:
    """Positions (left, right) of the pairs that link and meet in no earlier table."""
    same = right is None
    right = left if same else right
    x, y = np.stack(left["unit"].tolist()), np.stack(right["unit"].tolist())
    i, j = np.nonzero(x @ y.T >= least)
    if same:
        i, j = i[i < j], j[i < j]
    if table and len(i):
        a, b = np.stack(left["codes"].tolist())[:, :table], np.stack(right["codes"].tolist())[:, :table]
        new = ~(a[i] == b[j]).any(axis=1)
        i, j = i[new], j[new]
    return i, j, left, right


def block_links(frame: pd.DataFrame, table: int, least: float) -> pd.DataFrame:
    """Links of one pair of blocks: for every vector the linked others, copies counted, and a tree instead of all pairs.

    Rows of ``frame`` on side 0 meet those on side 1; without side 1 they meet each other.
    """
    left, right = frame[frame["side"] == 0].reset_index(drop=True), frame[frame["side"] == 1].reset_index(drop=True)
    if not len(left) or (frame["other"].iloc[0] != frame["own"].iloc[0] and not len(right)):
        return pd.DataFrame({"rep": [], "n": [], "a": [], "b": []}, dtype="int64")
    i, j, left, right = compare(left, right if len(right) else None, table, least)
    a, b = left["rep"].to_numpy()[i], right["rep"].to_numpy()[j]
    reps, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    weight = np.concatenate([right["copies"].to_numpy()[j], left["copies"].to_numpy()[i]])
    n = np.bincount(number, weights=weight, minlength=len(reps)).astype(np.int64)
    # The smallest id each vector reaches inside the block: one link per vector carries the same components.
    root = np.arange(len(reps))
    u, v = number[: len(a)], number[len(a) :]
    while True:
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, u, low)
        np.minimum.at(root, v, low)
        root = root[root]
        if (root == before).all():
            break
    return pd.DataFrame({"rep": reps, "n": n, "a": reps, "b": reps[root]})


def links(vectors: DataFrame, least: float, bits: int, tables: int) -> DataFrame:
    """(rep, n, a, b): linked others per block and vector, and the block's tree. Every linked pair counts once.

    A bucket beyond ``BLOCK`` vectors is cut into blocks by a hash; every two blocks meet in a task of their own, so that a bucket
    of any size is compared whole, a block pair at a time.
    """
    buckets = vectors.select(
        "label", "width", "rep", "copies", "unit", "codes", F.posexplode("codes").alias("table", "code"))
    key = ("label", "width", "table", "code")
    # The number of rows of each bucket, summed before the shuffle, joins back to cut the large ones.
    counted = buckets.select(*key).groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    cut = buckets.join(counted, list(key)).withColumn("blocks", blocks).withColumn("own", own)
    # Block i meets itself and every later one: as side 0 under (i, j >= i), as side 1 under (j < i, i).
    meets = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("own"), F.lit(0).alias("other"), F.lit(0).alias("side")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
            F.least("own", k).alias("own"), F.greatest("own", k).alias("other"),
            F.when(k >= F.col("own"), 0).otherwise(1).alias("side"))))
    dealt = cut.select(*key, "rep", "copies", "unit", "codes", F.explode(meets).alias("m")).select(
        *key, "rep", "copies", "unit", "codes", "m.*")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return block_links(frame, int(frame["table"].iloc[0]), least)

    return dealt.groupBy(*key, "own", "other").applyInPandas(run, LINKS)


def dedup_embeddings(rows: DataFrame, least: float = LEAST_COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``rows``.

    ``rows`` needs vec_id, embedding and label; other columns are ignored whatever their names. A vector that is null, empty,
    zero or holds a null or a number that is not finite, or that has no label, links with nothing, as does a row without
    vec_id; vectors of different widths do not link. Equal vectors of a label are one class: they link with each other and
    share every other link, and are compared once. Rows that repeat a vec_id keep their rows, count as vectors of their
    own and share a component. An empty table gives no rows.
    """
    valid = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    plain = rows.select("vec_id", F.when(valid, F.col("label")).cast("long").alias("label"),
                        F.col("embedding").cast("array<double>").alias("v"), valid.alias("valid"))
    key = F.when(F.col("valid"), F.struct(F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")))
    plain = plain.withColumn("key", key)
    # Two hashes of the vector name its class, so that only they are shuffled a second time.
    members = plain.select("vec_id", "label", "key.*", "valid")
    classes = plain.filter("valid").groupBy("label", "key").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
    classes = stage(classes, "vector-classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = sizes(largest, least, recall)
    found = stage(links(bucketed(classes.select("label", "rep", "copies", "v"), bits, tables), least, bits, tables), "vector-links")
    direct = found.groupBy("rep").agg(F.sum("n").alias("others"))
    components = connected_components(found.select("a", "b"))
    known = (
        classes.select("label", "key.*", "rep", "copies").join(direct, "rep", "left")
        .join(components, F.col("rep") == F.col("id"), "left")
        .select(F.col("label").alias("_label"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"),
                (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"))
    )
    on = (F.col("label") == F.col("_label")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    return members.join(known, on, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))
