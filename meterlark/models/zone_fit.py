"""Fitting pickup zones with k-means, and comparing numbers of zones."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterlark import params
from meterlark.operators.encoding import assemble
from meterlark.operators.splits import sample_rows
from meterlark.operators.zones import ZoneModel, assign_zone, longitude_factor
from meterlark.session import stage

# Points of a silhouette unless the caller asks for another number; all of them travel to every task.
SILHOUETTE_ROWS = 10_000
# Distances that a task holds at once.
CELLS = 1 << 17


def fit_zones(
    df: DataFrame, k: int = params.N_ZONES, seed: int = params.SEED, inits: int = params.ZONE_INITS, iterations: int = 300
) -> ZoneModel:
    """Best of several k-means|| starts on straightened coordinates; the factor is frozen in the model.

    ``iterations`` is an upper bound; a start stops when its centres no longer move. The best start is settled: its centres are the means of
    the rows that the model assigns to them, and the inertia is that of these centres.
    """
    points = stage(df.select("pickup_latitude", "pickup_longitude"), "zone-points")
    factor = longitude_factor(points)
    plane = assemble(
        points.select(
            F.col("pickup_latitude").alias("north"), (F.col("pickup_longitude") * F.lit(factor)).alias("east")
        ),
        ["north", "east"],
    ).select("features").persist()
    best, cost = None, float("inf")
    try:
        for start in range(inits):
            model = KMeans(k=k, seed=seed + start, maxIter=iterations, tol=1e-6).fit(plane)
            if model.summary.trainingCost < cost:
                best, cost = model.clusterCenters(), model.summary.trainingCost
    finally:
        plane.unpersist()
    return settled(points, ZoneModel(tuple((float(c[0]), float(c[1]) / factor) for c in best), factor, float(cost)))


def known_points(points: DataFrame) -> DataFrame:
    """Rows that have a zone. Told by the coordinates: a filter on the zone itself is moved below the projection, which then computes the
    distances several times in code too long to be compiled (18 s instead of 1.6 s on 580,816 rows)."""
    return points.filter("abs(pickup_latitude) < double('inf') AND abs(pickup_longitude) < double('inf')")


def members(points: DataFrame, zones: ZoneModel) -> DataFrame:
    """(pickup_zone, n, lat, lon, spread): size, mean and sum of squared straightened distances to the mean of every zone that has rows."""
    known = assign_zone(known_points(points), zones)
    return known.groupBy("pickup_zone").agg(
        F.count(F.lit(1)).alias("n"), F.avg("pickup_latitude").alias("lat"), F.avg("pickup_longitude").alias("lon"),
        (F.count(F.lit(1)) * (F.var_pop("pickup_latitude") + F.lit(zones.longitude_factor ** 2) * F.var_pop("pickup_longitude"))).alias("spread"))


def _nearest(lat: np.ndarray, lon: np.ndarray, centres: np.ndarray, factor: float) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Slices of the rows with their zones, as ``ZoneModel.nearest`` finds them, and how much farther the second nearest centre is."""
    k = len(centres)
    step = max(1, CELLS // k)
    for at in (slice(i, i + step) for i in range(0, len(lat), step)):
        north, east = lat[at, None] - centres[:, 0], (lon[at, None] - centres[:, 1]) * factor
        squares = north * north + east * east
        nearest = np.sqrt(np.partition(squares, 1, axis=1)[:, :2]) if k > 1 else np.tile([0.0, np.inf], (len(squares), 1))
        yield at, squares.argmin(axis=1), nearest[:, 1] - nearest[:, 0]


def _may_change(lead: np.ndarray, reach: float) -> np.ndarray:
    """Rows that may get another zone while no centre is farther than ``reach`` from its place; two centres lose a lead of twice that."""
    return ~(lead > 2 * reach * (1 + 1e-9) + 1e-12)


def zone_sums(rows: DataFrame, zones: ZoneModel, reach: float = 0.0) -> np.ndarray:
    """Sums of every zone, first of rows that keep it while no centre moves farther than ``reach``, then of the others.

    Per zone: rows, offsets to the north and east from the first centre, squared straightened offsets. Tasks hand over sums, never rows.
    """
    centres, factor, k = np.array(zones.centroids), zones.longitude_factor, zones.n_zones

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((4, 2 * k))
        for batch in batches:
            lat, lon = batch["pickup_latitude"].to_numpy(np.float64), batch["pickup_longitude"].to_numpy(np.float64)
            for at, zone, lead in _nearest(lat, lon, centres, factor):
                cell = zone + k * _may_change(lead, reach)
                north, east = lat[at] - centres[0, 0], lon[at] - centres[0, 1]
                for i, weight in enumerate((None, north, east, north * north + (east * factor) ** 2)):
                    total[i] += np.bincount(cell, weight, 2 * k)
        yield pd.DataFrame({"cell": np.arange(2 * k), **dict(zip(("n", "north", "east", "squares"), total))}).query("n > 0")

    parts = rows.mapInPandas(task, "cell int, n double, north double, east double, squares double")
    found = parts.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "north", "east", "squares")]).toPandas()
    sums = np.zeros((2 * k, 4))
    sums[found["cell"].to_numpy(np.int64)] = found[["n", "north", "east", "squares"]].to_numpy(np.float64)
    return sums.reshape(2, k, 4)


def changeable(rows: DataFrame, zones: ZoneModel, reach: float) -> DataFrame:
    """The rows that ``zone_sums`` counts as the others."""
    centres, factor = np.array(zones.centroids), zones.longitude_factor

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lat, lon = batch["pickup_latitude"].to_numpy(np.float64), batch["pickup_longitude"].to_numpy(np.float64)
            keep = [_may_change(lead, reach) for _, _, lead in _nearest(lat, lon, centres, factor)]
            if keep:
                yield batch[np.concatenate(keep)]

    return rows.mapInPandas(task, "pickup_latitude double, pickup_longitude double")


def settled(points: DataFrame, zones: ZoneModel) -> ZoneModel:
    """Move every centre to the mean of its rows until none moves; a centre without rows stays. One aggregate to k rows a pass.

    Every pass lowers the inertia, so it ends. Most rows are far from any border: a pass over all rows adds up those that keep their zone
    while no centre is farther than ``reach`` from where it was, and only the others are read again until one is. The results are those of
    passes over all rows.
    """
    rows = known_points(points.select(*[F.col(c).cast("double").alias(c) for c in ("pickup_latitude", "pickup_longitude")]))
    factor, reach = zones.longitude_factor, 0.0

    def moved(sums: np.ndarray) -> tuple[ZoneModel, float, float]:
        """The centres at the means, the longest way a coordinate went, the root mean square distance."""
        old, n = np.array(zones.centroids), sums[:, 0]
        has = n > 0
        offset = sums[has, 1:3] / n[has, None]
        new = old.copy()
        new[has] = old[0] + offset
        inertia = float((sums[has, 3] - n[has] * (offset[:, 0] ** 2 + (offset[:, 1] * factor) ** 2)).clip(0.0).sum())
        model = ZoneModel(tuple((float(a), float(b)) for a, b in new), factor, inertia)
        return model, float(abs(new - old).max()), math.sqrt(inertia / n.sum())

    def shifted(sums: np.ndarray, by: np.ndarray) -> np.ndarray:
        """The same sums with offsets from an origin that lies ``by`` farther north and east."""
        n, north, east, squares = sums.T
        return np.stack([n, north - n * by[0], east - n * by[1], squares - 2 * (north * by[0] + east * by[1] * factor**2)
                         + n * (by[0] ** 2 + (by[1] * factor) ** 2)], axis=1)

    while True:
        base = zones
        sure, others = zone_sums(rows, base, reach)
        if not (sure[:, 0] + others[:, 0]).any():
            return zones
        zones, way, width = moved(sure + others)
        if way < 1e-9:
            return zones
        few = changeable(rows, base, reach).persist() if reach else None
        try:
            while few is not None and np.hypot(*((np.array(zones.centroids) - base.centroids) * [1, factor]).T).max() <= reach:
                origin = np.subtract(zones.centroids[0], base.centroids[0])
                zones, way, width = moved(shifted(sure, origin) + zone_sums(few, zones).sum(axis=0))
                if way < 1e-9:
                    return zones
        finally:
            if few is not None:
                few.unpersist()
        # A wide reach is left seldom but leaves many rows to read again.
        reach = math.sqrt(2 * way * width)


def silhouette(spark: SparkSession, points: DataFrame, label: str = "pickup_zone", most: int = SILHOUETTE_ROWS) -> float:
    """Mean silhouette with plain Euclidean distances over (north, east, label).

    Distances from every point to every other are needed, so the operator takes a sample of at most
    ``most`` points. That sample is what every task receives; distances are added up per
    cluster inside the task and never become rows.
    """
    sample = points.select("north", "east", label).limit(most + 1).toPandas()
    if len(sample) > most:
        raise ValueError(f"silhouette takes at most {most} points; sample first")
    codes, labels = pd.factorize(sample[label], sort=True)
    if not 2 <= len(labels) < len(sample):
        raise ValueError("a silhouette needs between 2 and n-1 clusters")
    xy, sizes = sample[["north", "east"]].to_numpy(float), np.bincount(codes)
    shared = spark.sparkContext.broadcast((xy, codes, sizes))

    def widths(batches):
        everyone, cluster, size = shared.value
        order = np.argsort(cluster, kind="stable")
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        for batch in batches:
            for part in np.array_split(batch["place"].to_numpy(), max(1, len(batch) // 256)):
                if not len(part):
                    continue
                gap = np.sqrt(((everyone[part][:, None, :] - everyone[order][None, :, :]) ** 2).sum(axis=2))
                total = np.add.reduceat(gap, starts, axis=1)
                own = cluster[part]
                rows = np.arange(len(part))
                alone = size[own] == 1
                inside = total[rows, own] / np.maximum(size[own] - 1, 1)
                mean = total / size
                mean[rows, own] = np.inf
                outside = mean.min(axis=1)
                width = (outside - inside) / np.maximum(np.maximum(inside, outside), 1e-300)
                yield pd.DataFrame({"width": np.where(alone, 0.0, width)})

    places = spark.range(len(sample)).select(F.col("id").alias("place"))
    return float(places.mapInPandas(widths, "width double").agg(F.avg("width")).first()[0])


def silhouette_of_all(points: DataFrame, label: str = "pickup_zone") -> DataFrame:
    """(n, silhouette): the mean silhouette of all points by squared Euclidean distances over (north, east, label).

    The mean squared distance of a point to a cluster is its squared distance to the cluster's centre plus the cluster's variance, so
    one aggregate to a row per cluster and one pass over the points do; no two points meet. A point alone in its cluster counts 0.
    """
    known = points.filter(F.col(label).isNotNull() & F.col("north").isNotNull() & F.col("east").isNotNull())
    clusters = known.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.avg("north").alias("north"), F.avg("east").alias("east"),
        (F.var_pop("north") + F.var_pop("east")).alias("spread")).orderBy(label).collect()
    if len(clusters) < 2:
        raise ValueError("a silhouette needs two clusters or more")

    def distance(c) -> Column:
        return (F.col("north") - c["north"]) ** 2 + (F.col("east") - c["east"]) ** 2 + F.lit(c["spread"])

    inside, outside = F.lit(None).cast("double"), []
    for c in clusters:
        own = F.col(label) == c[label]
        # A point is no distance from itself: the mean is over the others.
        inside = F.when(own, distance(c) * (c["n"] / (c["n"] - 1)) if c["n"] > 1 else F.lit(None).cast("double")).otherwise(inside)
        outside.append(F.when(~own, distance(c)))
    pair = known.select(inside.alias("a"), F.least(*outside).alias("b"))
    width = F.when(F.col("a").isNull(), 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return pair.agg(F.count(F.lit(1)).alias("n"), F.avg(width).alias("silhouette"))


def sweep_zones(
    df: DataFrame, k_values: Sequence[int], key: str = "id", sample: int = 100_000, seed: int = params.SEED,
    inits: int = params.ZONE_INITS, iterations: int = 300, silhouette_rows: int | None = SILHOUETTE_ROWS,
) -> DataFrame:
    """(k, inertia, silhouette) for choosing the number of zones: fitted on a seeded sample, the silhouette on one of that.

    ``silhouette_rows`` None: the silhouette of all rows of ``df`` by squared distances instead of plain ones of a sample.
    """
    spark = df.sparkSession
    drawn = stage(sample_rows(df.select(key, "pickup_latitude", "pickup_longitude"), sample, key, seed), "zone-sample")
    few = df if silhouette_rows is None else sample_rows(drawn, silhouette_rows, key, seed + 1)
    rows = []
    for k in k_values:
        zones = fit_zones(drawn, k, seed, inits, iterations)
        labelled = assign_zone(few, zones).select(
            F.col("pickup_latitude").alias("north"),
            (F.col("pickup_longitude") * F.lit(zones.longitude_factor)).alias("east"),
            "pickup_zone",
        )
        found = silhouette_of_all(labelled).first()["silhouette"] if silhouette_rows is None else silhouette(spark, labelled, most=silhouette_rows)
        rows.append((int(k), zones.inertia, found))
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")
