import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlark import params
from meterlark.models import regressors
from meterlark.models.extra_trees import ExtraTrees
from meterlark.models.isolation import IsolationForest, usual_path
from meterlark.models.ridge import fit_ridge
from meterlark.models.stacking import Stacking, base_models, fit_stacking, out_of_fold
from meterlark.models.zone_fit import changeable, fit_zones, members, settled, silhouette, silhouette_of_all, zone_sums
from meterlark.operators.anomaly import flag_share, flagged_summary, top_anomalies
from meterlark.operators.encoding import category_codes
from meterlark.operators.zones import ZoneModel
from meterlark.session import stage
from meterlark.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def table(spark):
    """A label that depends on a and b, not on c."""
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("id"), (F.col("id") * 7919 % 1000 / 1000).alias("a"),
        (F.col("id") * 104729 % 997 / 997).alias("b"), (F.col("id") * 31 % 101 / 101).alias("c"),
    )
    label = F.when(F.col("a") > 0.5, 5.0).otherwise(1.0) + F.col("b")
    return stage(df.withColumn("label", label).withColumn("y_raw", F.expm1("label")).repartition(4), "table")


def test_ridge_equals_leaving_rows_out_one_by_one(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=40)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "p double, q double, r double, label double")
    model = fit_ridge(df.repartition(3), ["p", "q", "r"])

    def solve(xs, ys, alpha):
        mx, my = xs.mean(0), ys.mean()
        w = np.linalg.solve((xs - mx).T @ (xs - mx) + alpha * np.eye(3), (xs - mx).T @ (ys - my))
        return w, my - w @ mx

    for alpha, error in model.errors:
        left_out = []
        for i in range(40):
            rest = np.arange(40) != i
            w, b = solve(x[rest], y[rest], alpha)
            left_out.append((y[i] - x[i] @ w - b) ** 2)
        assert error == pytest.approx(np.mean(left_out), rel=1e-9)
    assert model.alpha == min(model.errors, key=lambda e: e[1])[0]
    w, b = solve(x, y, model.alpha)
    assert model.coefficients == pytest.approx(tuple(w)) and model.intercept == pytest.approx(b)


MAKERS = {
    "linear": regressors.linear, "forest": lambda: regressors.forest(5, 4), "extra": lambda: ExtraTrees(8, 5),
    "boosted": lambda: regressors.boosted(5, 3),
}


@pytest.mark.parametrize("kind", MAKERS)
def test_regressors_learn_and_survive_saving(spark, table, tmp_path, kind):
    columns, estimator = ["a", "b", "c"], MAKERS[kind]()
    fitted, row = regressors.train_and_evaluate(estimator, "m", table, table, columns, 0.0)
    assert row.first()["n"] == 3000
    assert fitted(table).agg(F.corr("label", "prediction")).first()[0] > 0.85
    weights = fitted.importances
    if weights:
        assert sum(w for _, w in weights) == pytest.approx(1.0)
        assert max(weights, key=lambda w: w[1])[0] == "a"
        assert regressors.importance_table(spark, fitted).first()["feature"] == "a"
    save_model(spark, fitted, str(tmp_path / "m"))
    again = load_model(spark, str(tmp_path / "m"), type(fitted))
    gap = F.abs(F.col("prediction") - F.col("p2"))
    both = again(fitted(table).withColumnRenamed("prediction", "p2")).agg(F.max(gap)).first()[0]
    assert both == 0


def test_extra_trees_do_not_depend_on_partitions_or_reads(spark, table):
    columns = ("a", "b", "c")
    one = ExtraTrees(4, 4, seed=3).fit_table(table.coalesce(1), columns)
    many = ExtraTrees(4, 4, seed=3, pairs_per_read=5).fit_table(table.repartition(7), columns)
    assert one.trees.feature == many.trees.feature
    assert all(np.allclose(a, b) for a, b in zip(one.trees.threshold, many.trees.threshold))
    assert all(np.allclose(a, b) for a, b in zip(one.trees.value, many.trees.value))
    other = ExtraTrees(4, 4, seed=4).fit_table(table, columns)
    assert other.trees.threshold != one.trees.threshold


def test_extra_trees_read_the_table_about_once_per_level(spark, table):
    model = ExtraTrees(6, 5, seed=2).fit_table(table, ("a", "b", "c"))
    # Ranges of the whole table, five levels, and the nodes that had to wait for their true range.
    assert 6 <= model.reads <= 10


def test_extra_trees_split_at_uniform_thresholds_within_the_true_range(spark):
    """Half of the rows lie in a thousandth of the box that the first split leaves: thresholds are still uniform in their range."""
    rows = [(float(i >= 500), i / 1000 if i < 500 else 500.0 + i, float(i % 7) + 50.0 * (i >= 500)) for i in range(1000)]
    df = stage(spark.createDataFrame(rows, "a double, b double, label double"), "narrow")
    trees = ExtraTrees(120, 2, seed=5).fit_table(df, ("a", "b")).trees
    inner = [
        trees.threshold[t][trees.left[t][0]] for t in range(120)
        if trees.feature[t][0] == 0 and trees.feature[t][trees.left[t][0]] == 1
    ]
    assert len(inner) > 40 and 0 <= min(inner) and max(inner) < 0.5
    assert 0.2 < np.mean(inner) < 0.3 and np.quantile(inner, 0.25) < 0.2 and np.quantile(inner, 0.75) > 0.3


def test_extra_trees_stop_at_pure_nodes(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 1.0), (1.0, 3.0)], "a double, label double")
    model = ExtraTrees(2, 6).fit_table(df, ["a"])
    assert [model.trees.size(t) for t in range(2)] == [3, 3]
    assert [r["prediction"] for r in model(df).collect()] == [1.0, 1.0, 3.0]
    unknown = model(spark.createDataFrame([(None,)], "a double")).first()
    assert unknown["prediction"] is None


def test_out_of_fold_covers_every_row_once_and_stacking_works(spark, table, tmp_path):
    bases = base_models(3, 3, 3, 2)
    held = out_of_fold(table, ["a", "b", "c"], {"linear": regressors.linear()}, folds=3)
    assert held.count() == 3000 and held.select("id").distinct().count() == 3000
    stacked = fit_stacking(table, ["a", "b", "c"], bases, folds=2)
    assert [r["base_model"] for r in stacked.meta.weights(spark).collect()] == list(bases)
    scored = regressors.predictions(stacked, table, "s", 0.0)
    assert scored.agg(F.corr("y_true", "y_pred")).first()[0] > 0.8
    save_model(spark, stacked, str(tmp_path / "s"))
    again = load_model(spark, str(tmp_path / "s"), Stacking)
    first, second = stacked(table).agg(F.sum("prediction")).first()[0], again(table).agg(F.sum("prediction")).first()[0]
    assert first == pytest.approx(second)
    with pytest.raises(TypeError):
        load_model(spark, str(tmp_path / "s"), ZoneModel)


@pytest.fixture(scope="module")
def trips(spark):
    normal = spark.range(2000).select(
        F.col("id").cast("string").alias("id"), (600 + F.col("id") % 300).alias("trip_duration"), (3 + F.col("id") % 17 / 10).alias("trip_distance_km"),
        (18 + F.col("id") % 23 / 10).alias("average_speed_kmh"), (0.7 + F.col("id") % 13 / 100).alias("route_efficiency_ratio"),
        (1 + F.col("id") % 4).cast("int").alias("passenger_count"),
    )
    odd = spark.createDataFrame([("odd", 60, 90.0, 5400.0, 0.99, 6)], normal.schema.simpleString()[7:-1].replace(":", " "))
    return stage(normal.unionByName(odd), "trips")


def test_isolation_forest(spark, trips, tmp_path):
    detector = IsolationForest(n_trees=30).fit(trips)
    scored = detector.score(trips)
    top = top_anomalies(scored, 3).collect()
    assert top[0]["id"] == "odd" and top[0]["is_anomaly"]
    ends = scored.agg(F.min("anomaly_score_raw"), F.max("anomaly_score_raw"), F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert 0 < ends[0] and ends[1] < 1 and ends[2] == 0 and ends[3] == pytest.approx(1, abs=1e-3)
    assert abs(flag_share(scored).first()["share"] - 0.02) < 0.01
    again = IsolationForest(n_trees=30).fit(trips.repartition(6))
    assert again.trees == detector.trees and again.scale == detector.scale
    save_model(spark, detector, str(tmp_path / "d"))
    loaded = load_model(spark, str(tmp_path / "d"), IsolationForest)
    assert loaded.scale == detector.scale
    assert loaded.score(trips).agg(F.sum("anomaly_score")).first() == scored.agg(F.sum("anomaly_score")).first()


def test_summary_of_an_empty_group(spark, trips):
    rows = flagged_summary(trips.withColumn("is_anomaly", F.lit(False))).collect()
    assert [r["feature"] for r in rows] == list(params.ANOMALY_FEATURES) and all(r["mean_flagged"] is None for r in rows)


def test_usual_path():
    assert usual_path(1) == 0 and usual_path(2) == 1
    assert usual_path(256) == pytest.approx(2 * (math.log(255) + 0.5772156649015329) - 2 * 255 / 256)


def test_silhouette_against_brute_force(spark):
    rng = np.random.default_rng(1)
    xy, label = rng.normal(size=(300, 2)), rng.integers(0, 4, 300)
    label[0] = 9  # a cluster of one has width zero
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(xy, label)], "north double, east double, pickup_zone int")
    gaps = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(-1))
    widths = []
    for i in range(300):
        own = (label == label[i]) & (np.arange(300) != i)
        if not own.any():
            widths.append(0.0)
            continue
        a = gaps[i, own].mean()
        b = min(gaps[i, label == c].mean() for c in set(label) - {label[i]})
        widths.append((b - a) / max(a, b))
    assert silhouette(spark, df) == pytest.approx(np.mean(widths))


def test_zones_find_separate_clusters(spark, tmp_path):
    df = spark.range(900).select(
        (40.5 + F.col("id") % 3 / 5 + F.col("id") % 7 / 1000).alias("pickup_latitude"), (-74 + F.col("id") % 3 / 5 + F.col("id") % 11 / 1000).alias("pickup_longitude"))
    zones = fit_zones(df, 3, inits=3)
    assert sorted(round(a, 1) for a, _ in zones.centroids) == [40.5, 40.7, 40.9] and zones.inertia < 1
    save_model(spark, zones, str(tmp_path / "z"))
    assert load_model(spark, str(tmp_path / "z"), ZoneModel) == zones


def test_settled_centres_are_the_means_of_their_rows(spark):
    rng = np.random.default_rng(7)
    places = np.concatenate([rng.normal(c, 0.02, size=(60, 2)) for c in ((40.6, -74.0), (40.8, -73.9), (40.7, -73.8))])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in places] + [(None, -74.0), (float("nan"), -74.0)], "pickup_latitude double, pickup_longitude double")
    start, factor = ((40.65, -73.95), (40.75, -73.95), (40.7, -73.7), (10.0, 10.0)), 0.75
    zones = settled(df, ZoneModel(start, factor))
    straight = places * [1, factor]
    centres = np.array(start) * [1, factor]
    for _ in range(100):
        nearest = ((straight[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([straight[nearest == z].mean(axis=0) if (nearest == z).any() else centres[z] for z in range(4)])
    assert np.allclose(np.array(zones.centroids) * [1, factor], centres, atol=1e-8)
    assert zones.centroids[3] == (10.0, 10.0)  # without rows it stays
    assert math.isclose(zones.inertia, ((straight - centres[nearest]) ** 2).sum(), rel_tol=1e-6)
    assert settled(df.limit(0), ZoneModel(start, factor)).centroids == start


def test_silhouette_of_all_points_equals_all_pairs(spark):
    rng = np.random.default_rng(2)
    xy = np.concatenate([rng.normal(c, 0.4, size=(25, 2)) for c in ((0, 0), (2, 1), (5, 5))] + [[[9.0, 9.0]]])
    zone = [0] * 25 + [1] * 25 + [2] * 25 + [3]
    df = spark.createDataFrame([(float(x), float(y), z) for (x, y), z in zip(xy, zone)] + [(None, 1.0, 0), (1.0, 1.0, None)], "north double, east double, pickup_zone int")
    gap, z, widths = ((xy[:, None] - xy[None]) ** 2).sum(axis=2), np.array(zone), []
    for i in range(len(xy)):
        own = (z == z[i]) & (np.arange(len(xy)) != i)
        a, b = (gap[i][own].mean() if own.any() else None), min(gap[i][z == k].mean() for k in set(zone) - {zone[i]})
        widths.append(0.0 if a is None else (b - a) / max(a, b))
    row = silhouette_of_all(df).first()
    assert row["n"] == len(xy) and row["silhouette"] == pytest.approx(np.mean(widths))


def test_many_categories_are_numbered_in_order(spark):
    n = 200_000
    df = spark.range(n).select(F.concat(F.lit("c"), F.lpad((F.col("id") * 7919 % n).cast("string"), 7, "0")).alias("v"))
    codes = category_codes(df.unionByName(df).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS v")), "v")
    wrong = codes.filter(F.substring("value", 2, 7).cast("long") != F.col("code")).count()
    assert codes.count() == n and wrong == 0
    assert category_codes(df.limit(0), "v").count() == 0


def test_zones_settle_however_many_passes_it_takes(spark):
    """The centres must be the means of their rows, also where fifty passes do not settle them."""
    rng = np.random.default_rng(3)
    east = np.sort(rng.random(1500) ** 2)
    df = spark.createDataFrame([(40.5, float(-74 + e)) for e in east], "pickup_latitude double, pickup_longitude double").coalesce(1)
    start, factor = tuple((40.5, -74 + 0.01 * z) for z in range(6)), 0.75
    zones = settled(df, ZoneModel(start, factor))
    place = np.array([b for _, b in zones.centroids])
    nearest = abs((-74 + east)[:, None] - place).argmin(axis=1)
    means = np.array([(-74 + east)[nearest == z].mean() for z in range(6)])
    assert abs(place - means).max() < 1e-8
    assert math.isclose(zones.inertia, float((((-74 + east) - means[nearest]) ** 2).sum() * factor**2), rel_tol=1e-9)


def test_rows_that_keep_their_zone_are_not_read_again(spark):
    rng = np.random.default_rng(4)
    places = rng.random((2000, 2))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in places], "pickup_latitude double, pickup_longitude double")
    zones, reach = ZoneModel(((0.2, 0.3), (0.7, 0.2), (0.6, 0.8)), 0.8), 0.03
    sure, others = zone_sums(df, zones, reach)
    few = changeable(df, zones, reach)
    assert 0 < few.count() == others[:, 0].sum() < 1000 and sure[:, 0].sum() + others[:, 0].sum() == 2000
    kept = {tuple(map(float, p)) for p in places} - {tuple(r) for r in few.collect()}
    straight, old = np.array(sorted(kept)) * [1, 0.8], np.array(zones.centroids) * [1, 0.8]
    first = ((straight[:, None] - old) ** 2).sum(axis=2).argmin(axis=1)
    for _ in range(20):
        step = rng.normal(size=old.shape)
        new = old + reach * step / np.linalg.norm(step, axis=1, keepdims=True)
        assert (((straight[:, None] - new) ** 2).sum(axis=2).argmin(axis=1) == first).all()


def test_zone_members_do_not_filter_on_the_zone(spark):
    df = spark.createDataFrame([(0.1, 0.1), (0.9, 0.8), (None, 0.1), (0.2, float("inf"))], "pickup_latitude double, pickup_longitude double")
    found = members(df, ZoneModel(((0.0, 0.0), (1.0, 1.0)), 0.8))
    assert [(r["pickup_zone"], r["n"]) for r in found.orderBy("pickup_zone").collect()] == [(0, 1), (1, 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not any("array_min" in line for line in plan.splitlines() if "Filter" in line)
