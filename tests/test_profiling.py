import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlark.operators import profiling, splits
from meterlark.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.25, 0.5, 0.98, 1.0)


@pytest.mark.parametrize("values", [
    np.random.default_rng(1).normal(size=5001),
    np.random.default_rng(2).pareto(0.5, size=4000) * 1e6,
    np.concatenate([np.zeros(3000), np.random.default_rng(3).random(3000)]),
    np.array([7.0]), np.array([1.0, 2.0]), np.full(100, -3.5),
], ids=["normal", "heavy-tail", "half-ties", "single", "pair", "constant"])
@pytest.mark.parametrize("bins,few", [(16, 20), (4096, 10**6)])
def test_quantiles_are_exact(spark, values, bins, few):
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(5)
    found = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], PROBS, bins, few).collect()}
    for p in PROBS:
        assert found[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_quantiles_with_infinite_ends(spark):
    values = [float("-inf")] + [float(i % 50) for i in range(500)] + [float("inf")] * 3
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = [r["value"] for r in exact_quantiles(df, ["x"], (0.1, 0.5, 0.9), 8, 10).collect()]
    assert found == np.quantile(values, (0.1, 0.5, 0.9)).tolist()


def test_quantiles_skip_unknown_values_per_column(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, float("nan")), (None, 5.0)], "a double, b double")
    found = {r["column"]: r["value"] for r in exact_quantiles(df, ["a", "b"], [0.5]).collect()}
    assert found == {"a": 2.0, "b": 5.0}


def test_histogram_equals_numpy(spark):
    values = np.random.default_rng(5).integers(0, 1000, 3000).astype(float)
    df = spark.createDataFrame([(v,) for v in values.tolist()], "x double")
    rows = sorted(profiling.histogram(df, F.col("x"), 20).collect())
    counts, edges = np.histogram(values, 20)
    assert [r["n"] for r in rows] == counts.tolist()
    assert [r["lower"] for r in rows] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_one_value(spark):
    rows = profiling.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), F.col("x"), 4).collect()
    assert sum(r["n"] for r in rows) == 2 and min(r["lower"] for r in rows) == 1.5


def test_sample_has_exact_size_and_does_not_move(spark):
    df = spark.range(50_000).withColumnRenamed("id", "k")
    first = splits.sample_rows(df, 1000, "k").collect()
    again = splits.sample_rows(df.repartition(7), 1000, "k").collect()
    assert len(first) == 1000 and len({r["k"] for r in first}) == 1000 and sorted(first) == sorted(again)
    assert splits.sample_rows(df.filter("k < 10"), 1000, "k").count() == 10
    assert set(first) != set(splits.sample_rows(df, 1000, "k", seed=7).collect())


def test_correlation_needs_two_columns_and_uses_complete_pairs(spark):
    with pytest.raises(ValueError):
        profiling.correlation_matrix(spark.range(3))
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "a double, b double")
    found = {(r[0], r[1]): r[2] for r in profiling.correlation_matrix(df).collect()}
    assert found[("a", "b")] == pytest.approx(1.0) and len(found) == 4


def test_random_split_share_and_stability(spark):
    df = spark.range(20_000).select(F.col("id").cast("string"))
    train, test = splits.random_split(df)
    assert train.count() + test.count() == 20_000 and abs(test.count() / 20_000 - 0.2) < 0.01
    assert test.exceptAll(splits.random_split(df.repartition(9))[1]).count() == 0


def test_folds_do_not_follow_the_test_split(spark):
    df = spark.range(20_000).withColumn("fold", splits.fold_of("id", 3)).withColumn("test", splits.in_test("id"))
    shares = [r[1] for r in df.groupBy("fold").agg(F.avg(F.col("test").cast("int"))).collect()]
    assert len(shares) == 3 and all(abs(s - 0.2) < 0.02 for s in shares)
