import numpy as np
import pytest

from meterlark.operators import metrics


def frame(spark, rows):
    return spark.createDataFrame(rows, "model string, y_true double, y_pred double")


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(0)
    y, p = rng.random(500) * 100 + 1, rng.random(500) * 100
    row = metrics.regression_metrics(frame(spark, [("m", float(a), float(b)) for a, b in zip(y, p)]).repartition(5)).first()
    assert row["mae"] == pytest.approx(np.abs(y - p).mean())
    assert row["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert row["mape"] == pytest.approx((np.abs(y - p) / y).mean())
    assert row["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_zero_truth(spark):
    rows = frame(spark, [("m", 0.0, 1.0), ("m", 0.0, 0.0)])
    assert metrics.mape_nonzero(rows).first()["mape_nonzero_only"] is None
    assert metrics.regression_metrics(rows).first()["mape"] > 1e14


def test_constant_truth(spark):
    rows = frame(spark, [("hit", 2.0, 2.0), ("hit", 2.0, 2.0), ("miss", 2.0, 3.0), ("miss", 2.0, 2.0)])
    assert {r["model"]: r["r2"] for r in metrics.regression_metrics(rows).collect()} == {"hit": 1.0, "miss": 0.0}


TABLE = [("a", 1.0, 3.0, 0.1, 0.5), ("b", 2.0, 2.0, 0.2, 0.9)]
SCHEMA = "model string, mae double, rmse double, mape double, r2 double"


def test_tables(spark):
    table = spark.createDataFrame(TABLE, SCHEMA)
    assert metrics.best_model(table).first()["model"] == "b"
    assert [r["model"] for r in metrics.rank_models(table, "mae").orderBy("position").collect()] == ["a", "b"]
    assert [r["model"] for r in metrics.rank_models(table, "r2").orderBy("position").collect()] == ["b", "a"]
    with pytest.raises(ValueError, match="speed"):
        metrics.rank_models(table, "speed")
    merged = metrics.upsert_model(table, spark.createDataFrame([("b", 9.0, 9.0, 9.0, 0.0), ("c", 0.0, 1.0, 0.0, 1.0)], SCHEMA))
    assert [(r["model"], r["rmse"]) for r in merged.collect()] == [("c", 1.0), ("a", 3.0), ("b", 9.0)]


def test_drift(spark):
    saved = spark.createDataFrame(TABLE, SCHEMA)
    fresh = spark.createDataFrame([("a", 1.0, 3.05, 0.1, 0.5), ("b", 2.0, 2.2, 0.2, 0.9)], SCHEMA)
    assert {r["model"]: r["drifted"] for r in metrics.drift(saved, fresh, 0.1).collect()} == {"a": False, "b": True}


def test_samples_are_exact_when_keys_repeat(spark):
    from pyspark.sql import functions as F

    from meterlark.operators.splits import sample_rows

    df = spark.range(20_000).select(F.when(F.col("id") % 100 == 0, F.col("id")).alias("key"), F.col("id").alias("row_seq"))
    for n in (0, 500, 5_000, 30_000):
        one, two = sample_rows(df, n, "key"), sample_rows(df.repartition(7), n, "key")
        assert one.count() == min(n, 20_000) and one.distinct().count() == one.count()
        assert one.exceptAll(two).count() == 0


def test_any_number_of_categories_gets_codes(spark):
    from pyspark.sql import functions as F

    from meterlark.operators.encoding import with_category_code

    df = spark.range(3_000).select("id", F.when(F.col("id") < 2_500, F.format_string("v%05d", F.col("id") % 1_500)).alias("c"))
    rows = with_category_code(df, "c").collect()
    assert all(r["c_code"] == (r["id"] % 1_500 if r["id"] < 2_500 else -1) for r in rows)
