from pyspark.sql import functions as F

from meterlark.models import regressors
from meterlark.models.extra_trees import ExtraTrees
from meterlark.models.stacking import base_models
from meterlark.operators.encoding import duration_matrix
from meterlark.operators.zones import ZoneModel
from meterlark.plans import jobs, report, scoring
from meterlark.sources.event_trips import load_trips, requests_from_trips
from meterlark.sources.models import load_model
from meterlark.sources.tables import read_metric_table
from meterlark.sources.trips import read_stage
from meterlark.streaming.requests import hourly_counts, score_stream


def test_from_raw_trips_to_unified_scores(spark, sf_dir, tmp_path):
    """All jobs in order on small settings, then the report, then batch and stream scoring."""
    work = str(tmp_path / "work")
    raw = load_trips(spark, sf_dir)
    jobs.prepare(spark, raw, work)
    jobs.train_zones(spark, work, 6, inits=1, iterations=10)
    jobs.build_demand(spark, work, 6)
    jobs.train_durations(
        spark, work, {"linear_regression": regressors.linear(), "extra_trees": ExtraTrees(2, 2)}, base_models(2, 2, 2, 2)
    )
    jobs.train_demand(spark, work, {"linear_regression": regressors.linear(), "boosted_trees": regressors.boosted(2, 2)}, 6)
    detector = jobs.train_anomalies(spark, work, n_trees=10)

    saved = read_metric_table(spark, f"{work}/models/duration_comparison", "train_durations")
    assert {r["model"] for r in saved.collect()} == {"linear_regression", "extra_trees", "stacking_ensemble"}
    models = {n: load_model(spark, f"{work}/models/duration/{n}") for n in ("linear_regression", "extra_trees", "stacking_ensemble")}
    features = read_stage(spark, f"{work}/train_features")
    tables = report.evaluate_duration(duration_matrix(features), saved, models, sample=50)
    assert not tables["drift"].first()["drifted"] and tables["residuals"].count() == 50

    demand_saved = read_metric_table(spark, f"{work}/models/demand_comparison", "train_demand")
    demand_models = {n: load_model(spark, f"{work}/models/demand/{n}") for n in ("linear_regression", "boosted_trees")}
    history = read_stage(spark, f"{work}/demand_hourly")
    demand_tables = report.evaluate_demand(history, demand_saved, demand_models, 6, sample=40)
    assert not demand_tables["drift"].first()["drifted"]
    lines = report.summary(tables["winner"], demand_tables["winner"]).collect()
    assert len(lines) == 7
    top = spark.read.option("header", True).csv(f"{work}/reports/top_20_flagged_trips")
    assert top.count() == 20

    zones = load_model(spark, f"{work}/models/zones", ZoneModel)
    counts = history.select("pickup_zone", "hour", "pickup_count")

    def score(df):
        return scoring.score_unified(df, zones, counts, models["stacking_ensemble"], demand_models["boosted_trees"], detector.score)

    requests = requests_from_trips(raw)
    batch = score(requests)
    assert batch.count() == 1000
    assert batch.filter("duration IS NOT NULL").count() > 900 and batch.filter("anomaly IS NOT NULL").count() > 300
    assert batch.filter("duration.predicted_duration_seconds < 10").count() == 0

    # The same from the saved artifacts alone, with the demand model that won.
    again = jobs.score_requests(spark, work, requests)
    parts = ["request_id", "request_mode", "duration", "anomaly"]
    assert again.select(parts).exceptAll(batch.select(parts)).count() == 0 and again.count() == 1000
    jobs.report(spark, work, 6, sample=30)
    assert read_stage(spark, f"{work}/reports/demand_residual_sample").count() == 30
    assert spark.read.option("header", True).csv(f"{work}/reports/pipeline_metrics").count() == 7
    drift = spark.read.option("header", True).csv(f"{work}/reports/duration_drift").first()
    assert drift["drifted"] == "false"

    requests.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(requests.schema).parquet(str(tmp_path / "in"))
    score_stream(stream, score, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    text = ["request_id", "request_mode", "operational_insight"]
    assert streamed.select(text).exceptAll(batch.select(text)).count() == 0 and streamed.count() == 1000


def test_stream_counts_close_hours(spark, tmp_path):
    """Hours are emitted once, after the watermark passed them; late trips within it are counted."""
    zones = ZoneModel(((40.7, -74.0), (40.9, -73.8)), 0.757)
    schema = "pickup_datetime timestamp_ntz, pickup_latitude double, pickup_longitude double"
    times = [["10:05", "10:50", "11:10"], ["10:59", "14:30"], ["15:00"]]
    for i, batch in enumerate(times):
        rows = [(f"2024-01-01 {t}:00", 40.7, -74.0) for t in batch]
        df = spark.createDataFrame(rows, "t string, pickup_latitude double, pickup_longitude double")
        df = df.select(F.col("t").cast("timestamp_ntz").alias("pickup_datetime"), "pickup_latitude", "pickup_longitude")
        df.coalesce(1).write.parquet(str(tmp_path / "in" / f"part={i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "part=*"))
    score_stream(stream, lambda df: hourly_counts(df, zones), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    rows = {r["hour"].hour: r["pickup_count"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows[10] == 3 and rows[11] == 1 and 15 not in rows
