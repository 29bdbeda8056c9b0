import pytest
from pyspark.sql import functions as F

from trip_rows import RAW
from meterlark.errors import DataValidationError
from meterlark.operators import cleaning
from meterlark.sources import tables, trips


def write(path, text):
    path.write_text(text)
    return str(path)


HEADER = ("id,vendor_id,pickup_datetime,dropoff_datetime,passenger_count,pickup_longitude,pickup_latitude,"
          "dropoff_longitude,dropoff_latitude,store_and_fwd_flag,trip_duration")
LINE = "{},2,2016-03-14 17:24:55,2016-03-14 17:32:30,1,-73.98,40.76,-73.96,40.77,N,455"


def test_csv_types_and_order(spark, tmp_path):
    path = write(tmp_path / "t.csv", "\n".join([HEADER + ",extra"] + [LINE.format(i) + ",x" for i in ("b", "a", "b")]))
    df = trips.read_trips_csv(spark, path)
    assert dict(df.dtypes)["pickup_datetime"] == "timestamp_ntz" and dict(df.dtypes)["vendor_id"] == "string" and "extra" in df.columns
    kept = cleaning.clean_trips(df).select("id").collect()
    assert sorted(r["id"] for r in kept) == ["a", "b"]


def test_csv_columns_may_come_in_any_order(spark, tmp_path):
    names = HEADER.split(",")
    path = write(tmp_path / "t.csv", ",".join(reversed(names)) + "\n" + ",".join(reversed(LINE.format("a").split(","))))
    row = trips.read_trips_csv(spark, path).first()
    assert row["id"] == "a" and row["trip_duration"] == 455


def test_keep_first_follows_the_file(spark, tmp_path):
    lines = [LINE.format("same").replace(",1,-73.98", f",{1 + i % 6},-73.98") for i in range(4000)]
    path = write(tmp_path / "t.csv", "\n".join([HEADER] + lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        df = trips.read_trips_csv(spark, path)
        assert df.rdd.getNumPartitions() > 3
        assert [r["passenger_count"] for r in cleaning.clean_trips(df).collect()] == [1]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_errors(spark, tmp_path):
    with pytest.raises(DataValidationError, match="no data"):
        trips.read_trips_csv(spark, str(tmp_path / "none.csv"))
    short = write(tmp_path / "short.csv", "id,vendor_id\n1,2")
    with pytest.raises(DataValidationError, match="pickup_datetime.*trip_duration"):
        trips.read_trips_csv(spark, short)
    bad = write(tmp_path / "bad.csv", HEADER + "\n" + LINE.format("a").replace("2016-03-14 17:24:55", "yesterday"))
    with pytest.raises(Exception, match="MALFORMED|parse|FAILED"):
        trips.read_trips_csv(spark, bad).collect()


def test_parquet_and_partitioned_stage(spark, trip, tmp_path):
    df = spark.createDataFrame([trip(1), trip(2, pickup_latitude=float("nan"))], RAW)
    trips.write_stage(df.withColumn("day", F.to_date("pickup_datetime")), str(tmp_path / "s"), "day")
    assert trips.read_stage(spark, str(tmp_path / "s")).filter("day = '2024-01-01'").count() == 2
    trips.write_stage(df.drop("row_seq"), str(tmp_path / "p"))
    back = trips.read_trips_parquet(spark, str(tmp_path / "p"))
    assert back.filter("pickup_latitude IS NULL").count() == 1 and "row_seq" in back.columns


def test_request_json(spark):
    lines = spark.createDataFrame([('{"request_id": 1, "pickup_datetime": "2024-01-01T10:00:00", "zone_id": 4}',), ("not json",)], "value string")
    rows = tables.parse_requests(lines).collect()
    assert rows[0]["zone_id"] == 4 and rows[0]["pickup_datetime"].hour == 10 and rows[1]["request_id"] is None


def test_metric_table(spark, tmp_path):
    with pytest.raises(DataValidationError, match="train_demand"):
        tables.read_metric_table(spark, str(tmp_path / "none"), "train_demand")
    table = spark.createDataFrame([("a", 1.0, 3.0), ("b", 2.0, 2.0)], "model string, mae double, rmse double")
    tables.write_csv(table, str(tmp_path / "m"))
    assert [r["model"] for r in tables.read_metric_table(spark, str(tmp_path / "m"), "x").collect()] == ["b", "a"]
