from datetime import datetime, timedelta

from pyspark.sql import functions as F

from trip_rows import RAW
from meterlark.operators import cleaning

AT = datetime(2024, 1, 1, 8, 30)


def ids(df):
    return sorted(r["id"] or "" for r in df.select("id").collect())


def test_each_rule_and_its_edges(spark, trip):
    rows = [
        trip(1),
        trip(2, dropoff_datetime=AT + timedelta(seconds=601)),  # one second off is fine
        trip(3, dropoff_datetime=AT + timedelta(seconds=602)),
        trip(4, trip_duration=9, dropoff_datetime=AT + timedelta(seconds=9)),
        trip(5, trip_duration=10, dropoff_datetime=AT + timedelta(seconds=10)),
        trip(6, trip_duration=None),
        trip(7, pickup_latitude=40.4),
        trip(8, pickup_latitude=41.01),
        trip(9, pickup_longitude=None),
        trip(10, dropoff_longitude=-73.59),
        trip(11, passenger_count=0),
        trip(12, passenger_count=7),
        trip(13, passenger_count=-1),  # kept by cleaning
        trip(14, passenger_count=None),
        trip(15, pickup_datetime=None),
        trip(16, pickup_latitude=float("nan")),
    ]
    df = spark.createDataFrame(rows, RAW)
    kept, report = cleaning.clean_trip_data(df)
    assert ids(kept) == sorted(["t1", "t2", "t5", "t7", "t13"])
    found = report.first().asDict()
    assert found == {
        "rows_initial": 16, "duplicate_ids": 0, "duration_mismatch": 1, "duration_out_of_bounds": 2,
        "pickup_out_of_bounds": 3, "dropoff_out_of_bounds": 1, "invalid_passenger_count": 2,
        "missing_critical_values": 2, "rows_final": 5, "rows_removed_total": 11, "pct_removed": 11 / 16, "removal_warning": True,
    }


def test_first_copy_decides_even_when_it_is_bad(spark, trip):
    rows = [trip(3, id="a"), trip(1, id="a", passenger_count=0), trip(2, id="a"), trip(4, id="b"), trip(5, id="b", vendor_id="2")]
    kept, report = cleaning.clean_trip_data(spark.createDataFrame(rows, RAW).repartition(4))
    assert [(r["id"], r["row_seq"]) for r in kept.collect()] == [("b", 4)]
    row = report.first()
    assert (row["duplicate_ids"], row["invalid_passenger_count"], row["rows_final"]) == (3, 1, 1)


def test_null_ids_equal_each_other(spark, trip):
    rows = [trip(i, id=None) for i in range(1, 6)] + [trip(9)]
    kept, report = cleaning.clean_trip_data(spark.createDataFrame(rows, RAW))
    assert sorted(r["row_seq"] for r in kept.collect()) == [1, 9]
    assert report.first()["duplicate_ids"] == 4


def test_one_id_with_a_third_of_the_rows(spark, trip):
    base = spark.createDataFrame([trip(0)], RAW).drop("row_seq", "id")
    many = spark.range(30_000).withColumnRenamed("id", "row_seq").join(F.broadcast(base))
    many = many.withColumn("id", F.when(F.col("row_seq") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "row_seq")))
    row = cleaning.cleaning_report(many).first()
    assert (row["rows_initial"], row["duplicate_ids"], row["rows_final"]) == (30_000, 9_999, 20_001)
    kept = cleaning.clean_trips(many)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # Ids are summed per task before they are shuffled, with hash aggregates only.
    assert "partial_min" in plan and "SortAggregate" not in plan and "Window" not in plan
    assert kept.count() == 20_001 and kept.filter("id = 'hot'").first()["row_seq"] == 0


def test_equal_and_missing_places(spark, trip):
    rows = [trip(1, id="a", vendor_id="2"), trip(1, id="a"), trip(1, id="a"), trip(None, id="b"), trip(5, id="b"), trip(None, id="c"), trip(None, id="c")]
    rows += [trip(None, id=None), trip(7, id=None)]
    df = spark.createDataFrame(rows, RAW)
    for parts in (1, 5):
        kept, report = cleaning.clean_trip_data(df.repartition(parts))
        found = {r["id"]: (r["row_seq"], r["vendor_id"]) for r in kept.collect()}
        assert kept.count() == 4 and found["b"] == (5, "1") and found["c"] == (None, "1") and found[None] == (7, "1")
        assert found["a"] == next(iter({found["a"]} & {(1, "1"), (1, "2")}))
        assert (report.first()["duplicate_ids"], report.first()["rows_final"]) == (5, 4)


def test_files_keep_their_order_however_they_are_split(spark, trip, tmp_path):
    """Every id exactly once, from CSV and Parquet, when splits change between building and running the plan."""
    from meterlark.sources import trips as files

    rows = [trip(i, id=f"t{i % 400}", passenger_count=1 + (i >= 400)) for i in range(1200)]
    df = spark.createDataFrame(rows, RAW).drop("row_seq").coalesce(1)
    df.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(f"{tmp_path}/csv")
    df.write.option("maxRecordsPerFile", 500).parquet(f"{tmp_path}/parquet")
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    try:
        for read, kind in ((files.read_trips_csv, "csv"), (files.read_trips_parquet, "parquet")):
            spark.conf.set(size, "100000000")
            raw = read(spark, f"{tmp_path}/{kind}")
            kept, report = cleaning.clean_trip_data(raw)
            assert "SortAggregate" not in kept._jdf.queryExecution().executedPlan().toString()
            spark.conf.set(size, "4000")
            found = cleaning.clean_trips(raw).select("id", "passenger_count").collect()
            assert sorted(r["id"] for r in found) == sorted(f"t{i}" for i in range(400))
            assert {r["passenger_count"] for r in found} == {1}
            assert kept.count() == 400 == report.first()["rows_final"]
    finally:
        spark.conf.set(size, before)


def test_same_result_on_any_partitioning(spark, sf_dir):
    from meterlark.sources.event_trips import load_trips

    trips = load_trips(spark, sf_dir)
    one = cleaning.clean_trips(trips.coalesce(1)).exceptAll(cleaning.clean_trips(trips.repartition(8)))
    assert one.count() == 0


def test_empty_table_has_no_share(spark):
    row = cleaning.cleaning_report(spark.createDataFrame([], RAW)).first()
    assert row["rows_initial"] == 0 and row["pct_removed"] is None and row["removal_warning"] is None


def test_own_rules_replace_the_default_ones(spark, trip):
    rules = [("vendor_two", F.col("vendor_id") == "2")]
    df = spark.createDataFrame([trip(1), trip(2, vendor_id="2"), trip(3, passenger_count=0)], RAW)
    kept, report = cleaning.clean_trip_data(df, rules)
    assert ids(kept) == ["t1", "t3"] and report.first()["vendor_two"] == 1


def test_unique_places_need_one_join_and_two_reads(spark, sf_dir):
    from meterlark.sources.event_trips import load_trips

    trips = load_trips(spark, sf_dir)
    firsts = cleaning.first_places(trips)
    kept, report = cleaning.clean_trip_data(trips, firsts=firsts)
    plain_kept, plain_report = cleaning.clean_trip_data(trips)
    assert kept.count() == plain_kept.count() and kept.exceptAll(plain_kept).count() == 0
    assert report.first() == plain_report.first()
    for df in (kept, report):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 2 and plan.count("Join ") == 1 and "decimal(38" not in plan
        # What the rules read is computed below the join: none of them derives a coordinate again.
        assert "740000" not in plan[: plan.index("Join ")]
    narrow = firsts._jdf.queryExecution().executedPlan().toString()
    assert narrow.count("ReadSchema: struct<event_id:bigint>") == narrow.count("FileScan") > 0


def test_unique_places_with_missing_ids_and_places(spark, trip):
    rows = [trip(3, id=None), trip(1, id=None), trip(None, id="a"), trip(4, id="a"), trip(9, id="b", passenger_count=0), trip(10, id="b"), trip(None, id="c")]
    df = spark.createDataFrame(rows, RAW)
    kept, report = cleaning.clean_trip_data(df.repartition(3), firsts=cleaning.first_places(df))
    assert sorted((r["id"] or "", r["row_seq"] or 0) for r in kept.collect()) == [("", 1), ("a", 4), ("c", 0)]
    row = report.first()
    assert (row["rows_initial"], row["duplicate_ids"], row["invalid_passenger_count"], row["rows_final"]) == (7, 3, 1, 3)
