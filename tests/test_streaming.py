from pyspark.sql import functions as F

from meterlark.operators.zones import ZoneModel
from meterlark.streaming.history import _batches, keep_history, kept_history, read_batches, read_scores, score_with_history, upsert_hours
from meterlark.streaming.requests import hourly_counts

ZONES = ZoneModel(((40.7, -74.0), (40.9, -73.8)), 0.757)
TRIPS = "pickup_datetime timestamp_ntz, pickup_latitude double, pickup_longitude double"


def hours_of(spark, rows):
    """Counts from (zone, hour of the first of January, count)."""
    df = spark.createDataFrame([(z, f"2024-01-01 {h:02d}:00:00", n) for z, h, n in rows], "pickup_zone int, t string, pickup_count long")
    return df.select("pickup_zone", F.col("t").cast("timestamp_ntz").alias("hour"), "pickup_count")


def table(df):
    return sorted((r["pickup_zone"], r["hour"].hour, r["pickup_count"]) for r in df.collect())


def test_a_replayed_batch_changes_nothing_and_later_ones_win(spark, tmp_path):
    folder = str(tmp_path / "history")
    assert kept_history(spark, folder, 2).count() == 0
    upsert_hours(hours_of(spark, [(0, 1, 5), (1, 3, 2)]), 0, folder)
    first = table(kept_history(spark, folder, 2))
    assert first == [(0, 1, 5), (0, 2, 0), (0, 3, 0), (1, 1, 0), (1, 2, 0), (1, 3, 2)]
    upsert_hours(hours_of(spark, [(0, 1, 5), (1, 3, 2)]), 0, folder)
    assert table(kept_history(spark, folder, 2)) == first
    upsert_hours(hours_of(spark, [(0, 1, 7), (0, 4, 1)]), 1, folder)
    assert (0, 1, 7) in table(kept_history(spark, folder, 2)) and len(table(kept_history(spark, folder, 2))) == 8
    upsert_hours(hours_of(spark, []), 2, folder)
    assert len(table(kept_history(spark, folder, 2))) == 8


def test_merged_batches_hold_all_and_may_be_replayed(spark, tmp_path):
    folder = str(tmp_path / "history")
    for batch in range(9):
        rows = hours_of(spark, [(0, batch, batch + 1), (1, 0, batch + 1)])
        upsert_hours(rows, batch, folder, merge_every=3)
        once = table(read_batches(spark, folder).drop("batch"))
        upsert_hours(rows, batch, folder, merge_every=3)  # as after a failure before the commit
        assert table(read_batches(spark, folder).drop("batch")) == once
        assert len(_batches(spark, folder)) <= 2 * 3
        kept = table(kept_history(spark, folder, 2))
        assert [n for z, _, n in kept if z == 0] == list(range(1, batch + 2)) and (1, 0, batch + 1) in kept
    assert _batches(spark, folder) == [5, 6, 7, 8]


def test_a_stream_keeps_the_history_through_a_restart(spark, tmp_path):
    """The last batch is replayed where its commit is missing; later files go on in the same table."""
    source, folder, state = tmp_path / "in", str(tmp_path / "history"), tmp_path / "state"

    def write(part, times):
        rows = [(f"2024-01-01 {t}:00", 40.7, -74.0) for t in times]
        df = spark.createDataFrame(rows, "t string, pickup_latitude double, pickup_longitude double")
        df = df.select(F.col("t").cast("timestamp_ntz").alias("pickup_datetime"), "pickup_latitude", "pickup_longitude")
        df.coalesce(1).write.parquet(str(source / f"part={part}"))

    def run():
        stream = spark.readStream.schema(TRIPS).option("maxFilesPerTrigger", 1).parquet(f"{source}/part=*")
        keep_history(hourly_counts(stream, ZONES), folder, str(state), merge_every=2).awaitTermination()
        return table(kept_history(spark, folder, 2))

    write(0, ["10:05", "10:50", "11:10"])
    write(1, ["10:59", "14:30"])
    first = run()
    assert (0, 10, 3) in first and (0, 11, 1) in first and all(h <= 11 for _, h, _ in first)
    last = max((state / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert run() == first
    write(2, ["20:00"])
    assert (0, 14, 1) in run()


def test_scores_follow_the_history_of_their_batch(spark, tmp_path):
    """A batch sees hours that closed after the stream had started; a restart writes no row twice."""
    folder, source = str(tmp_path / "history"), str(tmp_path / "in")
    for part in range(3):
        spark.createDataFrame([(part,)], "request_id long").coalesce(1).write.parquet(f"{source}/part={part}")
    stream = spark.readStream.schema("request_id long").option("maxFilesPerTrigger", 1).parquet(f"{source}/part=*")

    def history():
        known = kept_history(spark, folder, 1)
        upsert_hours(hours_of(spark, [(0, known.count(), 1)]), known.count(), folder)  # another hour closes meanwhile
        return kept_history(spark, folder, 1)

    def score(df, known):
        return df.crossJoin(known.agg(F.count(F.lit(1)).alias("hours")))

    for _ in range(2):
        score_with_history(stream, score, history, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted(r["hours"] for r in read_scores(spark, str(tmp_path / "out")).collect()) == [1, 2, 3]
