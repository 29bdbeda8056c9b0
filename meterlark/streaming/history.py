"""An hourly history that a stream keeps: closed hours are upserted into a table that the request scorers read.

The table is a folder of small batches, ``batch=<id>``. A batch is written by overwriting its own folder, so replaying it after a
failure changes nothing, and of two batches that hold the same zone and hour the later one counts. Every ``merge_every``
batches one folder takes in all earlier ones, so their number stays bounded however long the stream runs; the folders it took in
are deleted only by the batch after it, when Spark will not replay the merging one any more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlark import params
from meterlark.operators.demand import dense_grid

COUNTS = "pickup_zone int, hour timestamp_ntz, pickup_count bigint"
MERGE_EVERY = 100


def _batches(spark: SparkSession, folder: str) -> list[int]:
    """Ids of the batch folders, ascending: at most two rounds of ``merge_every``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _latest(rows: DataFrame) -> DataFrame:
    """One row per zone and hour, of the latest batch that holds it."""
    return rows.groupBy("pickup_zone", "hour").agg(F.max_by("pickup_count", "batch").alias("pickup_count"))


def read_batches(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """(pickup_zone, hour, pickup_count, batch) of all batches, or of those before one; an absent table has no rows."""
    schema = f"{COUNTS}, batch bigint"
    ids = [b for b in _batches(spark, folder) if before is None or b < before]
    if not ids:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", folder)
    return reader.parquet(*[f"{folder}/batch={b}" for b in ids])


def upsert_hours(counts: DataFrame, batch: int, folder: str, merge_every: int = MERGE_EVERY) -> None:
    """Write one batch of (pickup_zone, hour, pickup_count); the same batch written twice leaves the same table.

    Within a batch a zone and hour must be unique, as ``hourly_counts`` emits them.
    """
    spark = counts.sparkSession
    rows = counts.select(
        F.col("pickup_zone").cast("int").alias("pickup_zone"), "hour", F.col("pickup_count").cast("bigint").alias("pickup_count"))
    if batch % merge_every == merge_every - 1:
        earlier = read_batches(spark, folder, before=batch)
        rows = _latest(earlier.unionByName(rows.withColumn("batch", F.lit(batch).cast("bigint"))))
    # A merged batch is bounded by zones x hours; adaptive execution sizes its files.
    rows.write.mode("overwrite").parquet(f"{folder}/batch={batch}")
    # The newest merging batch before this one is committed: what it took in is not read any more.
    merged = batch // merge_every * merge_every - 1
    for old in _batches(spark, folder):
        if old < merged:
            _delete(spark, f"{folder}/batch={old}")


def keep_history(
    counts: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None, merge_every: int = MERGE_EVERY
) -> StreamingQuery:
    """Upsert a stream of closed hours (``hourly_counts``) into the table; returns the running query.

    ``folder`` belongs to ``checkpoint``: batch ids start anew with another checkpoint, so a stream that starts over needs a new folder.
    """
    writer = counts.writeStream.foreachBatch(lambda batch, number: upsert_hours(batch, number, folder, merge_every))
    return writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def kept_history(spark: SparkSession, folder: str, n_zones: int = params.N_ZONES) -> DataFrame:
    """(pickup_zone, hour, pickup_count) of every zone and closed hour, zero where no trip began: what the demand scorers read.

    An hour counts as closed once it or a later one was emitted; before the first one the table is empty.
    """
    seen = _latest(read_batches(spark, folder)).filter("pickup_count > 0")
    zeros = dense_grid(seen, n_zones).withColumn("pickup_count", F.lit(0).cast("bigint"))
    return zeros.unionByName(seen).groupBy("pickup_zone", "hour").agg(F.sum("pickup_count").alias("pickup_count"))


def score_with_history(
    requests: DataFrame,
    score: Callable[[DataFrame, DataFrame], DataFrame],
    history: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score a request stream, each micro-batch against the history as it is when the batch starts; returns the running query.

    ``score(requests, history)`` is a batch scorer; a static table joined to the stream would stay as it was when the stream
    started. Each batch overwrites its own folder of ``path``, so a retried batch leaves no second copy; its scores may then rest
    on a fresher history. ``read_scores`` reads them.
    """

    def write(batch: DataFrame, number: int) -> None:
        score(batch, history()).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """All rows that ``score_with_history`` wrote, with the ``batch`` that scored them."""
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*")
