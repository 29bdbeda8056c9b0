"""Small result tables and request rows: CSV, JSON lines and their readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterlark.errors import DataValidationError
from meterlark.sources.trips import nan_to_null

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("pickup_datetime", T.TimestampNTZType()),
        T.StructField("dropoff_datetime", T.TimestampNTZType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("dropoff_latitude", T.DoubleType()),
        T.StructField("dropoff_longitude", T.DoubleType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("vendor_id", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("zone_id", T.IntegerType()),
        T.StructField("target_datetime", T.TimestampNTZType()),
    ]
)


def write_csv(df: DataFrame, path: str) -> None:
    """A report of few rows as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_metric_table(spark: SparkSession, path: str, made_by: str) -> DataFrame:
    """A saved comparison table, lowest RMSE first; a missing one names the step that makes it."""
    try:
        header = spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        raise DataValidationError(f"{path} not found; run {made_by} first") from error
    typed = [F.col(c) if c == "model" else F.col(c).cast("double").alias(c) for c in header.columns]
    return header.select(*typed).orderBy("rmse", "model")


def report_json(report: DataFrame) -> DataFrame:
    """One JSON text per report row."""
    return report.select(F.to_json(F.struct("*")).alias("value"))


def parse_requests(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON texts to request rows; absent fields and NaN are null, a text that is no request gives a row of nulls."""
    return nan_to_null(lines.select(F.from_json(F.col(column), REQUEST_SCHEMA).alias("r")).select("r.*"))


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    return parse_requests(spark.read.text(path))
