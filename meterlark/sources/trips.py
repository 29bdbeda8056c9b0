"""The raw trip table: schema, files, column check, stage tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from meterlark import params
from meterlark.errors import DataValidationError
from meterlark.session import stage

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("vendor_id", T.StringType()),
        T.StructField("pickup_datetime", T.TimestampNTZType()),
        T.StructField("dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("dropoff_longitude", T.DoubleType()),
        T.StructField("dropoff_latitude", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("trip_duration", T.IntegerType()),
    ]
)


def require_columns(df: DataFrame, columns=params.RAW_COLUMNS, what: str = "trip table") -> DataFrame:
    """Name every missing column in one error; extra columns pass through. Reads metadata only."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise DataValidationError(f"{what} lacks required column(s): {missing}")
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN sorts above every number in Spark, so unknown doubles become null at the door."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles}) if doubles else df


# Rows of one file or split that a bigint place leaves room for.
_PLACES = 1 << 40


def _numbered(df: DataFrame, groups: DataFrame, *names: str) -> DataFrame:
    """``df`` with ``_number``, the rank of its group (``names``) among all; there are as many groups as files or splits."""
    every = groups.select(*names).distinct().withColumn(
        "_number", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*names)) - 1)
    return df.join(every, list(names))


def with_file_order(df: DataFrame, name: str = "row_seq") -> DataFrame:
    """The place of each row of a Parquet table: its file's rank and its number in that file, as one bigint.

    Both are properties of the files, so the place is the same however a later read cuts them into splits.
    """
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = df.select(F.col("_metadata.file_path").alias("_file"))
    return _numbered(placed, files, "_file").select(*df.columns, (F.col("_number") * F.lit(_PLACES) + F.col("_row")).alias(name))


def staged_with_order(df: DataFrame, name: str = "row_seq") -> DataFrame:
    """Rows of text files, written once as a stage table together with their place.

    A row of a text file has no number of its own, and the generated one changes when a later read cuts the files
    otherwise. Within a split it grows with the row; file, start of the split and number order rows as the files do.
    """
    written = stage(df.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_row")), "raw-trips")
    placed = _numbered(written, written, "_file", "_split")
    return placed.select(*df.columns, (F.col("_number") * F.lit(_PLACES) + F.col("_row")).alias(name))


def _existing(reader, path: str) -> DataFrame:
    try:
        return reader(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise DataValidationError(f"no data found at {path}") from error
        raise


def read_trips_csv(spark: SparkSession, path: str, timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Trips from CSV files with a header, with their place in the files frozen; a value that does not parse fails the job.

    The header decides which field is which, so columns may come in any order and extra ones stay.
    """
    header = _existing(spark.read.option("header", True).csv, path)
    require_columns(header, what=path)
    known = {f.name: f for f in TRIP_SCHEMA.fields}
    schema = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header.columns])
    typed = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", timestamp_format)
        .csv(path)
    )
    return staged_with_order(nan_to_null(typed))


def read_trips_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Trips from Parquet, with the file order attached unless the table brings ``row_seq``."""
    df = require_columns(_existing(spark.read.parquet, path), what=path)
    return nan_to_null(df if "row_seq" in df.columns else with_file_order(df))


def parse_timestamps(df: DataFrame, columns, timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Text to timestamps without zone; a value that does not parse raises."""
    return df.withColumns({c: F.to_timestamp_ntz(F.col(c), F.lit(timestamp_format)) for c in columns})


def write_stage(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Hand a stage's result to the next job as Parquet.

    With ``partition_by`` rows are first gathered by that column, so a day becomes a few files
    instead of one per task; the rebalance splits a day that holds a large part of the table.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by)
    writer.parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return _existing(spark.read.parquet, path)
