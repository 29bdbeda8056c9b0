"""Category codes, one-hot columns and the model matrices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlark import params
from meterlark.functions.numeric import to_log
from meterlark.session import stage


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): the distinct non-null values, numbered from 0 in order.

    The values are dealt out by ranges and written once with the number of their range, so that every later read agrees on it. A
    value's code is the number of values in lower ranges, one sum over as many rows as there are ranges, and its place in
    its own: no task holds more than a range.
    """
    values = df.select(F.col(column).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    ranged = stage(values.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "categories")
    below = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(below), F.lit(0)).alias("lower"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    return ranged.withColumn("place", place).join(offsets, "part").select("value", (F.col("lower") + F.col("place") - 1).alias("code"))


def mapped_code(column: Column, codes: Mapping) -> Column:
    """Look a value up in a fixed map; unknown values give null."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(codes.items())])
    return F.try_element_at(table, column)


def with_category_code(df: DataFrame, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """Add ``<column>_code``: rank of the value among the sorted categories, -1 for null.

    Without given ``values`` the table of all distinct ones, however many, meets the rows in a join.
    """
    name, text = f"{column}_code", F.col(column).cast("string")
    if values is not None:
        code = mapped_code(text, {v: i for i, v in enumerate(values)}) if values else F.lit(None).cast("int")
        return df.withColumn(name, F.coalesce(code, F.lit(-1)))
    codes = category_codes(df, column).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    joined = df.join(codes, text == F.col("_value"), "left")
    return joined.select(*[c for c in df.columns if c != name], F.coalesce("_code", F.lit(-1)).alias(name))


def with_request_codes(df: DataFrame) -> DataFrame:
    """Codes by the fixed maps of the training data, so a single request gets the right ones."""
    return df.withColumns(
        {
            "vendor_id_code": mapped_code(F.col("vendor_id").cast("int"), params.VENDOR_CODES),
            "store_and_fwd_flag_code": mapped_code(F.col("store_and_fwd_flag"), params.STORE_FLAG_CODES),
        }
    )


def duration_matrix(
    df: DataFrame, vendor_values: Sequence[str] | None = None, flag_values: Sequence[str] | None = None
) -> DataFrame:
    """id, the sixteen duration features in order, and the target on both scales."""
    coded = with_category_code(df, "vendor_id", vendor_values)
    coded = with_category_code(coded, "store_and_fwd_flag", flag_values)
    return coded.select(
        "id",
        *params.DURATION_FEATURES,
        to_log(F.col("trip_duration")).alias("label"),
        F.col("trip_duration").cast("double").alias("y_raw"),
    )


def zone_dummies(n_zones: int = params.N_ZONES) -> list[str]:
    return [f"zone_{i}" for i in range(n_zones)]


def with_zone_dummies(df: DataFrame, n_zones: int = params.N_ZONES, zone: str = "pickup_zone") -> DataFrame:
    """One 0/1 column per zone of the fixed range, present in the data or not."""
    return df.withColumns({f"zone_{i}": (F.col(zone) == i).cast("int") for i in range(n_zones)})


def demand_feature_columns(lags=params.LAG_HOURS, windows=params.ROLLING_WINDOWS) -> list[str]:
    """Lag, rolling-mean and calendar columns by their parameters."""
    return [
        *[f"demand_lag_{h}h" for h in lags],
        *[f"demand_rolling_mean_{w}h" for w in windows],
        *params.CALENDAR_COLUMNS,
    ]


def demand_matrix(
    df: DataFrame,
    n_zones: int = params.N_ZONES,
    lags=params.LAG_HOURS,
    windows=params.ROLLING_WINDOWS,
    keep: Sequence[str] = ("pickup_zone", "hour"),
) -> DataFrame:
    """Keys, demand features with zone dummies, and the target on both scales."""
    return with_zone_dummies(df, n_zones).select(
        *keep,
        *demand_feature_columns(lags, windows),
        *zone_dummies(n_zones),
        to_log(F.col("pickup_count")).alias("label"),
        F.col("pickup_count").cast("double").alias("y_raw"),
    )


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Pack columns into one vector; unknown values become NaN, so the caller decides on the row."""
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="keep").transform(df)
