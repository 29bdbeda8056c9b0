"""The one feature path shared by training and scoring, and its gate against unusable values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from meterlark import params
from meterlark.errors import DataValidationError
from meterlark.functions.spatial import with_spatial_features
from meterlark.functions.temporal import with_temporal_features

UNUSABLE = "engineered columns hold unusable values"


def build_features(df: DataFrame) -> DataFrame:
    """Trips plus eight temporal and six spatial columns; a projection, no shuffle."""
    return with_spatial_features(with_temporal_features(df))


def engineered_numeric(df: DataFrame) -> list[str]:
    """Numeric columns among the engineered ones (the compass direction is text)."""
    wanted = params.TEMPORAL_COLUMNS + params.SPATIAL_COLUMNS
    return [f.name for f in df.schema.fields if f.name in wanted and isinstance(f.dataType, T.NumericType)]


def _missing(c: str) -> Column:
    return F.col(c).isNull() | F.isnan(c)


def _infinite(c: str) -> Column:
    return F.coalesce(F.abs(c) == float("inf"), F.lit(False))


def usable_features(df: DataFrame) -> DataFrame:
    """``build_features`` that stops at the first row whose engineered columns hold a missing value or an infinity.

    The gate sits in the first engineered column: whoever writes the table reads its input once, and no table with such rows is ever
    finished. A filter would be moved below those of the cleaning and judge rows that are to go. Scorers use ``build_features``, since a
    bad request keeps its row.
    """
    built = build_features(df)
    numbers = engineered_numeric(built)
    found = F.array_compact(F.array(*[
        F.when(bad(c), F.lit(f"{c} {what}")) for c in numbers for bad, what in ((_missing, "missing"), (_infinite, "infinite"))]))
    message = F.concat(F.lit(f"{UNUSABLE}: "), F.array_join(found, ", "))
    first = numbers[0]
    return built.withColumn(first, F.when(F.size(found) > 0, F.raise_error(message).cast("int")).otherwise(F.col(first)))


def gate_counts(df: DataFrame, columns=None) -> DataFrame:
    """(feature, n_missing, n_infinite) for every engineered numeric column, from one aggregate."""
    columns = list(columns or engineered_numeric(df))
    row = df.agg(
        *[
            F.struct(
                F.count_if(_missing(c)).alias("n_missing"),
                F.count_if(_infinite(c)).alias("n_infinite"),
            ).alias(c)
            for c in columns
        ]
    )
    return row.unpivot([], columns, "feature", "n").select("feature", "n.n_missing", "n.n_infinite")


def require_usable(df: DataFrame, columns=None) -> DataFrame:
    """Raise when an engineered column holds missing values, else when one holds infinities."""
    found = gate_counts(df, columns).collect()
    for count, what in (("n_missing", "missing"), ("n_infinite", "infinite")):
        bad = {r["feature"]: r[count] for r in found if r[count]}
        if bad:
            raise DataValidationError(f"engineered columns hold {what} values: {bad}")
    return df
