"""Ordered, audited cleaning rules.

Only the duplicate rule looks beyond its own row, and it runs first. The others become one chain
of conditions evaluated in a single pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from meterlark import params
from meterlark.functions.numeric import flag, outside
from meterlark.functions.temporal import elapsed_seconds
Rule = tuple[str, Column]

DUPLICATES = "duplicate_ids"
COPIES = "id_copies"
FAILED_RULE = "first_failed_rule"


def duration_mismatch(tolerance: float = 1.0) -> Column:
    """Recorded duration and timestamps differ by more than the tolerance; unknown passes."""
    seconds = elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return flag(F.abs(seconds - F.col("trip_duration")) > tolerance)


def duration_out_of_bounds(low: int = params.MIN_TRIP_SECONDS, high: int = params.MAX_TRIP_SECONDS) -> Column:
    return outside(F.col("trip_duration"), (low, high))


def point_out_of_bounds(end: str, lat=params.CITY_LAT, lon=params.CITY_LON) -> Column:
    """``end`` is 'pickup' or 'dropoff'; a missing coordinate counts as outside."""
    return outside(F.col(f"{end}_latitude"), lat) | outside(F.col(f"{end}_longitude"), lon)


def invalid_passengers(most: int = params.MAX_PASSENGERS) -> Column:
    """Zero or too many; negative and missing counts pass this rule."""
    count = F.col("passenger_count")
    return flag((count == 0) | (count > most))


def missing_critical(columns: Sequence[str] = params.CRITICAL_COLUMNS) -> Column:
    missing = F.lit(False)
    for name in columns:
        missing = missing | F.col(name).isNull()
    return missing


def default_rules() -> list[Rule]:
    """The row rules in order, after the duplicate rule."""
    return [
        ("duration_mismatch", duration_mismatch()),
        ("duration_out_of_bounds", duration_out_of_bounds()),
        ("pickup_out_of_bounds", point_out_of_bounds("pickup")),
        ("dropoff_out_of_bounds", point_out_of_bounds("dropoff")),
        ("invalid_passenger_count", invalid_passengers()),
        ("missing_critical_values", missing_critical()),
    ]


# Rows without a place come after all others.
LAST_PLACE = (1 << 63) - 1


def row_order(df: DataFrame, key: str = "id", order_by: str = "row_seq") -> Column:
    """One number that orders the rows of an id: the place first, then the content for rows with equal places.

    A decimal of 63 and 60 bits, so that a hash aggregate can take its minimum; only rows that are equal in every
    column have equal numbers.
    """
    content = F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c != order_by]), 4)
    place = F.coalesce(F.col(order_by), F.lit(LAST_PLACE)).cast("decimal(20,0)")
    return (place * F.lit(1 << 60).cast("decimal(19,0)")).cast("decimal(38,0)") + content.cast("decimal(20,0)")


def first_places(df: DataFrame, key: str = "id", order_by: str = "row_seq") -> DataFrame:
    """(_key, _first) of the ids that occur more than once, with their first place: only these two columns are read and shuffled.

    Summed per task before the shuffle, so an id that holds a third of the rows is one row per task.
    """
    places = df.select(F.col(key).alias("_key"), F.coalesce(F.col(order_by), F.lit(LAST_PLACE)).alias("_place"))
    per_id = places.groupBy("_key").agg(F.count(F.lit(1)).alias(COPIES), F.min("_place").alias("_first"))
    return per_id.filter(F.col(COPIES) > 1).drop(COPIES)


def with_failed_rule(
    df: DataFrame, rules: Sequence[Rule] | None = None, key: str = "id", order_by: str = "row_seq", firsts: DataFrame | None = None
) -> DataFrame:
    """Position (from 1) of the first row rule each row fails, 0 for a later copy of its id; null when it passes all.

    ``firsts`` is ``first_places(df)``, for tables in which no two rows of an id have the same place, as all that this library's readers number;
    one left join of it then marks the later copies. Without it places may be equal or missing, see ``drop_later_copies``,
    and the later copies are gone from the result.
    """
    rules = default_rules() if rules is None else rules
    if firsts is None:
        rows, later = drop_later_copies(df, key, order_by), F.lit(False)
    else:
        rows = df.join(firsts, F.col(key).eqNullSafe(F.col("_key")), "left")
        later = F.col("_first").isNotNull() & (F.coalesce(F.col(order_by), F.lit(LAST_PLACE)) != F.col("_first"))
    # One chain that looks at both sides of the join: a filter on it stays behind the join, and what the rules
    # read is computed once. Pushed below, every rule would compute its inputs anew.
    failed = F.when(later, F.lit(0))
    for i, (_, bad) in enumerate(rules, start=1):
        failed = failed.when(bad, F.lit(i))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], failed.alias(FAILED_RULE))


def repeated_ids(df: DataFrame, key: str = "id", order_by: str = "row_seq") -> DataFrame:
    """(_key, _first) of the ids that occur more than once, with the number of their first row.

    One hash aggregate to two narrow columns, summed per task before the shuffle.
    """
    per_id = df.groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias(COPIES), F.min(row_order(df, key, order_by)).alias("_first")
    )
    return per_id.filter(F.col(COPIES) > 1).drop(COPIES)


def drop_later_copies(df: DataFrame, key: str = "id", order_by: str = "row_seq") -> DataFrame:
    """Keep the first row of every id; null ids equal each other.

    ``order_by`` must be frozen: the same number for the same row however often the table is read. Rows without one
    come last; rows of an id with equal ones are ordered by a hash of their content, and of rows equal in every column one stays.

    Ids are meant to be unique, so the repeated ones are looked up first and meet the rows in a join whose kind adaptive
    execution chooses, at every size in the same way.
    """
    repeated = repeated_ids(df, key, order_by)
    same = F.col(key).eqNullSafe(F.col("_key"))
    unique = df.join(repeated.select("_key"), same, "left_anti")
    firsts = df.withColumn("_order", row_order(df, key, order_by)).join(repeated, same).filter(F.col("_order") == F.col("_first"))
    return unique.unionByName(firsts.select(*df.columns).distinct())


def clean_trips(
    df: DataFrame, rules: Sequence[Rule] | None = None, key: str = "id", order_by: str = "row_seq", firsts: DataFrame | None = None
) -> DataFrame:
    """Rows that survive every rule; ``firsts`` as in ``with_failed_rule``.

    A bad first copy still removes the later ones, so no rule may act before the copies are dropped.
    """
    audited = with_failed_rule(df, rules, key, order_by, firsts)
    return audited.filter(F.col(FAILED_RULE).isNull()).drop(FAILED_RULE)


def cleaning_report(
    df: DataFrame,
    rules: Sequence[Rule] | None = None,
    key: str = "id",
    order_by: str = "row_seq",
    warn_above: float = params.REMOVAL_WARNING_SHARE,
    firsts: DataFrame | None = None,
) -> DataFrame:
    """One row: rows in, rows removed per rule, rows out, share removed and whether that is a lot.

    Counted over the very rows that ``clean_trips`` decides on, so the report and the table agree.
    """
    rules = default_rules() if rules is None else rules
    audited = with_failed_rule(df, rules, key, order_by, firsts).select(FAILED_RULE)
    if firsts is None:
        # The later copies are gone from the rows: what the table had before is counted beside them.
        gone = df.select(F.lit(-1).alias(FAILED_RULE))
        rows, copies = audited.unionByName(gone), F.count_if(F.col(FAILED_RULE) == -1) - F.count_if(~F.col(FAILED_RULE).eqNullSafe(F.lit(-1)))
        initial = F.count_if(F.col(FAILED_RULE) == -1)
    else:
        rows, copies, initial = audited, F.count_if(F.col(FAILED_RULE) == 0), F.count(F.lit(1))
    counts = rows.agg(
        initial.alias("rows_initial"),
        copies.alias(DUPLICATES),
        *[F.count_if(F.col(FAILED_RULE) == i).alias(name) for i, (name, _) in enumerate(rules, start=1)],
        F.count_if(F.col(FAILED_RULE).isNull()).alias("rows_final"),
    )
    removed = F.col("rows_initial") - F.col("rows_final")
    share = F.try_divide(removed.cast("double"), F.col("rows_initial"))
    return counts.withColumns(
        {"rows_removed_total": removed, "pct_removed": share, "removal_warning": too_many_removed(share, F.lit(warn_above))}
    )


def too_many_removed(share: Column, limit: Column) -> Column:
    return share > limit


def clean_trip_data(
    df: DataFrame, rules: Sequence[Rule] | None = None, firsts: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The cleaned table and its report."""
    return clean_trips(df, rules, firsts=firsts), cleaning_report(df, rules, firsts=firsts)


def flag_counts(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Rows failing each rule, every rule on its own: (rule, n)."""
    rules = default_rules() if rules is None else rules
    row = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules])
    return row.unpivot([], [name for name, _ in rules], "rule", "n")


def duplicate_count(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id an earlier row already has: only the id column is read and shuffled."""
    copies = df.groupBy(key).agg(F.count(F.lit(1)).alias(COPIES))
    return copies.agg(F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).cast("bigint").alias(DUPLICATES))
