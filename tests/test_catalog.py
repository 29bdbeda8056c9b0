"""Queries against their SQL on the smallest tables; METERLARK_ALL=1 runs every one."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
QUICK = (
    "c1_duplicates", "c8_clean_report", "c8_clean_rows", "e3_by_hour", "e6_correlation", "e8_sample", "e9_text_summary",
    "e10_quality_table", "f1_features", "f2_gate_counts", "f5_codes", "m2_assign_zone", "w4_demand_dataset", "k5_split",
    "v2_mape_nonzero", "a6_summary", "k2_top20", "q1_validate", "q3_zone", "q7_validate_completed", "q13_insight", "q15_constraints",
)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 100


def test_entry(spark):
    assert entry.entry(spark).count() == 30 * (720 - 24)


@pytest.mark.parametrize("name", sorted(ORACLES) if os.environ.get("METERLARK_ALL") else QUICK)
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, expected.fetchall())
