"""Every registered query against its DuckDB oracle on the driver's sf0.001 tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

from tessera.plans.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    spark_rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    duck_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(spark_rows) == len(duck_rows)
    assert rows_of(df.columns, spark_rows) == rows_of(rel.columns, duck_rows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["name", "value", "timestamp", "technology", "device_id", "extraction_id"]
    assert df.count() > 0
