"""Every registered query against its SQL on the small tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, compare

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    result = compare(spark, con, entry.queries()[name], SQL.get(name), SF)
    assert result.startswith("ok"), result


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == [
        "release_year", "weeks_since_release", "amount", "cumul_cashflow", "cumul_normalised"
    ]
    assert entry.entry(spark).count() > 0
