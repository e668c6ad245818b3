"""Every registered query against DuckDB on the same tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from ledgerflow.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"

# What DuckDB calls the types Spark returns.
TYPE_NAMES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def duck_type(name):
    return TYPE_NAMES.get(name, name.upper())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_duckdb(spark, duck, name):
    result = QUERIES[name][0](spark, SF_DIR)
    expected = duck.sql(QUERIES[name][1])
    columns = sorted(expected.columns)
    assert sorted(result.columns) == columns

    types = {c: t.replace(",", ", ") for c, t in result.dtypes}
    expected_types = dict(zip(expected.columns, map(str, expected.types)))
    for column in columns:
        got = duck_type(types[column]).replace(", ", ",")
        assert got == expected_types[column].replace(", ", ","), column

    order = ", ".join(f'"{c}"' for c in columns)
    wanted = Counter(duck.sql(f"SELECT {order} FROM ({QUERIES[name][1]})").fetchall())
    got = Counter(tuple(row) for row in result.select(*columns).collect())
    assert got == wanted
    assert wanted


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns[0] == "customer_id" and result.columns[-1] == "is_vip"
    assert result.count() == 150
