"""Every registered query against the same result in DuckDB."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry_points

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(columns, rows):
    """Rows as sorted tuples of text, columns by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "NULL"
        return f"{value:.6g}" if isinstance(value, float) else str(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


# The queries of the optional subpackage have tests of their own.
NAMES = sorted(entry_points.queries().keys() - entry_points.EXTRA_QUERIES)


def test_all_queries_have_an_oracle():
    assert set(NAMES) == entry_points.oracle_sql().keys() - entry_points.EXTRA_SQL


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, oracle, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    expected = oracle.execute(entry_points.oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert rows_of(result.columns, result.collect()) == rows_of(columns, expected.fetchall())
    assert not spark.streams.active


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["airline", "streaming_count", "batch_count", "delta"]
    assert {row["delta"] for row in result.collect()} == {0}
