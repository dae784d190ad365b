"""Every registered query against DuckDB on the same tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SF_DIR
from tidelog.plans.oracle import ORACLE
from tidelog.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    cursor = duck.execute(ORACLE[name])
    names = [column[0] for column in cursor.description]
    expected = [dict(zip(names, row)) for row in cursor.fetchall()]
    assert sorted(names) == columns

    def ordered(rows):
        return sorted((tuple(row[c] for c in columns) for row in rows), key=repr)

    assert ordered(row.asDict() for row in frame.collect()) == ordered(expected)


def test_entry_returns_rows(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["_topic", "_partition", "_offset", "user_id", "k"]
    assert frame.count() > 0
