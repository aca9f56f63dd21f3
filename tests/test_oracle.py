"""Every registered query against its oracle, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from veilframe.plans.registry import TABLES, all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(value):
    return round(value, 6) if isinstance(value, float) else value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(normal(row[k]) for k in order) for row in rows), key=str)


def test_names_agree():
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, oracle, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    expected = oracle.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted_rows(df.columns, rows) == sorted_rows(columns, expected.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
