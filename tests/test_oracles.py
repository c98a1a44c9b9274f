"""Every query with a SQL check gives the same rows as DuckDB."""

import math
import pathlib

import duckdb
import pytest

import __spark_entry__ as entry_point

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in pathlib.Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if isinstance(x, float):
            return None if math.isnan(x) else round(x, 6) + 0.0
        return x

    table = [tuple(value(row[i]) for i in order) for row in rows]
    return sorted(table, key=lambda row: tuple((x is None, str(x)) for x in row))


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    assert sorted(columns) == sorted(result.columns)
    assert expected, "the check must not be empty"
    assert canonical(result.collect(), result.columns) == canonical(expected, columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark, sf_dir):
    assert entry_point.entry(spark).count() > 0
