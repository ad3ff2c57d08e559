"""Every query with an SQL twin against DuckDB; the others give rows with their columns."""

import pytest

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(result.columns)
    places = [result.columns.index(c) for c in columns]
    ours = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    theirs = sorted(repr(tuple(row[i] for i in places)) for row in result.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_names():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).columns == ["key", "prediction", "count"]
