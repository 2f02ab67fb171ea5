"""Every registered query against its SQL on the smallest tables."""

import math
import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from catalog import load

SF = "/root/testdata/sf0.001"
QUERIES, CHECKS = load().QUERIES, load().CHECKS


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in sorted(pathlib.Path(SF).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(canonical(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    df = QUERIES[name](spark, SF)
    got = table(df.columns, df.collect())
    if name in CHECKS:
        want = con.sql(CHECKS[name])
        assert got == table(want.columns, want.fetchall())
    else:
        assert got[1]


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
