"""Registered queries on the smallest tables: against their SQL where there is one, else their columns."""

import pathlib

import duckdb
import pytest

from weakspot.llm.queries import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op6_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9_language_id": ["doc_id", "held_out", "lang_pred", "score"],
}


def test_one_query_per_operator():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_and_sql_agree(name, spark):
    con = duckdb.connect()
    for path in sorted(pathlib.Path(SF).glob("*.parquet")):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found, want = QUERIES[name](spark, SF), con.sql(CHECKS[name])
    order = sorted(found.columns)
    assert order == sorted(want.columns)
    place = [want.columns.index(c) for c in order]
    got = sorted(repr(tuple(row[c] for c in order)) for row in found.collect())
    assert got == sorted(repr(tuple(row[i] for i in place)) for row in want.fetchall())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(name, spark):
    found = QUERIES[name](spark, SF)
    assert found.columns[: len(COLUMNS[name])] == COLUMNS[name]
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
