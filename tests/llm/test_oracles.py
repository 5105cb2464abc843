"""Every training-data query that SQL can express, against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as E
from feeflow.llm.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=str)


def test_all_queries_are_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    found = con.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, map(tuple, df.collect())) == _rows(names, found.fetchall())
