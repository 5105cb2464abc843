"""Every catalogued query against its DuckDB oracle (sf0.001)."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from feeflow.plans.catalog import queries as own_queries
from feeflow.plans.oracle import ORACLE
from paths import SF001

TABLES = ["orders", "lineitem", "events"]


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t + '.parquet')}')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 9
    assert df.columns[0] == "mempool_date" and len(df.columns) == 25


def test_every_query_has_oracle_or_is_documented():
    missing = set(own_queries()) - set(E.oracle_sql())
    assert missing == {"q_schema_discovery"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    d_names = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_names)
    assert _rows(df.columns, s_rows) == _rows(d_names, d_rows)


def test_schema_discovery_rows(spark):
    rows = E.queries()["q_schema_discovery"](spark, SF001).collect()
    types = {r["payload_type"] for r in rows}
    assert types == {"mempool_blocks_event", "stats_event"}


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_types_match_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rel = duck.sql(E.oracle_sql()[name])
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == duck_types[f.name], (name, f.name)
