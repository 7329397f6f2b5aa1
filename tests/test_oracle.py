"""Every query with SQL gives the rows DuckDB gives on the same files."""

import math

import duckdb
import pytest

from waymark.queries import ORACLE_SQL, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return v


def _rows(columns, data):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(_value(r[i]) for i in order) for r in data), key=str)


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    found = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(columns, found.fetchall())
