"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison on sf0.01)."""

import math

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry_mod
from tidemark.sources.tables import TABLES

from tidemark.plans.suite import QUERIES

SQL = {k: v for k, v in entry_mod.oracle_sql().items() if k in QUERIES}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return str(v)


def _rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["window_end", "wiki", "wiki_label", "language", "edit_count", "bot_count",
                          "human_count", "anomaly_flag"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.sql(SQL[name])
    want = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(got) == len(want)
    assert _rows(got, df.columns) == _rows(want, res.columns)
