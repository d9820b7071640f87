"""Every registered query against its checking SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, CHECKS = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def database_check():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(rows, order):
    def one(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return repr(v)

    return sorted(tuple(one(r[i]) for i in order) for r in rows)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches(spark, database_check, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in CHECKS:
        return
    result = database_check.sql(CHECKS[name])
    assert sorted(df.columns) == sorted(result.columns)
    names = sorted(df.columns)
    mine = canonical(rows, [df.columns.index(c) for c in names])
    theirs = canonical(result.fetchall(), [result.columns.index(c) for c in names])
    assert mine == theirs


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
