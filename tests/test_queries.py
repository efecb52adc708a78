"""Registered queries against their SQL on the smallest data folder."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from vitrine.plans import load_queries
from vitrine.plans.inputs import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

def _norm(v):
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return f"{float(v):.6f}"
    return str(v)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(load_queries()[0]))
def test_query_matches_sql(spark, sql, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in columns) for r in df.collect())
    result = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(_norm(r[i]) for i in at) for r in result.fetchall())


def test_every_query_has_a_check():
    queries, checks = load_queries()
    assert set(queries) == set(checks)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["retailer", "product_line", "run_date"]
    assert df.count() > 0
