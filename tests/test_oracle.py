"""Every registered query against its SQL oracle in DuckDB, at sf0.001."""

import math
import os
from collections import Counter

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ["lineitem", "supplier", "nation", "customer"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


import __spark_entry__ as E  # noqa: E402

from weatherlake.plans import REGISTRY  # noqa: E402

NAMES = sorted(REGISTRY)  # the optional subpackage has tests of its own


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(E.oracle_sql()[name])
    want = _rows(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == want


def test_every_query_has_an_oracle():
    assert all(e.sql for e in REGISTRY.values())
    assert set(REGISTRY) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_entry(spark):
    assert E.entry(spark).count() > 0
