"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from gramledger.contract.oracles import ORACLES
from gramledger.contract.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")

TABLES = "documents conversations pages benchmark"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["phrase", "doc_count", "total_count"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    types = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}
    assert {c: types[t] for c, t in got.dtypes} == dict(zip(want.columns, map(str, want.types), strict=True))
    rows = got.collect()
    if name in ("phrase_report", "table_report"):  # the order counts
        assert [r.value for r in rows] == [r[0] for r in want.fetchall()]
    a = Counter(tuple(r[c] for c in columns) for r in rows)
    b = Counter(want.project(", ".join(columns)).fetchall())
    assert a == b
