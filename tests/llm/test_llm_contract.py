"""The queries against their SQL, and on tables without rows."""

from __future__ import annotations

import os

import duckdb
import pytest

import corpus_pipeline
from gramledger.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string", "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
}
here = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
WITHOUT_SQL = {"op3_toxicity", "op5_lm_score", "op6_html_extraction", "op8_sentencepiece"}


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df), key=lambda r: tuple((x is None, str(x)) for x in r))


def same(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    got = QUERIES[name](spark, folder)
    want = con.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    a = rows_of(got.collect(), got.columns)
    b = rows_of((dict(zip(want.columns, r, strict=True)) for r in want.fetchall()), got.columns)
    assert a == b


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL


@here
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    same(spark, SF, name)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Tables with null, empty and long texts under ids that are not repeated, and further columns."""
    from llm_rows import documents, pages

    folder = str(tmp_path_factory.mktemp("odd"))
    documents(spark).write.parquet(f"{folder}/documents.parquet")
    pages(spark).write.parquet(f"{folder}/pages.parquet")
    items = [(1, "b a é d c b a a b c d e a b"), (2, "short one"), (3, None), (4, ""), (5, "ONE"), (2, "short one"), (None, "tail")]
    spark.createDataFrame(items, TABLES["benchmark"]).write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 0, 1), (1, 0, 1)], TABLES["labels"]).write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_odd_rows_equal_sql(spark, odd, name):
    same(spark, odd, name)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op12_filter_audit"}))  # which has a row for every step
def test_a_row_for_every_row(spark, odd, name):
    table = "pages" if name.split("_")[0] in ("op4", "op6", "op9") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    ids = [r[0] for r in spark.read.parquet(f"{odd}/{table}.parquet").select(key).collect()]
    assert sorted(r[0] for r in QUERIES[name](spark, odd).select(key).collect()) == sorted(ids)


@pytest.mark.parametrize("name", [*sorted(QUERIES), "pipeline"])
def test_empty_tables(spark, tmp_path, name):
    for t, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{t}.parquet")
    query = corpus_pipeline.run if name == "pipeline" else QUERIES[name]
    assert query(spark, str(tmp_path)).collect() == []
