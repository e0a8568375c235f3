"""Each stage of the pipeline against plain Python on its own input."""

from __future__ import annotations

import os

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from test_minhash import brute

import corpus_pipeline
from gramledger.llm import decontaminate, quality, toxicity
from gramledger.llm.text import stored

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stored(stage(spark, before, SF), "test-stage")
        if k < 4:
            assert docs.columns == columns
            assert 0 < docs.count() < before.count()
            con.register("input", before.toPandas())
        if name == "toxicity":
            model = toxicity.learn(before, spark.read.parquet(f"{SF}/labels.parquet"))
            score = toxicity.Scorer(model)
            assert ids(docs) == sorted(r.doc_id for r in before.collect() if score(r.text.encode()) < 0.3)
        elif name == "quality_rules":
            assert ids(docs) == sorted(r[0] for r in con.sql(quality.oracle_sql("input")).filter("kept").project("doc_id").fetchall())
        elif name == "near_duplicates":
            want = brute([(r.doc_id, r.text) for r in before.collect()])
            assert ids(docs) == sorted(set(want.values()))
        elif name == "decontamination":
            clean = con.sql(decontaminate.oracle_sql("input")).filter("NOT contaminated").project("doc_id").fetchall()
            assert ids(docs) == sorted(r[0] for r in clean)
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
            texts = {r.doc_id: r.text for r in before.collect()}
            assert ids(docs) == sorted(texts)
            assert all(r.ids == library.encode(texts[r.doc_id], add_eos=True) for r in docs.collect())
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.collect()))


def test_odd_rows_pass_through(spark, messy, tmp_path):
    spark.createDataFrame([(1, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of the kind")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    messy.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    left = [r.doc_id for r in got]
    assert len([i for i in left if i is not None]) == len({i for i in left if i is not None})


def test_filters_judge_rows_and_not_ids(spark):
    """A bad row and a good one of the same id, and of none."""
    words = ["alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"]
    good, bad = words[0], "one two three four five six seven"
    rows = [(1, good, "en"), (1, bad, "en"), (2, bad, "en"), (None, good, "en"), (None, bad, None), (3, None, "en"), (4, good, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert sorted(map(str, map(tuple, quality.keep_good(docs).collect()))) == sorted(str(r) for r in rows if r[1] == good)
    benchmark = spark.createDataFrame([(1, bad)], "item_id bigint, text string")
    left = decontaminate.remove_contaminated(docs, benchmark).collect()
    assert sorted(map(str, map(tuple, left))) == sorted(str(r) for r in rows if r[1] != bad)
