"""One query per operator over the given tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gramledger.llm import (
    decontaminate, filter_audit, html_extract, licenses, lm_score, minhash, mixing, piece_bpe, quality, resampling, toxicity, url_filter, warc,
)
from gramledger.llm.text import with_bounded_batches

PIECES = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return with_bounded_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.deduplicated_archives(table(spark, sf_dir, "pages"))
    # One file per task: an archive is the unit of reading.
    files = files.repartition(max(1, files.count()), "file")
    return warc.read_archives(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_score.word_scores(docs, lm_score.fit(docs))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("class_distance", "common_distance")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).drop("ratio")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.judged(found)


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_license_scan, op2_near_duplicates, op3_toxicity, op4_warc, op5_lm_score, op6_html_extraction, op7_quality_rules,
    op8_sentencepiece, op9_url_filter, op10_decontamination, op11_source_mix, op12_filter_audit, op13_importance_resampling,
)}
ORACLES: dict[str, str] = {
    "op1_license_scan": licenses.oracle_sql(),
    "op2_near_duplicates": minhash.oracle_sql(),
    "op4_warc": warc.oracle_sql(),
    "op7_quality_rules": quality.oracle_sql(),
    "op9_url_filter": url_filter.oracle_sql(),
    "op10_decontamination": decontaminate.oracle_sql(),
    "op11_source_mix": mixing.oracle_sql(),
    "op12_filter_audit": filter_audit.oracle_sql(),
    "op13_importance_resampling": resampling.oracle_sql(),
}
