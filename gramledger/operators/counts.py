"""Operators over counts per phrase."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramledger.config import PHRASE_LENGTH, REPORT_LINE, STATS_LINES
from gramledger.operators.documents import document_phrase_counts, unique_docs, with_normalized


def signed_counts(
    texts: DataFrame, sign: str | None = None, length: int = PHRASE_LENGTH, part: str | None = None
) -> DataFrame:
    """(phrase, d_doc, d_total) summed over distinct documents (hash, text).

    `sign` names a column of +1 / -1 that adds or takes back a document. Phrases
    are counted by document first, then summed by phrase, each with a map-side
    sum; texts that lie by hash are shuffled by phrase only. `part` names a column
    the texts lie by: then a phrase has a sum for each part, and nothing is shuffled.
    """
    m = F.col(sign).cast("bigint") if sign else F.lit(1).cast("bigint")
    by = [part] if part else []
    counted = document_phrase_counts(texts.withColumn("m", m), length, "m", *by)
    sums = counted.groupBy(*by, "phrase").agg(
        F.sum("m").alias("d_doc"), F.sum(F.col("m") * F.col("n")).alias("d_total")
    )
    return sums.drop(*by)


def nonzero(doc: str, total: str) -> Column:
    return (F.col(doc) != 0) | (F.col(total) != 0)


def as_counts(deltas: DataFrame) -> DataFrame:
    """Summed deltas as counts; phrases that nothing holds any more go."""
    return deltas.where(nonzero("d_doc", "d_total")).select(
        "phrase", F.col("d_doc").alias("doc_count"), F.col("d_total").alias("total_count")
    )


def text_counts(texts: DataFrame, length: int = PHRASE_LENGTH) -> DataFrame:
    """(phrase, doc_count, total_count) of distinct documents (hash, text)."""
    # Nothing is taken back here, so no count is zero; without a filter on them a
    # semi-join with a few phrases can move below the aggregation.
    return signed_counts(texts, length=length).select(
        "phrase", F.col("d_doc").alias("doc_count"), F.col("d_total").alias("total_count")
    )


def phrase_counts(docs: DataFrame, length: int = PHRASE_LENGTH) -> DataFrame:
    """(phrase, doc_count, total_count) where every row of `docs` is a URI of its own."""
    return text_counts(with_normalized(unique_docs(docs)), length)


def combine(*deltas: DataFrame) -> DataFrame:
    """Sum of any number of (phrase, d_doc, d_total) updates."""
    rows = reduce(DataFrame.unionByName, (d.select("phrase", "d_doc", "d_total") for d in deltas))
    return rows.groupBy("phrase").agg(
        F.sum("d_doc").alias("d_doc"), F.sum("d_total").alias("d_total")
    )


def with_default(wanted: DataFrame, hits: DataFrame) -> DataFrame:
    """(phrase, doc_count, total_count) of the wanted phrases, (0, 0) without a hit."""
    zero = F.lit(0).cast("bigint")
    return wanted.join(hits, "phrase", "left").select(
        "phrase",
        F.coalesce("doc_count", zero).alias("doc_count"),
        F.coalesce("total_count", zero).alias("total_count"),
    )


def lookup(requests: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts of the requested phrases; a phrase never seen has (0, 0).

    The semi-join comes first: with few requests Spark broadcasts them and
    neither shuffles nor sorts the counts.
    """
    wanted = requests.select("phrase").distinct()
    return with_default(wanted, counts.join(wanted, "phrase", "left_semi"))


def report(counts: DataFrame, in_order: bool = False) -> DataFrame:
    """One printed line per phrase, in byte order of the phrases. in_order: that is how they come."""
    line = F.format_string(REPORT_LINE, "doc_count", "total_count", "phrase")
    return (counts if in_order else counts.orderBy("phrase")).select(line.alias("value"))


def stats_report(stats: DataFrame) -> DataFrame:
    """The corpus counters as printed lines."""
    names = ("uris", "unique_docs", "processed_docs")
    lines = [F.format_string(f, n) for f, n in zip(STATS_LINES, names, strict=True)]
    return stats.select(F.explode(F.array(*lines)).alias("value"))


def newest_exports(exports: DataFrame) -> DataFrame:
    """(phrase, seq, doc_count, total_count): the highest sequence of each phrase.

    Rows of (0, 0) stay: they say at which sequence a phrase was deleted, so
    that an older export arriving later cannot bring it back.
    """
    return (
        exports.groupBy("phrase")
        .agg(F.max(F.struct("seq", "doc_count", "total_count")).alias("last"))
        .select("phrase", "last.seq", "last.doc_count", "last.total_count")
    )


def published_rows(newest: DataFrame) -> DataFrame:
    """What a reader of the query table sees."""
    return newest.where(nonzero("doc_count", "total_count")).select(
        "phrase", "doc_count", "total_count"
    )
