"""One micro-batch as DataFrame steps. Nothing here reads or writes.

    feed -> latest write per URI -> changed URIs -> reference deltas
         -> document transitions -> signed documents -> phrase deltas
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def state_of(keys: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """The rows of a state table that belong to the (distinct) keys of a batch.

    A semi-join: the state is streamed past the batch's keys when these are
    small enough to broadcast, and joined on its own bucketing when not.
    """
    return state.join(keys.select(key), key, "left_semi")


def newer_writes(latest: DataFrame, uri_state: DataFrame) -> DataFrame:
    """(uri, seq, old_hash, hash) of the writes that count: no older than the one held, and with a new seq or hash.

    Of equal seq the write that comes in the later batch counts.
    """
    old = uri_state.select("uri", F.col("seq").alias("old_seq"), F.col("hash").alias("old_hash"))
    news = ~F.col("old_hash").eqNullSafe(F.col("hash")) | (F.col("seq") > F.col("old_seq"))
    return (
        latest.join(old, "uri", "left")
        .where((F.col("old_seq").isNull() | (F.col("seq") >= F.col("old_seq"))) & news)
        .select("uri", "seq", "old_hash", "hash")
    )


def changed_uris(latest: DataFrame, uri_state: DataFrame) -> DataFrame:
    """(uri, seq, old_hash, new_hash) of the URIs that got another document."""
    old = uri_state.select("uri", F.col("hash").alias("old_hash"))
    return (
        latest.withColumnRenamed("hash", "new_hash")
        .join(old, "uri", "left")
        .where(~F.col("old_hash").eqNullSafe(F.col("new_hash")))
        .select("uri", "seq", "old_hash", "new_hash")
    )


def ref_deltas(changes: DataFrame) -> DataFrame:
    """(hash, delta, first): +1 for the document a URI got, -1 for the one it had.

    `first` is the lowest (seq, uri) among the writes that bring the document.
    """
    moves = F.array(
        F.struct(F.col("new_hash").alias("hash"), F.lit(1).cast("bigint").alias("d")),
        F.struct(F.col("old_hash").alias("hash"), F.lit(-1).cast("bigint").alias("d")),
    )
    return (
        changes.select("seq", "uri", F.explode(moves).alias("move"))
        .select("seq", "uri", "move.*")
        .where(F.col("hash").isNotNull())
        .groupBy("hash")
        .agg(
            F.sum("d").alias("delta"),
            F.min(F.when(F.col("d") > 0, F.struct("seq", "uri"))).alias("first"),
        )
        .where(F.col("delta") != 0)
    )


def transitions(deltas: DataFrame, doc_state: DataFrame) -> DataFrame:
    """(hash, old_count, new_count, multiplier) of every document whose references moved.

    The multiplier says whether its phrases are added (+1), taken back (-1) or
    left alone (0). Further columns of the state are carried along.
    """
    old = F.coalesce("ref_count", F.lit(0).cast("bigint"))
    new = F.col("old_count") + F.col("delta")
    checked = F.when(new >= 0, new).otherwise(
        F.raise_error(F.concat(F.lit("negative reference count for document "), "hash"))
    )
    extra = [c for c in doc_state.columns if c not in ("hash", "ref_count", "content")]
    return (
        deltas.join(doc_state, "hash", "left")
        .withColumn("old_count", old)
        .withColumn("new_count", checked.cast("bigint"))
        .withColumn(
            "multiplier",
            F.when((F.col("old_count") == 0) & (F.col("new_count") > 0), 1)
            .when((F.col("old_count") > 0) & (F.col("new_count") == 0), -1)
            .otherwise(0),
        )
        .select("hash", "delta", "old_count", "new_count", "multiplier", "first", *extra)
    )


def first_writes(moved: DataFrame) -> DataFrame:
    """(hash, seq, uri): the write that supplies the text of each document coming to life."""
    return moved.where(F.col("multiplier") == 1).select("hash", "first.seq", "first.uri")


def export_rows(sums: DataFrame, base: DataFrame, seq: int) -> DataFrame:
    """(phrase, seq, doc_count, total_count): the new totals of the changed phrases.

    sums: (phrase, d_doc, d_total, new_doc, new_total), what changed and what is to be added to
    the totals of the base (phrase, base_doc, base_total). A phrase without total any more is
    exported as (0, 0).
    """
    zero = F.lit(0).cast("bigint")
    return (
        sums.where((F.col("d_doc") != 0) | (F.col("d_total") != 0))
        .join(base, "phrase", "left")
        .select(
            "phrase",
            F.lit(seq).cast("bigint").alias("seq"),
            (F.coalesce("base_doc", zero) + F.col("new_doc")).alias("doc_count"),
            (F.coalesce("base_total", zero) + F.col("new_total")).alias("total_count"),
        )
    )
