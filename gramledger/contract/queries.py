"""One query per operator over the given tables, as (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gramledger.config import LedgerOptions
from gramledger.functions.text import content_hash, normalized, tokens
from gramledger.operators import counts as C
from gramledger.operators import documents as O
from gramledger.plans import delta as D
from gramledger.plans.combined import CombinedTable, most, sketched, summed
from gramledger.plans.ledger import Ledger
from gramledger.session import new_folder, tune_for_phrases
from gramledger.sinks.outside import OutsideStore
from gramledger.sinks.query_table import ExportSink, QueryTable
from gramledger.sources.change_feed import FEED_SCHEMA, change_feed
from gramledger.sources.changes import stream_changes
from gramledger.sources.files import open_folder
from gramledger.sources.text_directory import read_text_directory, stream_text_directory
from gramledger.streaming.stream import drain, start_stream

Query = Callable[[SparkSession, str], DataFrame]

# The feed made of `documents` writes each URI in up to three rounds. Rounds
# before the last one make up the state the last one is applied to.
ROUNDS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune_for_phrases(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document at a URI of its own."""
    docs = table(spark, sf_dir, "documents")
    return change_feed(docs, F.col("doc_id"), "text", "doc_id")


def document_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a write to a URI that up to three documents share."""
    docs = table(spark, sf_dir, "documents")
    uri = F.expr(f"doc_id DIV {ROUNDS}")
    return change_feed(docs, uri, "text", F.col("doc_id") % ROUNDS)


def conversation_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a write to the URI of its conversation."""
    turns = table(spark, sf_dir, "conversations")
    return change_feed(turns, F.concat(F.lit("conversation:"), "conv_id"), "text", "turn")


def page_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_feed(table(spark, sf_dir, "pages"), "url", "html", "page_id")


def rounds(feed: DataFrame) -> list[DataFrame]:
    return [feed.where(F.col("seq") == k) for k in range(ROUNDS)]


def before_last_round(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("seq") < ROUNDS - 1)


def last_round(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("seq") == ROUNDS - 1)


# -- text ---------------------------------------------------------------------


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", tokens(F.col("text")).alias("t"))
    return docs.select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        F.try_element_at("t", F.lit(1)).alias("first_token"),
        F.try_element_at("t", F.lit(-1)).alias("last_token"),
        F.md5(F.array_join("t", " ")).alias("tokens_md5"),
    )


def doc_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", content_hash(F.col("text")).alias("hash"))


def doc_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", normalized(F.col("text")).alias("text"))
    rows = O.document_phrases(texts, 4, "doc_id")
    return rows.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "phrase")


# -- batch --------------------------------------------------------------------


def doc_phrase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.document_phrase_counts(O.with_normalized(O.unique_docs(documents(spark, sf_dir))))


def phrase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.phrase_counts(documents(spark, sf_dir))


def unique_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.unique_docs(documents(spark, sf_dir))


def page_phrase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.phrase_counts(page_feed(spark, sf_dir))


def conversation_phrase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of what each conversation holds after its last turn."""
    docs = O.with_normalized(O.current_docs(conversation_feed(spark, sf_dir)))
    return C.text_counts(docs)


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = (
        document_feed(spark, sf_dir)
        .unionByName(conversation_feed(spark, sf_dir))
        .unionByName(page_feed(spark, sf_dir))
    )
    return O.hashed_feed(feeds)


def latest_by_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = document_feed(spark, sf_dir)
    return O.with_text(O.latest_by_uri(feed), feed)


def doc_ref_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.ref_counts(O.latest_by_uri(document_feed(spark, sf_dir)))


def phrase_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every phrase of the benchmark texts, looked up among the documents."""
    items = table(spark, sf_dir, "benchmark").select(
        normalized(F.col("text")).alias("text")
    )
    return C.lookup(O.document_phrases(items, 4), phrase_counts(spark, sf_dir))


def phrase_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.report(phrase_counts(spark, sf_dir))


# -- one step, without stored state ---------------------------------------------


def _state_before(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    old = before_last_round(feed)
    latest = O.latest_by_uri(old)
    return latest.select("uri", "hash"), O.ref_counts(latest)


def _changes(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    uri_state, doc_state = _state_before(feed)
    return D.changed_uris(O.latest_by_uri(last_round(feed)), uri_state), doc_state


def changed_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes, _ = _changes(document_feed(spark, sf_dir))
    return changes.select("uri", "old_hash", "new_hash")


def doc_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes, doc_state = _changes(document_feed(spark, sf_dir))
    moved = D.transitions(D.ref_deltas(changes), doc_state)
    return moved.select("hash", "old_count", "new_count", F.col("multiplier").cast("int").alias("multiplier"))


# -- the ledger -------------------------------------------------------------------


@cache
def _ledger(app: str, spark: SparkSession, sf_dir: str) -> Ledger:
    """A ledger after all rounds; built once per session.

    It is compacted after the first round, so later rounds work on a base and logs.
    """
    ledger = Ledger.create(spark, new_folder(spark, "ledger"), LedgerOptions())
    for k, changes in enumerate(rounds(document_feed(spark, sf_dir))):
        ledger.load(changes)
        if k == 0:
            ledger.compact()
    return ledger


def ledger_of(spark: SparkSession, sf_dir: str) -> Ledger:
    return _ledger(spark.sparkContext.applicationId, spark, sf_dir)


def phrase_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last round added to and took from the counts."""
    return ledger_of(spark, sf_dir).batch_deltas(ROUNDS - 1).select("phrase", "d_doc", "d_total")


def incremental_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_of(spark, sf_dir).phrase_counts()


def live_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_of(spark, sf_dir).documents()


def uri_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_of(spark, sf_dir).uri_state().select("uri", "hash")


def late_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts after the rounds came in the order 2, 0, 1: older writes change nothing of newer ones."""
    ledger = Ledger.create(spark, new_folder(spark, "late"), LedgerOptions())
    feed = rounds(document_feed(spark, sf_dir))
    for k in (2, 0, 1):
        ledger.load(feed[k])
    return ledger.phrase_counts()


def ledger_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select(normalized(F.col("text")).alias("text"))
    return ledger_of(spark, sf_dir).lookup(O.document_phrases(items, 4))


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_of(spark, sf_dir).corpus_stats()


def corpus_stats_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.stats_report(corpus_stats(spark, sf_dir))


def export_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New totals of the phrases the last round changed."""
    return ledger_of(spark, sf_dir).changed_values(ROUNDS - 1)


def export_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exports of all rounds, newest first and then again, as a reader of the sink sees them.

    All of them lie before the ledger's last compaction; the sink is folded half-way.
    """
    ledger = ledger_of(spark, sf_dir)
    ledger.compact()
    sink = ExportSink(spark, new_folder(spark, "exports"), ledger.position().buckets)
    for delivery, seq in enumerate([*reversed(range(ROUNDS)), *range(ROUNDS)]):
        sink.apply(ledger.changed_values(seq), delivery)
        if delivery == ROUNDS:
            sink.fold()
    return sink.scan()


def export_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changed values of each round as a stream, delivered to a store outside and picked up again after a restart."""
    place = new_folder(spark, "export-stream")
    ledger = Ledger.create(spark, f"{place}/ledger", LedgerOptions())
    store = OutsideStore(spark, f"{place}/store")
    for k, changes in enumerate(rounds(document_feed(spark, sf_dir))):
        ledger.store_values(ledger.load(changes))
        if k:  # the first run finds two batches, the second one goes on behind them
            drain(store.stream(stream_changes(spark, ledger.root), f"{place}/checkpoint"))
    return store.scan()


def export_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exports of all rounds in deliveries of their own to a store outside, newest first and then again."""
    ledger = ledger_of(spark, sf_dir)
    store = OutsideStore(spark, new_folder(spark, "outside"))
    for seq in [*reversed(range(ROUNDS)), *range(ROUNDS)]:
        store.apply(ledger.changed_values(seq), seq)
    return store.scan()


def table_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published table brought to every round: the first is written whole, the others are layers over it."""
    ledger = Ledger.create(spark, new_folder(spark, "updated-ledger"), LedgerOptions())
    query_table = QueryTable(spark, new_folder(spark, "updated-table")).recreate()
    query_table.LAYER_SHARE = 0  # a round changes more than a layer may otherwise have
    for changes in rounds(document_feed(spark, sf_dir)):
        ledger.load(changes)
        ledger.publish(query_table)
    return query_table.scan()


def corpus_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters after a load of the last round that stopped before it counted phrases."""
    ledger = Ledger.create(spark, new_folder(spark, "stopped"), LedgerOptions())
    *first, last = rounds(document_feed(spark, sf_dir))
    for changes in first:
        ledger.load(changes)
    stopping = ledger.within(spark)

    def stop(*_):
        raise InterruptedError

    stopping._signed_texts = stop
    try:
        stopping.load(last)
    except InterruptedError:
        return ledger.corpus_stats()
    raise AssertionError("the load was not stopped")


def combined_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per phrase a sum, a maximum and a sketch of its documents, brought from round to round by their own combiners."""
    place = new_folder(spark, "combined")
    ledger = Ledger.create(spark, f"{place}/ledger", LedgerOptions())
    values = CombinedTable(ledger, f"{place}/values", [
        summed("total_count", lambda: F.col("n")), most("most_in_one", lambda: F.col("n")), sketched("about", lambda: F.col("hash"))])
    for changes in rounds(document_feed(spark, sf_dir)):
        ledger.load(changes)
        values.advance()
    return values.read().withColumnRenamed("documents", "doc_count")


def _published(spark: SparkSession, sf_dir: str) -> QueryTable:
    return _publish_once(spark.sparkContext.applicationId, spark, sf_dir)


@cache
def _publish_once(app: str, spark: SparkSession, sf_dir: str) -> QueryTable:
    ledger = Ledger.create(spark, new_folder(spark, "published-ledger"), LedgerOptions())
    ledger.load(documents(spark, sf_dir))
    query_table = QueryTable(spark, new_folder(spark, "query-table")).recreate()
    ledger.publish(query_table)
    return query_table


def phrase_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir).scan()


def table_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every phrase of the benchmark texts, looked up in the published table."""
    items = table(spark, sf_dir, "benchmark").select(normalized(F.col("text")).alias("text"))
    return _published(spark, sf_dir).lookup(O.document_phrases(items, 4))


def phrase_range_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and occurrences by first character, read from the range-sorted table.

    Stops if two files overlap in their phrases.
    """
    rows = _published(spark, sf_dir).scan()
    files = rows.groupBy(F.input_file_name().alias("file")).agg(F.min("phrase").alias("low"), F.max("phrase").alias("high"))
    before = F.lag("high").over(Window.orderBy("low"))  # a row per file
    if not files.withColumn("before", before).where("before >= low").isEmpty():
        raise ValueError("files of the published table overlap")
    return rows.groupBy(F.substring("phrase", 1, 1).alias("first_char")).agg(
        F.count("*").alias("phrases"), F.sum("total_count").alias("occurrences")
    )


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rounds written one after the other to a folder, read back as a stream."""
    place = new_folder(spark, "stream")
    for changes in rounds(document_feed(spark, sf_dir)):
        changes.write.mode("append").parquet(f"{place}/feed")
    files = spark.read.parquet(f"{place}/feed").select(F.input_file_name()).distinct().count()
    ledger = Ledger.create(spark, f"{place}/ledger", LedgerOptions())
    changes = (
        spark.readStream.schema(FEED_SCHEMA)
        .option("maxFilesPerTrigger", -(-files // ROUNDS))
        .parquet(f"{place}/feed")
    )
    drain(start_stream(ledger, changes, f"{place}/checkpoint", "rounds", compact_every=2))
    return ledger.phrase_counts()


def write_files(files: DataFrame, folder: str) -> None:
    """A file for every row (name, content), written over one of that name."""
    names = pa.schema([("name", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path, _ = open_folder(folder)
        for rows in batches:
            for name, content in zip(rows.column(0), rows.column(1), strict=True):
                with store.open_output_stream(f"{path}/{name}") as out:
                    out.write(content.as_py().encode())
            yield pa.RecordBatch.from_arrays([rows.column(0)], schema=names)

    store, path, _ = open_folder(folder)
    store.create_dir(path)
    files.select("name", "content").mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()


def text_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in a *.txt file of its own, loaded from the folder; some files are empty, and some have other names."""
    folder = new_folder(spark, "texts")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    of = F.col("doc_id").cast("string")
    write_files(docs.select(F.concat(of, F.lit(".txt")).alias("name"), F.col("text").alias("content")), folder)
    write_files(docs.where("doc_id % 11 = 0").select(F.concat(F.lit("nothing in "), of, F.lit(".txt")).alias("name"), F.lit("").alias("content")), folder)
    for suffix in (".md", ".TXT", ".txt.bak"):
        write_files(docs.where("doc_id % 7 = 0").select(F.concat(of, F.lit(suffix)).alias("name"), F.lit("not to be loaded").alias("content")), folder)
    return O.ref_counts(O.latest_by_uri(read_text_directory(spark, folder)))


def directory_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder in which each URI is a file that every round may write anew, followed as a stream that is restarted after each."""
    place = new_folder(spark, "directory-stream")
    ledger = Ledger.create(spark, f"{place}/ledger", LedgerOptions())
    for changes in rounds(document_feed(spark, sf_dir)):
        write_files(changes.select(F.concat("uri", F.lit(".txt")).alias("name"), "content"), f"{place}/texts")
        drain(start_stream(ledger, stream_text_directory(spark, f"{place}/texts"), f"{place}/checkpoint", "texts"))
    return O.ref_counts(ledger.uri_state())


def table_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over the published table, read in the order of its files."""
    return C.report(_published(spark, sf_dir).scan_ordered(), in_order=True)


PREFIX, AFTER = "a", "an"


def table_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of the published table that begin with a prefix, from a key on."""
    return _published(spark, sf_dir).scan_ordered(PREFIX, AFTER)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        tokenize, doc_hash, doc_phrases, doc_phrase_counts, phrase_counts, unique_docs,
        page_phrase_counts, conversation_phrase_counts, latest_by_uri, doc_ref_counts,
        phrase_lookup, phrase_report, changed_uris, doc_transitions, phrase_deltas,
        incremental_counts, late_writes, live_documents, uri_table, ledger_lookup, corpus_stats,
        corpus_stats_report, export_changes, export_apply, phrase_table, table_lookup, phrase_range_layout,
        stream_counts, text_directory, directory_stream, export_stream, export_outside, table_updates, table_report, table_prefix,
        corpus_lag, combined_values,
    )
}
QUERIES["change_feed"] = feed_rows
