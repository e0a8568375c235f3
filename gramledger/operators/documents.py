"""Batch operators from URIs to unique documents and their phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramledger.config import PHRASE_LENGTH
from gramledger.functions.text import content_hash, normalized, phrases, pieces
from gramledger.sources.change_feed import complete

PIECE_TOKENS = 4096
# A text of more characters is counted in shares of so many: each holds only its part of the phrases.
SHARE_CHARS = 1 << 22


def hashed_feed(feed: DataFrame) -> DataFrame:
    """(uri, seq, hash) of every row of a change feed; the text stays behind."""
    return feed.select("uri", "seq", content_hash(F.col("content")).alias("hash"))


def latest_by_uri(feed: DataFrame, *count: str) -> DataFrame:
    """(uri, seq, hash) of the last write to each URI, and how many writes there were if `count` names that column."""
    counts = [F.count("*").alias(c) for c in count]
    return (
        hashed_feed(feed)
        .groupBy("uri")
        .agg(F.max(F.struct("seq", "hash")).alias("last"), *counts)
        .select("uri", "last.seq", "last.hash", *count)
    )


def ref_counts(latest: DataFrame) -> DataFrame:
    """(hash, ref_count): how many URIs hold each document."""
    return latest.groupBy("hash").agg(F.count("*").alias("ref_count"))


def canonical_writes(latest: DataFrame) -> DataFrame:
    """(hash, seq, uri, ref_count): for each document the write that supplies its text."""
    return (
        latest.groupBy("hash")
        .agg(F.min(F.struct("seq", "uri")).alias("first"), F.count("*").alias("ref_count"))
        .select("hash", "first.seq", "first.uri", "ref_count")
    )


def with_text(writes: DataFrame, feed: DataFrame) -> DataFrame:
    """Adds `content` from the feed to rows holding (hash, seq, uri).

    The only place where the text of a feed moves, and only the rows asked for
    are kept and hashed again. A write delivered twice gives one row.
    """
    matching = F.when(F.col("hash") == content_hash(F.col("content")), F.col("content"))
    return (
        feed.select("uri", "seq", "content")
        .join(writes, ["uri", "seq"])
        .groupBy(*writes.columns)
        .agg(F.min(matching).alias("content"))
    )


def unique_docs(docs: DataFrame) -> DataFrame:
    """(hash, content, ref_count) where every row of `docs` is a URI of its own.

    The text held is the one of the lowest (seq, uri). Partial aggregation
    sends one text per hash and map task, however often it was copied. A row
    without content stops the job.
    """
    return (
        complete(docs).withColumn("hash", content_hash(F.col("content")))
        .groupBy("hash")
        .agg(
            F.min_by("content", F.struct("seq", "uri")).alias("content"),
            F.count("*").alias("ref_count"),
        )
    )


def current_docs(feed: DataFrame) -> DataFrame:
    """(hash, content, ref_count) of the documents behind the last write of each URI."""
    found = with_text(canonical_writes(latest_by_uri(feed)), feed)
    return found.select("hash", "content", "ref_count")


def with_normalized(docs: DataFrame) -> DataFrame:
    """Replaces `content` by the normalized `text`."""
    return docs.withColumn("text", normalized(F.col("content"))).drop("content")


def exploded(rows: DataFrame, array: str, name: str, *keep: str) -> DataFrame:
    """One row per array element, positions in `pos`.

    The outer form is deliberate: for the inner one Spark adds a filter on the
    array's size below, which computes the array a second time.
    """
    out = rows.select(*keep, F.posexplode_outer(array).alias("pos", name))
    return out.where(F.col(name).isNotNull())


def document_phrases(texts: DataFrame, length: int = PHRASE_LENGTH, *keep: str) -> DataFrame:
    """Phrases by position: the columns to keep, `pos` and `phrase`."""
    found = texts.withColumn("found", phrases(F.col("text"), length))
    return exploded(found, "found", "phrase", *keep)


def text_pieces(texts: DataFrame, length: int = PHRASE_LENGTH, tokens: int = PIECE_TOKENS) -> DataFrame:
    """Cuts each normalized text into pieces that together have exactly its phrases.

    Neighbouring pieces share length - 1 tokens.
    """
    keep = [c for c in texts.columns if c != "text"]
    cut = texts.withColumn("pieces", pieces(F.col("text"), length, tokens))
    return exploded(cut, "pieces", "text", *keep).withColumnRenamed("pos", "piece")


def counted(found: Column) -> Column:
    """Each element of an array and how often it is there, as an array of structs (phrase, n).

    Most documents repeat no phrase: there is nothing to count then. In others, sorted, equal elements
    stand together and are counted from one start of a run to the next.
    Arrays bound by transform() are computed once, not once per element.
    """
    one = F.lit(1).cast("bigint")

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return F.get(F.transform(F.array(starts), lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(s, i).alias("phrase"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).cast("bigint").alias("n")))), F.lit(0))

    def repeated(found: Column) -> Column:
        return F.get(F.transform(F.array(F.sort_array(found)), lambda s: F.when(F.size(s) > 0, runs(s))), F.lit(0))

    def of(found: Column) -> Column:
        once = F.size(F.array_distinct(found)) == F.size(found)
        return F.when(once, F.transform(found, lambda p: F.struct(p.alias("phrase"), one.alias("n")))).otherwise(repeated(found))

    return F.get(F.transform(F.array(found), of), F.lit(0))


def document_phrase_counts(texts: DataFrame, length: int = PHRASE_LENGTH, *keep: str) -> DataFrame:
    """(hash, phrase, n): positions at which each phrase starts in each document, one row per hash in `texts`.

    A document's phrases are counted within its row: no table of all documents' phrases is held
    or spilled. A long text is worked in shares of its phrases, each cut from its pieces.
    """
    rows = texts.select("hash", "text", *keep)
    shares = (F.length("text") / SHARE_CHARS).cast("int")
    rows = rows.select("*", shares.alias("last"), F.explode(F.sequence(F.lit(0), shares)).alias("share"))

    def of_share(found: Column) -> Column:
        return F.filter(found, lambda p: F.pmod(F.xxhash64(p), F.col("last") + 1) == F.col("share"))

    cut = F.flatten(F.transform(pieces(F.col("text"), length, PIECE_TOKENS), lambda piece: of_share(phrases(piece, length))))
    found = F.when(F.col("last") == 0, phrases(F.col("text"), length)).otherwise(cut)
    rows = exploded(rows.withColumn("found", counted(found)), "found", "of", "hash", *keep)
    return rows.select("hash", *keep, "of.phrase", "of.n")
