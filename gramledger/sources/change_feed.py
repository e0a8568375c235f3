"""The change feed: rows of (uri, content, seq) from any table or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEED_SCHEMA = "uri string, content string, seq bigint"


def change_feed(
    rows: DataFrame, uri: Column | str = "uri", content: Column | str = "content", seq: Column | str = "seq"
) -> DataFrame:
    """Projects any DataFrame to a change feed. A later `seq` of a URI replaces an earlier one."""
    uri, content, seq = (F.col(c) if isinstance(c, str) else c for c in (uri, content, seq))
    return rows.select(
        uri.cast("string").alias("uri"),
        content.cast("string").alias("content"),
        seq.cast("bigint").alias("seq"),
    )


def complete(feed: DataFrame) -> DataFrame:
    """The feed, where a row without URI, content or seq stops the job instead of being lost.

    Not part of change_feed, so that filters on a feed still reach its scan.
    """

    def required(name: str) -> Column:
        message = F.lit(f"change feed row without {name}")
        return F.coalesce(name, F.raise_error(message).cast(feed.schema[name].dataType)).alias(name)

    return feed.select(required("uri"), required("content"), required("seq"))
