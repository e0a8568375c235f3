"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the jobs here count on. Applied where the session says nothing else.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One write delivered a million times makes one partition of the text join
    # huge. Split it even if that costs a shuffle; none is added without skew.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Compacted tables have one sorted file per bucket: joins need not sort them.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # Most four-word phrases are rare: the small first-level map of an
    # aggregation fills up at once and is then only a probe too many.
    "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
    # Let a large list of keys (documents to store, texts to take back) cut texts
    # down in their scan, before they are shuffled: up to 100 million keys in 64 MB.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "100000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "536870912",
    # A list of a thousand keys is looked up key by key in the Bloom filters of row
    # groups, not as one range from the least to the greatest.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1024",
}

# Texts and phrases are dealt to so many tasks, and small neighbours are put together again once
# their sizes are known: what one task holds then does not grow with the input. Whoever wants
# another number sets this; spark.sql.shuffle.partitions is what a session without AQE has.
PHRASES = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600"}


def tune(spark: SparkSession, settings: dict[str, str] = RECOMMENDED) -> SparkSession:
    for key, value in settings.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def tune_for_phrases(spark: SparkSession) -> SparkSession:
    return tune(spark, RECOMMENDED | PHRASES)


# What is stored is read with less disk than it takes to write it: sorted phrases as what differs from
# the one before (data pages of version 2), compressed by zstd.
STORED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
# Shuffle files of a write go when it is done, not when the driver happens to collect its garbage.
# Rows that come sorted by what they are grouped by are summed as they come, without a map of them.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.replaceHashWithSortAgg": "true"}


@contextmanager
def one_write(spark: SparkSession) -> Iterator[None]:
    """What holds for a write of the ledger or a sink, and not for the session."""
    before = {key: spark.conf.get(key, None) for key in WRITING}
    for key, value in WRITING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def build_session(app: str = "gramledger", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from spark.checkpoint.dir.

    Only a local session may go without: it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="gramledger-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/gramledger/{purpose}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """(file system, path) of a Hadoop path."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
