"""Directories of text files, one document per file, as a table and as a stream."""

from __future__ import annotations

import fnmatch
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nsmallest

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from gramledger.config import TEXT_FILE_GLOB
from gramledger.sources.change_feed import FEED_SCHEMA
from gramledger.sources.files import files_below, open_folder, uri_of

FORMAT = "text_files"
ROWS = pa.schema([("uri", pa.string()), ("content", pa.string()), ("seq", pa.int64())])
BATCH_BYTES, BATCH_FILES = 1 << 24, 1024
MILLISECOND = 1_000_000

# A place in a stream: all files changed before a time (in nanoseconds), and of those
# changed just then the ones named. Files that get the same time later are still seen.
Frontier = tuple[int, frozenset[str]]
START: Frontier = (-1, frozenset())


def frontier(offset: dict) -> Frontier:
    return offset["mtime"], frozenset(json.loads(offset["names"]))


def offset_of(at: Frontier) -> dict:
    return {"mtime": at[0], "names": json.dumps(sorted(at[1]))}


def behind(at: Frontier, mtime: int, name: str) -> bool:
    """Whether a file as it was changed at mtime has been passed."""
    return mtime < at[0] or mtime == at[0] and name in at[1]


@dataclass
class Share(InputPartition):
    """The k-th of n shares of the files between two places of the stream; without an end, of all files."""

    k: int
    n: int
    start: Frontier = START
    end: Frontier | None = None


class Folder:
    """A folder's text files. Every task lists it and reads those whose names fall to its share."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.recursive = options.get("recursive", "false").lower() == "true"
        self.parts = int(options.get("parts", 8))

    def files(self, share: Share | None = None) -> Iterator[tuple[int, str]]:
        """(time of the last change, path) of the files, or of a share of them."""
        files, path, _ = open_folder(self.path)

        def wanted(path: str) -> bool:
            own = share is None or zlib.crc32(path.encode()) % share.n == share.k
            return own and fnmatch.fnmatchcase(path.rsplit("/", 1)[-1], TEXT_FILE_GLOB)

        for info in files_below(files, path, self.recursive, wanted):
            yield info.mtime_ns, info.path

    def rows(self, share: Share) -> Iterator[pa.RecordBatch]:
        files, _, prefix = open_folder(self.path)
        uris, texts, seqs, size = [], [], [], 0
        for mtime, path in self.files(share):
            if behind(share.start, mtime, path) or share.end and not behind(share.end, mtime, path):
                continue
            with files.open_input_stream(path) as file:
                data = file.read()
            uris.append(uri_of(prefix, path))
            texts.append(data.decode("utf-8", "replace"))
            seqs.append(mtime // MILLISECOND)
            size += len(data)
            if size > BATCH_BYTES or len(uris) == BATCH_FILES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((uris, texts, seqs), ROWS, strict=True)], schema=ROWS)
                uris, texts, seqs, size = [], [], [], 0
        if uris:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((uris, texts, seqs), ROWS, strict=True)], schema=ROWS)


class FolderReader(DataSourceReader):
    def __init__(self, folder: Folder):
        self.folder = folder

    def partitions(self) -> list[Share]:
        return [Share(k, self.folder.parts) for k in range(self.folder.parts)]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        yield from self.folder.rows(partition)


class FolderStream(DataSourceStreamReader):
    """New and edited files in the order of their last change."""

    def __init__(self, folder: Folder, files_per_batch: int | None):
        self.folder, self.most, self.at = folder, files_per_batch, None

    def initialOffset(self) -> dict:
        self.at = START
        return offset_of(START)

    def latestOffset(self) -> dict:
        """After a restart the first batch takes all that is new: where it begins is not known here."""
        at = self.at or START
        new = (x for x in self.folder.files() if not behind(at, *x))
        if self.most and self.at:
            new = nsmallest(self.most, new)
        last, names = START[0], set()  # only the names of the newest time are held
        for mtime, name in new:
            if mtime > last:
                last, names = mtime, set()
            if mtime == last:
                names.add(name)
        if not names:
            return offset_of(at)
        seen = at[1] if last == at[0] else frozenset()
        self.at = last, seen | names
        return offset_of(self.at)

    def partitions(self, start: dict, end: dict) -> list[Share]:
        self.at = frontier(end)
        return [Share(k, self.folder.parts, frontier(start), self.at) for k in range(self.folder.parts)]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        yield from self.folder.rows(partition)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class TextFiles(DataSource):
    """Change feed of the *.txt files of a folder. Options: path, recursive, parts (tasks), files_per_batch (streams)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return FEED_SCHEMA

    def reader(self, schema) -> FolderReader:
        return FolderReader(Folder(self.options))

    def streamReader(self, schema) -> FolderStream:
        most = self.options.get("files_per_batch")
        return FolderStream(Folder(self.options), int(most) if most else None)


def _options(spark: SparkSession, recursive: bool) -> dict:
    spark.dataSource.register(TextFiles)
    return {"recursive": str(recursive).lower(), "parts": str(2 * spark.sparkContext.defaultParallelism)}


def read_text_directory(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Change feed of the *.txt files directly in a folder; other names are skipped.

    The suffix is case-sensitive. Text is UTF-8; invalid bytes become U+FFFD, a
    separator. A file of zero bytes is an empty text. seq is the time of the last change
    in milliseconds. Tasks list the folder themselves: nothing passes through the driver.
    """
    return spark.read.format(FORMAT).options(**_options(spark, recursive)).load(folder)


def stream_text_directory(
    spark: SparkSession, folder: str, files_per_batch: int | None = None, recursive: bool = False
) -> DataFrame:
    """The same as a stream that sees new, edited and emptied files, by the time of their last change.

    A file put there with an older time than the newest one seen is not seen until it
    is touched. A file edited again before its batch is read is read once, as it is then.
    """
    reader = spark.readStream.format(FORMAT).options(**_options(spark, recursive))
    if files_per_batch:
        reader = reader.option("files_per_batch", str(files_per_batch))
    return reader.load(folder)
