"""WARC archives with revisit resolution.

1. write_archives: every task streams its records into an archive of the shared
   folder, one gzip member per record, and returns their headers with places.
2. resolve: the headers, without payloads, are shuffled by payload digest; records
   whose payload an earlier record has become revisits of it.
3. deduplicate: every task takes whole archives of step 1 and streams them into new
   ones with fresh headers; a revisit has no payload.
4. read_archives reads archives by their own headers and lengths.

A file counts once its name is in the table Spark has committed. A task that runs
again writes a file of another name; what a lost one left is never read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramledger.llm.text import batch, stored, utf8
from gramledger.session import new_folder

LEAST_BYTES = 100  # smaller payloads are kept as they are
ARCHIVE_BYTES = 1 << 30  # an archive is closed beyond this
BUFFER = 1 << 20
SERVER_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HEADERS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("place", pa.int64()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
)
HEADERS_SQL = "page_id bigint, url string, file string, place bigint, payload_bytes bigint, payload_digest string"
FILES = pa.schema([("file", pa.string())])
RECORDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.large_binary())]
)


def one_line(value: str) -> str:
    """A header value: line breaks and percent signs escaped."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def as_written(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(kind: str, payload: bytes, fields: dict[str, str]) -> bytes:
    """A WARC record as a gzip member of its own."""
    head = {
        "WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Date": datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), **fields,
        "Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(f"WARC/1.1\r\n{lines}\r\n".encode()) + packer.compress(payload + b"\r\n\r\n") + packer.flush()


class Members:
    """The gzip members of a file, one after the other."""

    def __init__(self, file: BinaryIO):
        self.file, self.rest = file, b""

    def __iter__(self) -> Iterator[bytes]:
        while self.rest or (block := self.file.read(BUFFER)):
            unpack = zlib.decompressobj(31)
            parts = []
            data = self.rest or block
            while not unpack.eof:
                if not data:
                    raise ValueError("archive ends within a record")
                parts.append(unpack.decompress(data))
                data = b"" if unpack.eof else self.file.read(BUFFER)
            self.rest = unpack.unused_data
            yield b"".join(parts)


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """The fields and the payload of a record; its length decides where the payload ends."""
    end = data.index(b"\r\n\r\n")
    version, *lines = data[:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    start, size = end + 4, int(fields["Content-Length"])
    if data[start + size :] != b"\r\n\r\n":
        raise ValueError("record length does not match its header")
    return fields, data[start : start + size]


class Archives:
    """Archives a task writes to a folder, each closed when it is large enough."""

    def __init__(self, folder: str):
        self.fs, self.path = arrow_fs.FileSystem.from_uri(folder)
        self.folder, self.file, self.place = folder, None, 0
        self.fs.create_dir(self.path, recursive=True)

    def add(self, data: bytes) -> tuple[str, int]:
        if self.file is None or self.place >= ARCHIVE_BYTES:
            self.close()
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            self.file, self.place = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None), 0
        place = self.place
        self.file.write(data)
        self.place += len(data)
        return f"{self.folder}/{self.name}", place

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def opened(file: str) -> BinaryIO:
    fs, path = arrow_fs.FileSystem.from_uri(file)
    return fs.open_input_stream(path, compression=None)


def uri(folder: str) -> str:
    """The folder as a URI that pyarrow reads: with two slashes after the scheme."""
    scheme, _, path = folder.rpartition(":")
    return folder if "://" in folder else f"{scheme or 'file'}://{path}"


def write_archives(pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes a response record per row and returns the headers: where each record is, and its payload's digest.

    folder: a URI all tasks reach. A null html is an empty payload, a null url an empty
    one; a null page_id has no WARC-Page field. Repeated rows are records of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = Archives(folder)
        for rows in batches:
            out = [[] for _ in range(6)]
            for key, where, payload in zip(*(rows.column(i) for i in range(3)), strict=True):
                key, where, payload = key.as_py(), where.as_py() or "", payload.as_py() or b""
                digest = hashlib.sha256(payload).hexdigest()
                fields = {"WARC-Target-URI": one_line(where), "WARC-Payload-Digest": f"sha256:{digest}"}
                if key is not None:
                    fields["WARC-Page"] = str(key)
                file, place = archives.add(record("response", payload, fields))
                for column, value in zip(out, (key, where, file, place, len(payload), digest), strict=True):
                    column.append(value)
            yield batch(HEADERS, out)
        archives.close()

    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), utf8(html).alias("html"))
    return rows.mapInArrow(run, HEADERS_SQL)


def resolve(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """headers with refers_to: the smallest page_id of the same payload, for records that are not the first of it.

    Payloads under least_bytes and records without a page_id refer to nothing. Of rows
    that repeat a page_id with the same payload the one that stands first in its archive,
    by name and place, is the original.
    """
    large = headers.where((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
    first = F.min(F.struct("page_id", "file", "place")).alias("o")
    originals = large.groupBy("payload_digest").agg(first, F.count("*").alias("m")).where("m > 1")
    originals = stored(originals.select("payload_digest", F.col("o.page_id").alias("o_page"), F.col("o.file").alias("o_file"), F.col("o.place").alias("o_place")), "originals")
    # Stored, so that the digest of very many records is split over tasks like any skewed join key.
    joined = headers.join(originals, "payload_digest", "left")
    original = (F.col("file") == F.col("o_file")) & (F.col("place") == F.col("o_place"))
    refers = F.col("o_page").isNotNull() & F.col("page_id").isNotNull() & ~original
    return joined.select(*headers.columns, F.when(refers, F.col("o_page")).alias("refers_to"))


def deduplicate(headers: DataFrame, folder: str) -> DataFrame:
    """Writes the records of resolved headers to new archives and returns the names of these.

    Every archive the headers name is read once, in order, by one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, names = Archives(folder), set()
        current, members = None, iter(())
        for rows in batches:
            for file, refers, size in zip(rows.column(0), rows.column(1), rows.column(2), strict=True):
                if file.as_py() != current:
                    current = file.as_py()
                    members = iter(Members(opened(current)))
                fields, payload = parsed(next(members))
                keep = {k: fields[k] for k in ("WARC-Target-URI", "WARC-Payload-Digest", "WARC-Page") if k in fields}
                if refers.as_py() is None:
                    data = record("response", payload, keep)
                else:
                    keep |= {"WARC-Profile": SERVER_PROFILE, "WARC-Refers-To-Page": str(refers.as_py()), "WARC-Payload-Length": str(size.as_py())}
                    data = record("revisit", b"", keep)
                names.add(archives.add(data)[0])
        archives.close()
        yield batch(FILES, [sorted(names)])

    rows = headers.select("file", "refers_to", "payload_bytes", "place")
    return rows.repartition("file").sortWithinPartitions("file", "place").select("file", "refers_to", "payload_bytes").mapInArrow(run, "file string")


def read_archives(files: DataFrame) -> DataFrame:
    """The records of archives (column file): page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload.

    The digest of a response is computed anew and must be the one in its header. A
    revisit's payload is null; bytes and digest are those of the payload it stands for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for file in rows.column(0):
                out, size = [[] for _ in range(7)], 0
                for data in Members(opened(file.as_py())):
                    fields, payload = parsed(data)
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload does not match its digest in {file}")
                    page, refers = fields.get("WARC-Page"), fields.get("WARC-Refers-To-Page")
                    values = (int(page) if page else None, as_written(fields["WARC-Target-URI"]), kind,
                              int(fields.get("WARC-Payload-Length", len(payload))), digest,
                              int(refers) if refers else None, payload if kind == "response" else None)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    size += len(payload)
                    if size > 1 << 24 or len(out[0]) >= 10_000:
                        yield batch(RECORDS, out)
                        out, size = [[] for _ in range(7)], 0
                yield batch(RECORDS, out)

    return files.select("file").mapInArrow(
        run, "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
    )


def deduplicated_archives(pages: DataFrame, **columns: str) -> DataFrame:
    """Pages written as WARC archives in the shared folder, revisits resolved; the names of the archives.

    An empty table gives no archive. Other columns of pages are not looked at.
    """
    spark: SparkSession = pages.sparkSession
    headers = stored(write_archives(pages, uri(new_folder(spark, "warc")), **columns), "warc-headers")
    resolved = resolve(headers)
    return stored(deduplicate(resolved, uri(new_folder(spark, "warc-deduplicated"))), "warc-files")


def oracle_sql(table: str = "pages") -> str:
    """DuckDB SQL for what read_archives gives of deduplicated_archives, without texts."""
    return f"""
        WITH p AS (SELECT page_id, octet_length(encode(COALESCE(html, '')))::BIGINT AS payload_bytes,
            sha256(COALESCE(html, '')) AS payload_digest FROM {table}),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id <> first THEN first END AS refers_to FROM f"""
