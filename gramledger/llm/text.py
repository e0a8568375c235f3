"""Words of texts as bytes, and small helpers the operators share.

Python tasks get texts as UTF-8 bytes. Folding A-Z and cutting at ASCII
separators is then a byte table, whatever the script of the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramledger.session import file_system, new_folder, tune

UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))

# A-Z folded, every byte outside [0-9a-z] and below 0x80 made a space.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
# A-Z folded, the six ASCII white-space bytes made a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 32 or 9 <= b <= 13 else b for b in range(256))

CHUNK = 1 << 22
SENT_ROWS = 1 << 22  # rejected rows, of an id and a hash, that are sent to all tasks at most: some 150 MB
CACHED_WORDS = 1 << 16
# Rows go to Python tasks in batches of so many bytes, however long the texts: a task, and the JVM beside it,
# hold a batch several times over. Where the session says nothing else.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def with_bounded_batches(spark: SparkSession) -> SparkSession:
    return tune(spark, BATCHES)


def utf8(column: str) -> Column:
    """A text column as bytes, without a check or a copy into Python strings."""
    return F.col(column).cast("string").cast("binary")


def split_words(data: bytes | None, table: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of a bounded size; table says what separates them."""
    if not data:
        return
    start, end = 0, len(data)
    while start < end:
        stop = min(end, start + CHUNK)
        piece = data[start:stop].translate(table)
        if stop < end:
            cut = piece.rfind(b" ")
            while cut < 0 and stop < end:  # one word longer than a chunk
                stop = min(end, stop + CHUNK)
                piece = data[start:stop].translate(table)
                cut = piece.rfind(b" ")
            if stop < end:
                piece = piece[:cut]
                stop = start + cut + 1
        start = stop
        yield piece.split()


class WordHashes(dict):
    """word -> 64-bit hash. Remembers a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def hashes_of(data: bytes | None, table: bytes, known: WordHashes) -> np.ndarray:
    """The 64-bit hashes of a text's words, in order."""
    parts = [np.fromiter(map(known.__getitem__, words), np.uint64, len(words)) for words in split_words(data, table)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer: every bit of the result depends on every bit of x (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    """Columns, arrays or lists, as one batch."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) and c.type == f.type else pa.array(c, f.type)
         for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def stored(df: DataFrame, purpose: str, parts: int | None = None) -> DataFrame:
    """df written to the shared folder and read back: computed once, and no lineage behind it.

    parts: most files, where the number of rows has a bound that makes do with so many.
    """
    folder = new_folder(df.sparkSession, purpose)
    (df.coalesce(parts) if parts else df).write.parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out.stored_in = folder
    return out


def without_rows(docs: DataFrame, rejected: DataFrame, *keys: Column) -> DataFrame:
    """docs without the rows whose keys are those of a rejected row, column by column; null equals null.

    The keys say all that the verdict depends on, so that each row is judged by what it holds itself.
    The texts stay where they are while the rejected are few enough, by count, for every task to have them.
    """
    names = [f"__rejected_{k}" for k in range(len(keys))]
    rejected = stored(rejected.toDF(*names).distinct(), "rejected")
    sent = F.broadcast(rejected) if rejected.count() <= SENT_ROWS else rejected
    return docs.join(sent, [key.eqNullSafe(F.col(name)) for key, name in zip(keys, names, strict=True)], "left_anti")


def forget(*tables: DataFrame) -> None:
    """Deletes tables that stored() has written, once all that reads them is stored itself."""
    for table in tables:
        fs, path = file_system(table.sparkSession, table.stored_in)
        fs.delete(path, True)
