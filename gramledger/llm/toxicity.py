"""Toxicity scores by FTRL-proximal logistic regression over hashed words.

Features of a text: its distinct words, word pairs, pairs with one word skipped, and
the beginnings of its words (5, 7 and 9 bytes, so that forms of a word share
something), hashed to 2^DIMENSION_BITS coordinates; present or not. Every coordinate
has a learning rate of its own, and the L1 term keeps most weights at zero, so the
model that goes to the tasks is small whatever was learnt from.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from tempfile import TemporaryFile
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramledger.llm.text import CACHED_WORDS, TERM_BYTES, WordHashes, batch, mixed, split_words, utf8

DIMENSION_BITS = 20
THRESHOLD = 0.3
BEGINNINGS = (5, 7, 9)
PAIR, SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Ftrl:
    """alpha, beta: learning rate; l1, l2: regularization; sample: most rows that are learnt from."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 1.0
    epochs: int = 4
    sample: int = 32_768
    bits: int = DIMENSION_BITS


@dataclass(frozen=True)
class Model:
    """Coordinates with a weight other than zero, their weights, and the intercept."""

    at: np.ndarray
    weights: np.ndarray
    intercept: float
    bits: int

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float64)
        out[self.at] = self.weights
        return out


class Beginnings(dict):
    """word -> hash of its first `size` bytes, 0 for words that are no longer than that."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word[: self.size], self.size) if len(word) > self.size else 0
        return value


class Hashing:
    """Coordinates of texts. Remembers a bounded number of words."""

    def __init__(self, bits: int):
        self.bits, self.words, self.beginnings = bits, WordHashes(), [Beginnings(k) for k in BEGINNINGS]

    def __call__(self, text: bytes | None) -> np.ndarray:
        """The coordinates of a text's features, with repeats."""
        parts = [[] for _ in range(1 + len(BEGINNINGS))]
        for words in split_words(text, TERM_BYTES):
            for part, known in zip(parts, (self.words, *self.beginnings), strict=True):
                part.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        if not parts[0]:
            return np.empty(0, np.int64)
        words, *begun = (np.concatenate(p) for p in parts)
        found = [words, words[:-1] * PAIR + words[1:], words[:-2] * SKIP + words[2:], *(b[b != 0] for b in begun)]
        return (mixed(np.concatenate(found)) >> np.uint64(64 - self.bits)).astype(np.int64)


def train(rows: Iterable[tuple[bytes | None, int]], options: Ftrl) -> Model:
    """Learns from (text, label) in the given order, several times over.

    Each text is read once; what is learnt from it lies in a temporary file, and the texts are not held.
    """
    with TemporaryFile() as file:
        return fitted(file, *features(rows, file, Hashing(options.bits)), options)


def features(rows: Iterable[tuple[bytes | None, int]], file: BinaryIO, coordinates: Hashing) -> tuple[list[int], list[int]]:
    """Writes the distinct coordinates of every text to the file. Returns how many each has, and the labels."""
    sizes, labels = [], []
    for text, label in rows:
        at = np.unique(coordinates(text)).astype(np.int32)
        file.write(at.tobytes())
        sizes.append(len(at))
        labels.append(label)
    return sizes, labels


def fitted(file: BinaryIO, sizes: list[int], labels: list[int], options: Ftrl) -> Model:
    prior = (sum(labels) + 0.5) / (len(labels) + 10)
    intercept, seen = float(np.log(prior / (1 - prior))), 0.0
    z, n = np.zeros(1 << options.bits), np.zeros(1 << options.bits)

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        rate = (options.beta + np.sqrt(n[at])) / options.alpha + options.l2
        return np.where(np.abs(zi) <= options.l1, 0.0, (np.sign(zi) * options.l1 - zi) / rate)

    for _ in range(options.epochs):
        file.seek(0)
        for size, label in zip(sizes, labels, strict=True):
            at = np.frombuffer(file.read(4 * size), np.int32)
            w = weights(at)
            error = 1 / (1 + np.exp(-np.clip(w.sum() + intercept, -35, 35))) - label
            square = error * error
            root = np.sqrt(n[at])
            z[at] += error - (np.sqrt(n[at] + square) - root) / options.alpha * w
            n[at] += square
            seen += square
            intercept -= options.alpha / (options.beta + np.sqrt(seen)) * error
    every = np.arange(1 << options.bits)
    w = weights(every)
    at = np.flatnonzero(w)
    return Model(at, w[at], intercept, options.bits)


class Scorer:
    def __init__(self, model: Model):
        self.coordinates, self.dense, self.intercept = Hashing(model.bits), model.dense(), model.intercept

    def __call__(self, text: bytes | None) -> float:
        at = self.coordinates(text)
        at = np.unique(at[self.dense[at] != 0])
        return float(1 / (1 + np.exp(-np.clip(self.dense[at].sum() + self.intercept, -35, 35))))


def held_out(doc_id: Column) -> Column:
    """Rows no label is learnt from: crc32 of the id as text leaves 2 on division by 4. A null id is not one."""
    return F.coalesce(F.crc32(doc_id.cast("bigint").cast("string")) % 4 == 2, F.lit(False))


def learn(
    docs: DataFrame, labels: DataFrame, options: Ftrl = Ftrl(), *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model:
    """A model of `label` from the documents that have one and are not held out.

    At most options.sample labelled ids are taken, those whose hashes come first; they
    are learnt from in that order by one task. Null labels, null ids and held-out ids
    are left out; of several labels for an id the largest counts. Rows that repeat an id
    are read once, the one whose text comes first. Without labelled rows the model has
    no weights and every score is that of the prior, below the threshold.
    """
    chosen = (
        labels.select(F.col(doc_id).cast("bigint").alias("key"), F.col(label).cast("int").alias("label"))
        .where(F.col("key").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("key")))
        .groupBy("key").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("key"), "key").limit(options.sample)
    )
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), utf8(text).alias("text"))
    # No more than options.sample rows of 12 bytes: that is the bound for sending them to all tasks.
    rows = rows.join(F.broadcast(chosen), F.col("id") == F.col("key"))
    rows = rows.groupBy("id", "label").agg(F.min("text").alias("text"))
    rows = rows.select("text", "label", F.xxhash64("id").alias("hash"), "id").coalesce(1).sortWithinPartitions("hash", "id")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ((t.as_py(), min(max(y.as_py(), 0), 1)) for b in batches for t, y in zip(b.column(0), b.column(1), strict=True))
        model = train(pairs, options)
        at = [*model.at.tolist(), -1]
        yield batch(pa.schema([("at", pa.int64()), ("w", pa.float64())]), [at, [*model.weights.tolist(), model.intercept]])

    found = {r.at: r.w for r in rows.mapInArrow(fit, "at bigint, w double").collect()}  # 2^bits rows at most
    if not found:
        return train([], options)
    intercept = found.pop(-1)
    at = np.array(sorted(found), np.int64)
    return Model(at, np.array([found[i] for i in at.tolist()]), intercept, options.bits)


SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])


def scores(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: likelier toxic), predicted: one row per row of docs.

    Null, empty and word-less texts have the score of the intercept alone. Repeated
    rows give repeated results; a null doc_id stays null. Other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(sent.value)
        for rows in batches:
            yield batch(SCORED, [rows.column(0), rows.column(1), [score(t.as_py()) for t in rows.column(2)]])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), utf8(text).alias("text"))
    out = rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without those scored at or above the threshold, by a model learnt from the labelled ones among them."""
    model = learn(docs, labels, doc_id=doc_id, text=text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def toxic(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = Scorer(sent.value)
        for texts in batches:
            yield pa.array([score(t.as_py()) for t in texts], pa.float64())

    return docs.where(toxic(utf8(text)) < threshold)
