"""Masked pseudo-likelihood of texts by a bidirectional window network.

Every token is predicted from the SIDE tokens before and after it, never from itself:
context tokens are looked up in one table per place, summed, passed through tanh and
mapped to all token classes. Classes are the WORDS most frequent words of the whole
corpus and BUCKETS hash classes for all others. The probability of a token is that of its
class by the network, times that of the word among the words of its class by the counts
of the whole corpus; a text's score is the sum of the logarithms over its tokens.

With N tokens and V different words in a hash class, a word counted n times has
(n + (V + 1) q) / (N + V + 1) of it; q, the share of a word among new ones, is that of its
letters drawn one by one. Words of at least 1 / HEAD of all tokens are HEAD at most: tasks
know their counts. All others are joined with the table of counts.

Word counts cover all texts. Every task trains on all texts it reads, from common
starting weights; the weights of the tasks are averaged, by tokens, and the next round
starts from there.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramledger.llm.text import CACHED_WORDS, TERM_BYTES, batch, split_words, stored, utf8

WORDS, BUCKETS = 96, 32
CLASSES = WORDS + BUCKETS
OUTSIDE = CLASSES  # stands before and after a text
SIDE = 2
PLACES = tuple(k for k in range(-SIDE, SIDE + 1) if k)
HIDDEN = 16
STEP = 1024  # tokens per gradient step
RATE = 1.0
HEAD = 1 << 19  # tasks hold the counts of words that are no rarer than one token in so many
LETTERS = 164  # bytes that words are made of
COUNTED_WORDS = 1 << 18  # different words a task counts before it hands them on
ONES, UNITS = np.ones(CLASSES, np.float32), np.arange(HIDDEN)


class Classes(dict):
    """word -> class. Remembers a bounded number of words besides the frequent ones."""

    def __init__(self, words: list[bytes]):
        super().__init__({w: k for k, w in enumerate(words)})
        self.words = words

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
            self.update((w, k) for k, w in enumerate(self.words))
            if word in self:
                return self[word]
        value = self[word] = bucket(word)
        return value

    def of(self, text: bytes | None) -> np.ndarray:
        parts = [self.among(words) for words in split_words(text, TERM_BYTES)]
        return np.concatenate(parts) if parts else np.empty(0, np.int16)

    def among(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int16, len(words))


def bucket(word: bytes) -> int:
    return WORDS + xxhash.xxh64_intdigest(word, 5) % BUCKETS


@dataclass
class Network:
    """tables: one (CLASSES + 1, HIDDEN) per place; out: (HIDDEN, CLASSES); bias: (CLASSES,)."""

    tables: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    room: np.ndarray | None = None

    @staticmethod
    def start(frequency: np.ndarray) -> Network:
        """Small weights, and the logarithm of the class frequencies as bias."""
        draw = np.random.default_rng(3)
        tables = draw.normal(0, 0.3, (len(PLACES), CLASSES + 1, HIDDEN)).astype(np.float32)
        out = draw.normal(0, 0.1, (HIDDEN, CLASSES)).astype(np.float32)
        return Network(tables, out, np.log((frequency + 1) / (frequency.sum() + CLASSES)).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.tables.ravel(), self.out.ravel(), self.bias])

    @staticmethod
    def of(flat: np.ndarray) -> Network:
        n, m = len(PLACES) * (CLASSES + 1) * HIDDEN, HIDDEN * CLASSES
        flat = flat.astype(np.float32)
        return Network(flat[:n].reshape(len(PLACES), CLASSES + 1, HIDDEN).copy(), flat[n : n + m].reshape(HIDDEN, CLASSES).copy(), flat[n + m :].copy())

    def hidden(self, contexts: list[np.ndarray]) -> np.ndarray:
        total = self.tables[0].take(contexts[0], axis=0)
        for t, c in zip(self.tables[1:], contexts[1:], strict=True):
            total += t.take(c, axis=0)
        return np.tanh(total, out=total)

    def _scores(self, hidden: np.ndarray) -> np.ndarray:
        """The scores of all classes, low enough for their exponentials, in an array that the next call takes again."""
        if self.room is None or len(self.room) < len(hidden):
            self.room = np.empty((len(hidden), CLASSES), np.float32)
        scores = np.matmul(hidden, self.out, out=self.room[: len(hidden)])
        scores += self.bias
        if scores.max() > 60:
            scores -= scores.max(axis=1, keepdims=True)
        return scores

    def log_probabilities(self, contexts: list[np.ndarray], targets: np.ndarray) -> np.ndarray:
        scores = self._scores(self.hidden(contexts))
        own = scores[np.arange(len(targets)), targets]
        return own - np.log(np.exp(scores, out=scores) @ ONES)

    def learn(self, contexts: list[np.ndarray], targets: np.ndarray, rate: float) -> None:
        """One gradient step on the mean log-probability of the targets."""
        n = len(targets)
        hidden = self.hidden(contexts)
        error = self._scores(hidden)
        np.exp(error, out=error)
        error /= (error @ ONES)[:, None]
        error[np.arange(n), targets] -= 1
        inner = (error @ self.out.T) * (1 - hidden * hidden)
        self.out -= rate / n * (hidden.T @ error)
        self.bias -= rate / n * (np.ones(n, np.float32) @ error)
        weights = inner.ravel().astype(np.float64)
        for table, context in zip(self.tables, contexts, strict=True):
            # Rare context tokens move as far as frequent ones do: the sum over a token by the root of its count.
            at = (context.astype(np.int64)[:, None] * HIDDEN + UNITS).ravel()
            sums = np.bincount(at, weights, table.size).reshape(table.shape)
            counts = np.bincount(context, minlength=len(table))[:, None]
            table -= (rate / 8 * sums / np.sqrt(np.maximum(counts, 1) * n)).astype(np.float32)


def padded(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts in one array, apart by SIDE times OUTSIDE, and which places in it are tokens."""
    gap = np.full(SIDE, OUTSIDE, np.int16)
    whole = np.concatenate([gap, *(x for t in texts for x in (t, gap))])
    return whole, np.flatnonzero(whole != OUTSIDE) - SIDE


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """word, n: how often each word stands in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
        counts: Counter[bytes] = Counter()
        for rows in batches:
            for value in rows.column(0):
                for words in split_words(value.as_py(), TERM_BYTES):
                    counts.update(words)
                    if len(counts) > COUNTED_WORDS:
                        yield batch(schema, [list(counts), list(counts.values())])
                        counts.clear()
        yield batch(schema, [list(counts), list(counts.values())])

    rows = docs.select(utf8(text).alias("text")).mapInArrow(count, "word binary, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


TRAINED = pa.schema([("weights", pa.binary()), ("tokens", pa.int64())])


def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the mean of the weights of all rows, by tokens."""
    total, tokens = None, 0
    for rows in batches:
        for weights, n in zip(rows.column(0), rows.column(1), strict=True):
            part = np.frombuffer(weights.as_py(), np.float64) * n.as_py()
            total = part if total is None else total + part
            tokens += n.as_py()
    if tokens:
        yield batch(TRAINED, [[(total / tokens).tobytes()], [tokens]])


@dataclass
class Model:
    """counts: (word, n) of the whole corpus; tokens, kinds: how many of them and how many different ones each class has."""

    words: list[bytes]
    network: Network
    counts: DataFrame
    tokens: np.ndarray
    kinds: np.ndarray


def fit(docs: DataFrame, *, text: str = "text", rounds: int = 1) -> Model:
    """Counts the words of all texts, then trains on all of them, `rounds` times over.

    Without a word in the table the network keeps its starting weights.
    """
    counts = stored(word_counts(docs, text), "word-counts")
    top = [(bytes(r.word), r.n) for r in counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()]
    frequent = counts.sparkSession.createDataFrame([(w,) for w, _ in top], "word binary")

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, CLASSES), np.int64)
        for rows in batches:
            for word, n in zip(rows.column(0), rows.column(1), strict=True):
                sums[:, bucket(word.as_py())] += n.as_py(), 1
        schema = pa.schema([("class", pa.int32()), ("n", pa.int64()), ("kinds", pa.int64())])
        yield batch(schema, [list(range(WORDS, CLASSES)), *sums[:, WORDS:].tolist()])

    # No more than WORDS rows: that is the bound for sending them to all tasks.
    rest = counts.join(F.broadcast(frequent), "word", "left_anti").mapInArrow(share, "class int, n bigint, kinds bigint")
    frequency, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    frequency[: len(top)], kinds[: len(top)] = [n for _, n in top], 1
    for r in rest.groupBy("class").agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds")).collect():
        frequency[r["class"]], kinds[r["class"]] = r.n, r.kinds
    words = [w for w, _ in top]
    network = Network.start(frequency)
    lanes = 16
    for k in range(rounds):
        sent = docs.sparkSession.sparkContext.broadcast((words, network.flat()))

        def train(batches: Iterator[pa.RecordBatch], sent=sent, rate=RATE / (1 + k)) -> Iterator[pa.RecordBatch]:
            classes, mine, tokens = Classes(sent.value[0]), Network.of(sent.value[1]), 0
            for whole in batches:
                for start in range(0, whole.num_rows, 256):
                    line, at = padded([classes.of(t.as_py()) for t in whole.slice(start, 256).column(0)])
                    for i in range(0, len(at), STEP):
                        here = at[i : i + STEP] + SIDE
                        mine.learn([line[here + p] for p in PLACES], line[here], rate)
                    tokens += len(at)
            if tokens:
                yield batch(TRAINED, [[mine.flat().astype(np.float64).tobytes()], [tokens]])

        parts = stored(docs.select(utf8(text).alias("text")).mapInArrow(train, "weights binary, tokens bigint"), "lm-weights")
        # Averaged in two steps: no task takes in more than its share of the weights.
        lane = parts.repartition(lanes).mapInArrow(averaged, "weights binary, tokens bigint")
        mean = lane.repartition(1).mapInArrow(averaged, "weights binary, tokens bigint").collect()
        if mean:
            network = Network.of(np.frombuffer(mean[0].weights, np.float64))
    return Model(words, network, counts, frequency, kinds)


SCORED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("log_likelihood", pa.float64())])


def text_scores(texts: list[np.ndarray], network: Network) -> np.ndarray:
    """The summed log-probability of the tokens of each text."""
    line, at = padded(texts)
    found = np.zeros(len(at) + 1)
    for start in range(0, len(at), STEP):
        here = at[start : start + STEP] + SIDE
        found[start + 1 : start + 1 + len(here)] = network.log_probabilities([line[here + p] for p in PLACES], line[here])
    up_to = np.cumsum(found)
    ends = np.cumsum([0, *map(len, texts)])
    return up_to[ends[1:]] - up_to[ends[:-1]]


def scores(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As word_scores(), by the network alone: of each token only its class is predicted."""
    sent = docs.sparkSession.sparkContext.broadcast((model.words, model.network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, network = Classes(sent.value[0]), sent.value[1]
        for rows in batches:
            texts = [classes.of(t.as_py()) for t in rows.column(1)]
            yield batch(SCORED, [rows.column(0), [len(t) for t in texts], text_scores(texts, network)])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text"))
    out = rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, log_likelihood double")
    return out.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))


PARTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("log_likelihood", pa.float64()), ("row", pa.int64()),
                   ("words", pa.list_(pa.binary())), ("times", pa.list_(pa.int64())), ("fresh", pa.list_(pa.float64()))])
SLICE = 256


def new_word(word: bytes, kinds: float) -> float:
    """The logarithm of what a hash class sets aside for a word as a new one, in tokens. Its words are one in BUCKETS of all."""
    return math.log((kinds + 1) * BUCKETS) - (len(word) + 1) * math.log(LETTERS + 1)


class Codes(dict):
    """word -> code: the frequent words, then the common ones whose counts are known, then one code for the others of each bucket."""

    def __init__(self, words: list[bytes], head: dict[bytes, int]):
        self.common = [w for w in head if w not in set(words)]
        self.fixed = {w: k for k, w in enumerate([*words, *self.common])}
        self.rare = len(self.fixed)
        super().__init__(self.fixed)

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.rare + CACHED_WORDS:
            self.clear()
            self.update(self.fixed)
            if word in self:
                return self[word]
        value = self[word] = self.rare + bucket(word) - WORDS
        return value


def word_scores(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, log_likelihood (summed), mean_log_likelihood: one row per row of docs.

    Null, empty and word-less texts have no tokens, log_likelihood 0 and a null mean.
    Repeated rows give repeated results; a null doc_id stays null; an empty table gives
    no rows. Other columns are not read. What the network has learnt depends in its last
    digits on which texts were in one task.
    """
    # At most HEAD words have so large a share.
    common = model.counts.where(F.col("n") * HEAD >= int(model.tokens.sum())).collect()
    head = {bytes(r.word): r.n for r in common}
    sent = docs.sparkSession.sparkContext.broadcast((model.words, model.network, head, model.tokens, model.kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, network, head, tokens, kinds = sent.value
        codes = Codes(words, head)
        # By code: the class, and the logarithm of the share in it; that of a word to be looked up lacks its count.
        whole = np.log(tokens + kinds + 1)
        class_of = np.array([*range(len(words)), *map(bucket, codes.common), *range(WORDS, CLASSES)], np.int16)
        share_of = np.zeros(len(class_of))
        for code, w in enumerate(codes.common, len(words)):
            share_of[code] = math.log(head[w] + math.exp(new_word(w, kinds[class_of[code]]))) - float(whole[class_of[code]])
        share_of[codes.rare :] = -whole[WORDS:]
        for rows in (r.slice(k, SLICE) for r in batches for k in range(0, r.num_rows, SLICE)):
            out, lines = [], []
            for value in rows.column(1):
                parts, inside, rare = [np.empty(0, np.int16)], 0.0, Counter()
                for some in split_words(value.as_py(), TERM_BYTES):
                    found = np.fromiter(map(codes.__getitem__, some), np.int32, len(some))
                    parts.append(class_of[found])
                    inside += float(share_of[found].sum())
                    rare.update(some[k] for k in np.flatnonzero(found >= codes.rare).tolist())
                lines.append(np.concatenate(parts))
                own = [int(class_of[codes[w]]) for w in rare]
                out.append((len(lines[-1]), inside, list(rare), list(rare.values()), [new_word(w, kinds[k]) for w, k in zip(rare, own, strict=True)]))
            n, inside, rare, times, fresh = zip(*out, strict=True)
            value = text_scores(lines, network) + inside
            yield batch(PARTS, [rows.column(0), n, value, rows.column(2), rare, times, fresh])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    schema = "doc_id bigint, n_tokens bigint, log_likelihood double, row bigint, words array<binary>, times array<bigint>, fresh array<double>"
    # Stored, for the numbers of the rows to be the same whenever they are read.
    parts = stored(rows.mapInArrow(run, schema), "lm-parts")
    rare = parts.select("row", F.explode(F.arrays_zip("words", "times", "fresh")).alias("r")).select("row", F.col("r.words").alias("word"), "r.times", "r.fresh")
    counted = rare.join(model.counts, "word", "left")
    share = F.when(F.col("n").isNull(), F.col("fresh")).otherwise(F.log(F.col("n") + F.exp("fresh")))
    inside = counted.groupBy("row").agg(F.sum(F.col("times") * share).alias("inside"))
    out = parts.select("row", "doc_id", "n_tokens", "log_likelihood").join(inside, "row", "left")
    out = out.select("doc_id", "n_tokens", (F.col("log_likelihood") + F.coalesce("inside", F.lit(0.0))).alias("log_likelihood"))
    return out.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
