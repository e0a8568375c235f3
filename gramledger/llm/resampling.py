"""Importance resampling towards a target distribution.

1. Features of all documents and of all target texts are counted by hash bucket; a
   bucket's gain is the logarithm of its share in the target over that in the documents.
2. One array of gains scores every document: the sum over its features, and Gumbel noise
   drawn from its id, so that the highest scores are a sample by importance.
3. The cutoff lies at a known rank. A quantile sketch of the scores brackets it; the
   rows above and within the bracket are counted exactly, and it is widened if the
   cutoff is not inside. Only what lies in the bracket is sorted to find the cutoff.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from gramledger.llm.order import numbered
from gramledger.llm.text import CACHED_WORDS, TERM_BYTES, batch, split_words, stored, utf8

ACCURACY = 10_000  # of the sketch: ranks are wrong by one in so many at most


@dataclass(frozen=True)
class Options:
    """Features are runs of 1 to longest words. drawn of 100 documents with least_words words or more are drawn."""

    longest: int = 1
    buckets: int = 10_000
    least_words: int = 20
    drawn: int = 10
    seed: str = "2024"

    def __post_init__(self):
        if self.longest < 1 or self.buckets < 1 or not 0 <= self.drawn <= 100:
            raise ValueError("longest and buckets must be positive, drawn a percentage")


class WordBuckets(dict):
    """word -> bucket. Remembers a bounded number of words."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = zlib.crc32(word) % self.buckets
        return value


def features(data: bytes | None, known: WordBuckets, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """The words and the buckets of the features of a text, in parts of a bounded size."""
    last: list[bytes] = []  # words a run may have begun with
    for words in split_words(data, TERM_BYTES):
        found = [np.fromiter(map(known.__getitem__, words), np.int64, len(words))]
        if longest > 1:
            line, runs = last + words, []
            for end in range(len(last), len(line)):
                run = line[end]
                for begin in range(end - 1, max(-1, end - longest), -1):
                    run = line[begin] + b" " + run
                    runs.append(zlib.crc32(run) % known.buckets)
            found.append(np.array(runs, np.int64))
            last = line[max(0, len(line) - longest + 1) :]
        yield len(words), np.concatenate(found)


COUNTS = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])


def bucket_counts(texts: DataFrame, options: Options, *, text: str = "text") -> np.ndarray:
    """How many features of all texts each bucket holds. A task hands on one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = WordBuckets(options.buckets), np.zeros(options.buckets, np.int64)
        for rows in batches:
            for value in rows.column(0):
                for _, found in features(value.as_py(), known, options.longest):
                    sums += np.bincount(found, minlength=options.buckets)
        here = np.flatnonzero(sums)
        yield batch(COUNTS, [here, sums[here]])

    rows = texts.select(utf8(text).alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(options.buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # as many as there are buckets
        out[r.bucket] = r.n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of each bucket's share in the target over that in the documents, both counted one higher."""
    n = len(documents)
    all_documents, all_target = float(documents.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_documents / ((s + 1.0) * all_target)))
                     for s, t in zip(documents.tolist(), target.tolist(), strict=True)], np.int64)


def noise(seed: str, name: str) -> int:
    """1000 times a draw from the Gumbel distribution that belongs to a document's id."""
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = pa.schema([(c, pa.int64()) for c in ("row", "doc_id", "n_words", "n_features", "weight", "score")])


def scored(docs: DataFrame, gain: np.ndarray, options: Options, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row, doc_id, n_words, n_features, weight, score of every row of docs. The gains go to the tasks: 8 bytes a bucket."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, array = WordBuckets(options.buckets), sent.value
        for rows in batches:
            out = []
            for row, name, value in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(2), strict=True):
                n_words = n_features = weight = 0
                for n, found in features(value.as_py(), known, options.longest):
                    n_words += n
                    n_features += len(found)
                    weight += int(array[found].sum())
                out.append((row, name, n_words, n_features, weight, weight + noise(options.seed, "" if name is None else str(name))))
            if out:
                yield batch(SCORED, list(zip(*out, strict=True)))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text"))
    return rows.mapInArrow(run, "row bigint, doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def _order() -> list[Column]:
    """Highest score first, then smallest id; what follows settles ties between rows of one id."""
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("row").asc()]


def bracket(rows: DataFrame, n: int, k: int) -> tuple[int | None, int | None, int]:
    """(low, high, above): scores between which the k-th highest of n lies, and how many are higher than high.

    None: no bound on that side. The sketch says where to look; only exact counts decide.
    """
    width = 2.0 / ACCURACY
    while True:
        places = [1 - k / n - width, 1 - (k - 1) / n + width]
        low, high = rows.agg(F.percentile_approx("score", [min(max(p, 0.0), 1.0) for p in places], ACCURACY).alias("q")).first().q
        low, high = (low if places[0] > 0 else None), (high if places[1] < 1 else None)
        above = F.lit(False) if high is None else F.col("score") > high
        reached = F.lit(True) if low is None else F.col("score") >= low
        found = rows.agg(F.count_if(above).alias("above"), F.count_if(reached).alias("reached")).first()
        if found.above < k <= found.reached:
            return low, high, found.above
        width *= 2


def cutoff(rows: DataFrame, k: int, n: int) -> Row:
    """The k-th of n rows in the order of scores."""
    low, high, above = bracket(rows, n, k)
    inside = rows
    if low is not None:
        inside = inside.where(F.col("score") >= low)
    if high is not None:
        inside = inside.where(F.col("score") <= high)
    return numbered(inside, *_order(), name="place").where(F.col("place") == k - above).first()


def not_after(last: Row) -> Column:
    """Whether a row comes before another in the order of scores, or is that row."""
    score, row, n = F.col("score"), F.col("row"), F.col("n_features")
    id_ = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    last_id = F.lit((1 << 63) - 1 if last.doc_id is None else last.doc_id)
    nulls, last_null = F.col("doc_id").isNull(), F.lit(last.doc_id is None)
    return (score > last.score) | (score == last.score) & (
        (id_ < last_id) | (id_ == last_id) & ((nulls < last_null) | (nulls == last_null) & (
            (n < last.n_features) | (n == last.n_features) & (row <= last.row))))


def resample(docs: DataFrame, target: DataFrame, options: Options = Options(), *, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank: one row per row of docs; rank is null for what is not drawn.

    Null, empty and word-less texts have no features and the weight 0. Documents with fewer
    than least_words words are never drawn. Of equal scores the smaller doc_id comes first,
    a null one (whose noise is that of an empty id) last; repeated rows have ranks of their
    own. An empty table gives no rows; an empty target draws by noise and by how rare the
    features are. Other columns are not read.
    """
    gain = gains(bucket_counts(docs, options, text=text), bucket_counts(target, options, text=target_text))
    rows = stored(scored(docs, gain, options, doc_id=doc_id, text=text), "resample-scores")
    enough = F.col("n_words") >= options.least_words
    able = rows.where(enough)
    n = able.count()
    k = n * options.drawn // 100
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    if not k:
        return rows.select(*columns, none)
    drawn = enough & not_after(cutoff(able, k, n))
    ranked = numbered(rows.where(drawn), *_order(), name="rank")
    return ranked.select(*columns, "rank").unionByName(rows.where(~drawn).select(*columns, none))


def oracle_sql(docs: str = "documents", target: str = "benchmark", options: Options = Options()) -> str:
    """DuckDB SQL for the query of resample(), for runs of one word. The CRC of a word is that of its bytes one by one."""
    if options.longest != 1:
        raise ValueError("the SQL counts single words")
    words = (
        "regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    m = options.buckets
    return f"""
        WITH crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) r(i))),
        d AS (SELECT row_number() OVER () AS row, doc_id, {words} AS w FROM {docs}),
        td AS (SELECT row, unnest(w) AS word FROM d),
        tb AS (SELECT unnest({words}) AS word FROM {target}),
        hexed AS (SELECT word, hex(word) AS h FROM (SELECT word FROM td UNION SELECT word FROM tb)),
        lists AS (SELECT word, list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT) AS b FROM hexed),
        hashed AS (SELECT word, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % {m} AS bucket
            FROM lists, crc),
        s AS (SELECT bucket, count(*) AS s FROM td JOIN hashed USING (word) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM tb JOIN hashed USING (word) GROUP BY bucket),
        gain AS (SELECT bucket, floor(1000 * ln((COALESCE(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM td) + {m})::DOUBLE
                / ((COALESCE(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM tb) + {m})::DOUBLE)))::BIGINT AS gain
            FROM s FULL JOIN t USING (bucket)),
        weighed AS (SELECT row, sum(gain)::BIGINT AS weight FROM td JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY row),
        scored AS (SELECT row, doc_id, len(w)::BIGINT AS n_features, COALESCE(weight, 0) AS weight,
                COALESCE(weight, 0) + floor(-1000::DOUBLE * ln(-ln((('0x' || substr(sha256('{options.seed}:' || COALESCE(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE
                    + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
            FROM d LEFT JOIN weighed USING (row)),
        ranked AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST, n_features) AS rank, count(*) OVER () AS n
            FROM scored WHERE n_features >= {options.least_words})
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {options.drawn} * n // 100 THEN rank END AS rank
        FROM scored LEFT JOIN ranked USING (row)"""
