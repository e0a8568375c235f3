"""Benchmark decontamination by word suffix arrays over the training texts.

Every task takes its texts in shards of a bounded number of words, sorts the
suffixes of a shard that can hold a benchmark window, and looks up every
benchmark suffix by binary search. Benchmark words come to the tasks in blocks
of a bounded size; each block is one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramledger.llm.text import TERM_BYTES, batch, split_words, stored, utf8, without_rows

WINDOW = 13
SHARD_WORDS = 1 << 21
BLOCK_WORDS = 1 << 22
NO_WORD = 0  # a word no benchmark item has, and the end of a text

MATCHES = pa.schema(
    [("row", pa.int64()), ("id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(pa.int64())),
     ("items", pa.list_(pa.string())), ("longest", pa.int64())]
)


@dataclass(frozen=True)
class TestSet:
    """Items of one block: words numbered from 1, all items in one array, NO_WORD between them."""

    numbers: dict[bytes, int]
    words: np.ndarray
    starts: np.ndarray  # where the windows begin
    lengths: np.ndarray  # words in the window that begins there
    names: list[str | None]
    owners: np.ndarray  # index into names, by window

    @staticmethod
    def of(items: list[tuple[str | None, bytes | None]], window: int) -> TestSet:
        numbers: dict[bytes, int] = {}
        words: list[int] = []
        starts, lengths, owners = [], [], []
        for k, (_, text) in enumerate(items):
            own = [numbers.setdefault(w, len(numbers) + 1) for part in split_words(text, TERM_BYTES) for w in part]
            size = min(window, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                starts.append(len(words) + i)
                lengths.append(size)
                owners.append(k)
            words += [*own, NO_WORD]
        return TestSet(numbers, np.array(words, np.int32), np.array(starts, np.int64), np.array(lengths, np.int64),
                       [name for name, _ in items], np.array(owners, np.int64))


def suffix_array(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The positions `at`, sorted by the up to `depth` words that follow each.

    Rank doubling over the positions and what they reach: ranks by 2k words come from
    ranks by k words. NO_WORD ends a suffix; `words` must end with it.
    """
    rank = words.astype(np.int64)
    span = 1
    while span < depth:
        after = np.zeros_like(rank)
        after[:-span] = rank[span:]
        after[rank == 0] = 0
        rank = np.unique(rank * (len(rank) + rank.max() + 2) + after, return_inverse=True)[1]
        span *= 2
    return at[np.argsort(rank[at], kind="stable")]


def find(words: np.ndarray, order: np.ndarray, tests: TestSet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every test window the range of `order` whose suffixes begin with it, and how many of its words matched.

    Binary search, for all windows at once: after d rounds a range holds the
    suffixes that share the first d words; the next word is sorted within it.
    """
    n = len(tests.starts)
    low, high = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    matched = np.zeros(n, np.int64)
    last = len(words) - 1
    live = np.arange(n) if len(order) else np.empty(0, np.int64)

    def bound(first: np.ndarray, end: np.ndarray, depth: int, value: np.ndarray, after: bool) -> np.ndarray:
        first, end = first.copy(), end.copy()
        while (open_ := first < end).any():
            middle = (first + end) // 2
            seen = words[np.minimum(order[np.minimum(middle, len(order) - 1)] + depth, last)]
            right = open_ & ((seen <= value) if after else (seen < value))
            first[right] = middle[right] + 1
            left = open_ & ~right
            end[left] = middle[left]
        return first

    for depth in range(int(tests.lengths.max(initial=0))):
        live = live[tests.lengths[live] > depth]
        if not len(live):
            break
        value = tests.words[tests.starts[live] + depth]
        first = bound(low[live], high[live], depth, value, after=False)
        end = bound(first, high[live], depth, value, after=True)
        low[live], high[live] = first, end
        live = live[first < end]
        matched[live] = depth + 1
    return low, high, matched


def shard_hits(words: np.ndarray, tests: TestSet) -> tuple[np.ndarray, np.ndarray]:
    """(position, window) of every place in `words` where a window of the test set stands."""
    if not len(tests.starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # Only a suffix that goes on for the shortest window with benchmark words can hold one.
    stops = np.flatnonzero(np.append(words, NO_WORD) == NO_WORD)
    run = stops[np.searchsorted(stops, np.arange(len(words)))] - np.arange(len(words))
    at = np.flatnonzero(run >= tests.lengths.min())
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    reach = int(tests.lengths.max())
    keep = np.zeros(len(words) + 1, bool)  # positions that suffixes in `at` read
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, np.minimum(at + reach, len(words)), -1)
    keep[:-1] = np.cumsum(edges[:-1]) > 0
    kept = np.flatnonzero(keep[:-1])
    gaps = np.flatnonzero(np.diff(kept) > 1) + 1
    dense = np.append(np.insert(words[kept], gaps, NO_WORD), NO_WORD)
    place = np.append(np.insert(kept, gaps, -1), -1)  # where a word of `dense` stands in `words`
    wanted = np.zeros(len(words), bool)
    wanted[at] = True
    order = suffix_array(dense, np.flatnonzero((place >= 0) & wanted[place]), reach)
    low, high, matched = find(dense, order, tests)
    full = np.flatnonzero(matched == tests.lengths)
    if not len(full):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    counts = (high - low)[full]
    offsets = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return place[order[np.repeat(low[full], counts) + offsets]], np.repeat(full, counts)


class Document:
    """What is found in one text, over all its shards."""

    def __init__(self, row: int, name: int | None):
        self.row, self.name, self.n_words = row, name, 0
        self.marks: list[tuple[np.ndarray, np.ndarray]] = []  # begins and ends, exclusive, of hits
        self.items: set[int] = set()

    def add(self, begins: np.ndarray, windows: np.ndarray, tests: TestSet) -> None:
        pairs = np.unique(np.stack([begins, begins + tests.lengths[windows]]), axis=1)
        self.marks.append((pairs[0], pairs[1]))
        self.items.update(np.unique(tests.owners[windows]).tolist())

    def spans(self) -> list[int]:
        """Begin, end, begin, end, ... of the hit words, merged and in order."""
        if not self.marks:
            return []
        begins, ends = np.concatenate([m[0] for m in self.marks]), np.concatenate([m[1] for m in self.marks])
        order = np.argsort(begins, kind="stable")
        begins, ends = begins[order], np.maximum.accumulate(ends[order])
        first = np.flatnonzero(np.append(True, begins[1:] > ends[:-1]))
        last = np.append(first[1:], len(begins)) - 1
        return np.stack([begins[first], ends[last]], axis=1).ravel().tolist()


def matches(batches: Iterator[pa.RecordBatch], tests: TestSet, window: int) -> Iterator[pa.RecordBatch]:
    numbers = tests.numbers
    parts: list[np.ndarray] = []  # the shard being filled: words, with NO_WORD between texts
    owners: list[tuple[int, Document, int]] = []  # where in the shard a piece begins, whose it is, where it stands there
    filled = 0
    done: list[Document] = []

    def search() -> None:
        nonlocal filled
        if parts:
            at, windows = shard_hits(np.concatenate(parts), tests)
            begins = np.array([o[0] for o in owners], np.int64)
            piece = np.searchsorted(begins, at, side="right") - 1
            for k in np.unique(piece):
                begin, doc, offset = owners[k]
                mine = piece == k
                doc.add(at[mine] - begin + offset, windows[mine], tests)
        parts.clear()
        owners.clear()
        filled = 0

    def flush() -> pa.RecordBatch:
        found = [[(tests.names[i]) for i in sorted(d.items)] for d in done]
        spans = [d.spans() for d in done]
        longest = [max((e - b for b, e in zip(s[::2], s[1::2], strict=True)), default=0) for s in spans]
        out = batch(MATCHES, [[d.row for d in done], [d.name for d in done], [d.n_words for d in done], spans,
                              [[x for x in f if x is not None] for f in found], longest])
        done.clear()
        return out

    for rows in batches:
        for row, name, text in zip(*(rows.column(i) for i in range(3)), strict=True):
            doc = Document(row.as_py(), name.as_py())
            rest = np.empty(0, np.int32)  # the last words again: a window may stand across two pieces
            for words in split_words(text.as_py(), TERM_BYTES):
                own = np.fromiter((numbers.get(w, NO_WORD) for w in words), np.int32, len(words))
                piece = np.concatenate([rest, own])
                owners.append((filled, doc, doc.n_words - len(rest)))
                parts += [piece, np.zeros(1, np.int32)]
                filled += len(piece) + 1
                doc.n_words += len(own)
                rest = piece[-(window - 1):] if window > 1 else rest
                if filled >= SHARD_WORDS:
                    search()
            done.append(doc)
        search()
        yield flush()


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list]:
    """The distinct items, in lists whose texts have a bounded size in all. One text may be longer than a block."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), utf8(text).alias("text")).distinct()
    block, size = [], 0
    for row in items.orderBy("item", "text").toLocalIterator():
        n = len(row.text or b"")
        if block and size + n > 6 * block_words:
            yield block
            block, size = [], 0
        block.append((row.item, bytes(row.text) if row.text is not None else None))
        size += n
    yield block


def find_matches(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Every verbatim occurrence of a window of the benchmark items in the documents.

    A window is `window` consecutive words of an item, or the whole of a shorter
    item. Words are folded as contracts say: A-Z lower-cased, runs of 0-9, a-z and
    non-ASCII characters.

    Returns one row per row of docs: row (its number, unique), id (doc_id as long),
    n_words, hits (array: begin and end, exclusive, of every stretch of hit words,
    counted from 0), items (sorted ids, as strings, of items with an occurring
    window), longest (words in the longest stretch).

    Null or empty texts and texts without words have no words and no hits. Null item
    texts have no window; the windows of items with a null id hit words but are in no
    item list. Repeated items count once, repeated documents each for itself. Empty
    tables give no rows or no hits. Other columns are not looked at.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("bigint").alias("id"), utf8(text).alias("text")
    )
    schema = "row bigint, id bigint, n_words bigint, hits array<bigint>, items array<string>, longest bigint"
    found, blocks = None, 0
    for block in benchmark_blocks(benchmark, item_id, item_text, block_words):
        tests = docs.sparkSession.sparkContext.broadcast(TestSet.of(block, window))

        def run(batches, tests=tests):
            return matches(batches, tests.value, window)

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
        blocks += 1
    if blocks == 1:
        return found
    # Several blocks: what each found in a text, put together. Texts do not move.
    found = stored(found, "benchmark-matches")
    return found.groupBy("row", "id", "n_words").agg(
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ).withColumn("hits", _merged(F.col("hits"))).withColumn("longest", _longest(F.col("hits")))


def _merged(hits):
    """Stretches of several blocks as one list of stretches that do not touch."""
    begins = F.filter(F.transform(hits, lambda x, i: F.when(i % 2 == 0, F.struct(x.alias("b"), F.get(hits, i + 1).alias("e")))), lambda p: p.isNotNull())
    empty = F.array().cast("array<bigint>")

    def join(out, p):
        last = F.element_at(out, -1)
        longer = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.greatest(last, p["e"])))
        return F.when((F.size(out) > 0) & (F.try_element_at(out, F.lit(-1)) >= p["b"]), longer).otherwise(F.concat(out, F.array(p["b"], p["e"])))

    return F.aggregate(F.array_sort(begins), empty, join)


def _longest(hits):
    sizes = F.transform(hits, lambda x, i: F.when(i % 2 == 0, F.get(hits, i + 1) - x))
    return F.coalesce(F.array_max(sizes), F.lit(0).cast("bigint"))


def n_hit(hits: str = "hits"):
    """Hit words, from begin, end, begin, end, ..."""
    return F.aggregate(
        F.transform(F.col(hits), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )


def judged(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: hits in at least a twentieth of the words."""
    hit = found.withColumn("n_hit", n_hit())
    items = F.array_sort(F.array_distinct("items"))
    return hit.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        F.col("longest").alias("longest_match"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs without the contaminated rows. Rows that share a doc_id, or have none, are judged each for itself.

    Rows are told apart by 64 bits of a hash of id and text. Options as for find_matches().
    """
    key = F.xxhash64(F.col(doc_id), F.col(text))
    rows = docs.select(key.alias("key"), F.col(text).alias("text"))
    bad = judged(find_matches(rows, benchmark, doc_id="key", text="text", **options)).where("contaminated")
    return without_rows(docs, bad.select("doc_id"), key)


def oracle_sql(docs: str = "documents", benchmark: str = "benchmark", window: int = WINDOW) -> str:
    """DuckDB SQL for judged(find_matches(...)): every window of every document against every window of every item."""
    words = (
        "regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    return f"""
        WITH d AS (SELECT doc_id, {words} AS w FROM {docs}),
        i AS (SELECT item_id::VARCHAR AS item, {words} AS w FROM {benchmark}),
        sized AS (SELECT item, w, least(len(w), {window}) AS k FROM i WHERE len(w) > 0),
        windows AS (SELECT DISTINCT item, k, array_to_string(w[p : p + k - 1], ' ') AS gram
            FROM (SELECT item, w, k, unnest(range(1, (len(w) - k + 2)::BIGINT)) AS p FROM sized)),
        grams AS (SELECT doc_id, p, k, array_to_string(w[p : p + k - 1], ' ') AS gram FROM (
            SELECT doc_id, w, k, unnest(range(1, (len(w) - k + 2)::BIGINT)) AS p
            FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
        found AS (SELECT doc_id, p, k, item FROM grams JOIN windows USING (k, gram)),
        hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (
            SELECT doc_id, unnest(range(p, p + k)) AS x FROM found) GROUP BY doc_id),
        stretch AS (SELECT doc_id, max(n) AS longest FROM (
            SELECT doc_id, x - r AS g, count(*) AS n FROM (
                SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY x) AS r
                FROM (SELECT DISTINCT doc_id, unnest(range(p, p + k)) AS x FROM found)) GROUP BY ALL) GROUP BY doc_id),
        items AS (SELECT doc_id, count(DISTINCT item) AS n_items,
            array_to_string(list_sort(list_distinct(list(item))), ',') AS listed FROM found GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, COALESCE(n_hit, 0)::BIGINT AS n_hit,
            COALESCE(n_items, 0)::BIGINT AS n_items, sha256(COALESCE(listed, '')) AS items_sha256,
            COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated,
            COALESCE(longest, 0)::BIGINT AS longest_match
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN stretch USING (doc_id)"""
