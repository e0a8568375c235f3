"""What each filter of a chain removes, in every order of the filters.

Every filter has a table of the ids that fail it. The rows that survive a set of filters
are those of the set without its last one, left-anti joined with that filter's table;
what the next filter removes of them is their left-semi join with its table. An order
of filters only walks through these sets: 2^n of them serve all n! orders.

All tables lie in the same buckets of the row number, so no join moves a row.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramledger.llm.text import UPPER, batch, split_words, stored, utf8
from gramledger.session import new_folder, tune

# The six ASCII white-space bytes made a space, all others left alone.
PLAIN_BYTES = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
CONTINUATION = bytes(range(0x80, 0xC0))
FILTERS = "ABCDE"
BUCKET_ROWS = 1 << 14
MOST_BUCKETS = 1 << 14
SALTS = 32


@dataclass(frozen=True)
class Rules:
    """Below least_words words; below distinct % different words; over capitals % of A-Z; any of symbols."""

    least_words: int = 100
    distinct: int = 80
    capitals: int = 10
    symbols: bytes = b"#$%&*|"

    def failed(self, data: bytes) -> tuple[bool, bool, bool, bool]:
        n, kinds = 0, set()
        for words in split_words(data, PLAIN_BYTES):
            n += len(words)
            kinds.update(words)
        upper = len(data) - len(data.translate(None, UPPER))
        points = len(data.translate(None, CONTINUATION))
        symbols = len(data.translate(None, self.symbols)) < len(data)
        return n < self.least_words, 100 * len(kinds) < self.distinct * n, 100 * upper > self.capitals * points, symbols


MEASURED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("part", pa.string()), *((c, pa.bool_()) for c in "ABCD"), ("digest", pa.binary())])


@dataclass(frozen=True)
class Relations:
    """rows: row, part, good, toxic of every document. failing: one table of row per filter, in the order of their names."""

    rows: DataFrame
    failing: dict[str, DataFrame]
    buckets: int


def in_buckets(rows: DataFrame, purpose: str, buckets: int, dealt: bool = False) -> DataFrame:
    """rows stored in buckets by row. dealt: they lie by row already, so that no task has more than a few buckets."""
    name = f"{purpose.replace('-', '_')}_{uuid.uuid4().hex}"
    rows = rows if dealt else rows.repartition(buckets, "row")
    rows.write.bucketBy(buckets, "row").sortBy("row").option("path", new_folder(rows.sparkSession, purpose)).saveAsTable(name)
    return rows.sparkSession.table(name)


def relations(docs: DataFrame, labels: DataFrame, rules: Rules = Rules(), *, doc_id: str = "doc_id", text: str = "text",
              part: str = "lang") -> Relations:
    """The failing ids of the four rules A to D, and of E: the text is that of a smaller doc_id.

    One pass over the texts; later joins have row numbers, labels and digests only.
    """
    tune(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = [x.as_py() or b"" for x in rows.column(3)]
            failed = list(zip(*map(rules.failed, texts), strict=True)) or [[]] * 4
            digests = [hashlib.blake2b(t, digest_size=16).digest() for t in texts]
            yield batch(MEASURED, [rows.column(0), rows.column(1), rows.column(2), *map(list, failed), digests])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), utf8(text).alias("text"))
    schema = "row bigint, doc_id bigint, part string, A boolean, B boolean, C boolean, D boolean, digest binary"
    found = stored(rows.mapInArrow(measure, schema), "audit-measured")
    buckets = max(1, min(MOST_BUCKETS, found.count() // BUCKET_ROWS))

    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    no = F.lit(False)
    known = found.select("row", "doc_id", "part").join(marks, "doc_id", "left")
    known = known.select("row", "part", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    failing = {c: in_buckets(found.where(c).select("row"), f"audit-fails-{c}", buckets) for c in "ABCD"}
    failing["E"] = in_buckets(later_copies(found), "audit-fails-E", buckets)
    return Relations(in_buckets(known, "audit-rows", buckets), failing, buckets)


def later_copies(found: DataFrame) -> DataFrame:
    """row of every document whose digest a smaller doc_id has. The rows of one text are dealt out over SALTS partitions."""
    ids = found.where("doc_id IS NOT NULL")
    least = ids.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    least = least.select("digest", "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = ids.select("row", "doc_id", "digest", F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"))
    return salted.join(least, ["digest", "salt"]).where("doc_id > least").select("row")


def removals(tables: Relations) -> tuple[DataFrame, DataFrame]:
    """(part, before, filter, removed, good, toxic) and (part, before, kept), for every set of filters `before`.

    before has bit k for the k-th filter; filter is a bit too. Sets no row is left in have no rows.
    """
    # Joined where they lie: a broadcast of each table for each set would go through the driver.
    failing = {1 << k: t.hint("merge") for k, t in enumerate(tables.failing.values())}
    level = tables.rows.withColumn("before", F.lit(0))
    kept, removed = [], []
    for size in range(len(failing) + 1):
        kept.append(stored(survivors(level), f"audit-kept-{size}"))
        if size == len(failing):
            break
        gone, left = [], []
        for bit, ids in failing.items():
            here = level.where(F.col("before").bitwiseAND(F.lit(bit)) == 0).join(ids, "row", "left_semi")
            gone.append(here.withColumn("filter", F.lit(bit)))
            # Each set is made once: from itself without its last filter.
            rest = level.where(F.col("before") < bit).join(ids, "row", "left_anti")
            left.append(rest.withColumn("before", F.col("before") + bit))
        counts = reduce(DataFrame.unionByName, gone).groupBy("part", "before", "filter").agg(
            F.count("*").alias("removed"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
        removed.append(stored(counts, f"audit-removed-{size}"))
        level = in_buckets(reduce(DataFrame.unionByName, left), f"audit-survivors-{size + 1}", tables.buckets, dealt=True)
    return reduce(DataFrame.unionByName, removed), reduce(DataFrame.unionByName, kept)


def survivors(level: DataFrame) -> DataFrame:
    return level.groupBy("part", "before").agg(F.count("*").alias("kept"))


def steps_of(names: str) -> list[dict]:
    """All steps of all orders of the filters; sets and filters as bits."""
    out = []
    for order in permutations(range(len(names))):
        before = 0
        for step, k in enumerate(order, 1):
            out.append({"filter_order": "".join(names[j] for j in order), "step": step, "before": before, "filter": 1 << k})
            before |= 1 << k
    return out


def audit(tables: Relations) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    One row per part, order and step, zeros included. redundant: rows that fail the step's
    filter and had been removed, that is all that fail it but those it removes. unique_fails:
    what the filter removes as the last one. shapley: what it removes, summed over all orders.
    """
    names = "".join(tables.failing)
    n, whole = len(names), (1 << len(names)) - 1
    removed, kept = removals(tables)
    size = F.bit_count("before")
    # A filter comes right after the set `before` in |before|! (n - 1 - |before|)! orders.
    weight = F.element_at(F.array(*(F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n))), size + 1)
    whole_filter = removed.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("failing"),
        F.sum(F.when(F.col("before") + F.col("filter") == whole, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * weight).alias("shapley"),
    )
    # The orders are a stated list of n! n steps, written out for each part.
    steps = F.from_json(F.lit(json.dumps(steps_of(names))), "array<struct<filter_order: string, step: int, before: int, filter: int>>")
    rows = kept.where("before = 0").select("part", F.explode(steps).alias("s")).select("part", "s.*")
    rows = rows.withColumn("after", F.col("before") + F.col("filter"))
    rows = rows.join(removed, ["part", "before", "filter"], "left").join(whole_filter, ["part", "filter"], "left")
    rows = rows.join(kept.select("part", F.col("before").alias("after"), "kept"), ["part", "after"], "left")

    def count(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("bigint")

    return rows.select(
        "part", "filter_order", "step", count("kept").alias("kept"), count("removed").alias("removed"),
        (count("failing") - count("removed")).alias("redundant"), count("unique_fails").alias("unique_fails"),
        count("good").alias("good_lost"), count("toxic").alias("toxic_lost"), count("shapley").alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame, rules: Rules = Rules(), **columns: str) -> DataFrame:
    """audit() of relations(): see there.

    Null texts are empty, a null part is the empty one. Rows that share a doc_id are rows of
    their own with the labels of that id, and none is a copy of the other; a null doc_id has
    no labels, is no copy and has none. Of several labels of an id, one that says 1 is enough.
    An empty table has no parts and gives no rows. Other columns are not read.
    """
    return audit(relations(docs, labels, rules, **columns))


def oracle_sql(docs: str = "documents", labels: str = "labels") -> str:
    """DuckDB SQL for audit_documents(): the failed filters of each row as bits, counted for every order and step."""
    bits = {c: 1 << k for k, c in enumerate(FILTERS)}
    letters = ", ".join(f"('{c}', {b})" for c, b in bits.items())
    different = " AND ".join(f"{x}.c <> {y}.c" for i, x in enumerate(FILTERS) for y in FILTERS[:i])
    order = " || ".join(f"{x}.c" for x in FILTERS)
    before = " UNION ALL ".join(
        f"SELECT {order} AS filter_order, {k + 1} AS step, {' + '.join(['0', *(f'{x}.b' for x in FILTERS[:k])])} AS before, {FILTERS[k]}.b AS bit FROM orders"
        for k in range(len(FILTERS)))
    tables = ", ".join(f"f AS {x}" for x in FILTERS)
    before = before.replace(" FROM orders", f" FROM {tables} WHERE {different}")
    return f"""
        WITH d AS (SELECT doc_id, COALESCE(lang, '') AS part, COALESCE(text, '') AS text,
                regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {docs}),
        l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM {labels} GROUP BY doc_id),
        m AS (SELECT part, COALESCE(good, false) AS good, COALESCE(toxic, false) AS toxic,
                CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
                + CASE WHEN 100 * list_unique(w) < 80 * len(w) THEN 2 ELSE 0 END
                + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
                + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
                + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
            FROM d LEFT JOIN l USING (doc_id)),
        n AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL),
        f(c, b) AS (VALUES {letters}),
        s AS ({before}),
        x AS (SELECT part, filter_order, step, bit, sum(n) FILTER (mask & (before | bit) = 0) AS kept,
                sum(n) FILTER (mask & before = 0 AND mask & bit > 0) AS removed,
                sum(n) FILTER (mask & before > 0 AND mask & bit > 0) AS redundant,
                sum(n) FILTER (mask = bit) AS unique_fails,
                sum(good) FILTER (mask & before = 0 AND mask & bit > 0) AS good_lost,
                sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0) AS toxic_lost
            FROM s, n GROUP BY ALL)
        SELECT part, filter_order, step::INTEGER AS step, {", ".join(f"COALESCE({c}, 0)::BIGINT AS {c}" for c in "kept removed redundant unique_fails good_lost toxic_lost".split())},
            COALESCE(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley FROM x"""
