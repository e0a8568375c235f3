"""Mixing sources to target weights by nested thresholds on a hash.

Every document has a place: 60 bits of a hash of its id and text. A source whose target
is 2.4 times its size is taken twice as a whole, and the documents with the lowest places
a third time, up to 0.4 of its size. For that its tokens are summed by the first 12 bits
of the place; the budget ends within one of these buckets, and only that bucket is
summed by the next 12 bits, and so on to the last. A document is in if its place is
below the threshold of its source: no rows are sorted, and a larger budget keeps what a
smaller one has.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gramledger.llm.order import numbered
from gramledger.llm.text import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
REPEATS = 3  # a source is taken so many times at most
PLACE_BITS, STEP_BITS = 60, 12
SALTS = 32
SEED = "mix"


@dataclass(frozen=True)
class Mix:
    """sources: source, source_size, target, copies, threshold. measured: doc_id, source, size, place of each document."""

    sources: DataFrame
    measured: DataFrame


def measured(doc_id: Column, text: Column, seed: str) -> tuple[Column, Column]:
    """The size of a document in words, and its place."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text)
    place = F.conv(F.substring(F.md5(name), 1, PLACE_BITS // 4), 16, 10)
    return F.regexp_count(text, F.lit(WORD)).cast("bigint"), place.cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """source, source_size, target of (source, source_size).

    Sources by code point, null last, weigh weights[0], weights[1], ... and again from the
    start. They share the sum of all sizes by weight; none gets more than repeats times its
    size, and the others share what that leaves, until none is above. The driver gets two
    sums a round; a round caps one source at least, or is the last.
    """
    rows = numbered(sizes.select("source", "source_size"), F.col("source").asc_nulls_last(), name="number")
    cycle = F.array(*(F.lit(int(w)).cast("bigint") for w in weights))
    rows = rows.withColumn("weight", F.element_at(cycle, (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int")))
    rows = stored(rows.select("source", "source_size", "weight"), "mix-weights")
    most = F.col("source_size") * repeats

    def above(rest: int, weight: int) -> Column:
        """Whether a source's share of rest is more than it may get, in whole numbers."""
        return most.cast("decimal(19,0)") * F.lit(weight).cast("decimal(19,0)") < F.lit(rest).cast("decimal(19,0)") * F.col("weight").cast("decimal(19,0)")

    first = rows.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    total, rest, weight = first.n or 0, first.n or 0, first.w or 1
    while True:
        capped = above(rest, weight)
        left = rows.agg(F.sum(F.when(capped, most)).alias("capped"), F.sum(F.when(~capped, F.col("weight"))).alias("w")).first()
        now = total - (left.capped or 0), left.w
        if not left.w or now == (rest, weight):
            break
        rest, weight = now
    share = (F.col("weight") * rest).cast("double") / F.lit(weight).cast("double")
    return rows.select("source", "source_size", F.when(above(rest, weight), most.cast("double")).otherwise(share).alias("target"))


def with_thresholds(documents: DataFrame, sources: DataFrame, repeats: int) -> DataFrame:
    """Adds copies and threshold to (source, source_size, target).

    The words of the documents below the threshold come as near to what copies leave of the
    target as whole documents do; of two that are as near, the lower one is taken.
    """
    size = F.col("source_size")
    copies = F.when(size > 0, F.least(F.floor(F.col("target") / size), F.lit(repeats))).otherwise(0).cast("bigint")
    sources = sources.withColumn("copies", copies)
    rest = F.when(F.col("copies") < repeats, F.greatest(F.col("target") - F.col("copies") * size, F.lit(0.0))).otherwise(0.0)
    sources = stored(sources.withColumn("rest", rest), "mix-targets")
    # (source, bucket, rest, before): where the budget ends; before: the words of all lower buckets.
    edge = sources.select("source", "rest", F.lit(0).cast("bigint").alias("bucket"), F.lit(0).cast("bigint").alias("before"))
    inside = documents.select("source", "size", "place").where("size > 0")
    for shift in range(PLACE_BITS - STEP_BITS, -1, -STEP_BITS):
        sums = inside.groupBy("source", F.shiftright("place", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        e = edge.toDF("s", "rest", "upper", "before")
        sums = sums.join(e, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("bucket", STEP_BITS) == F.col("upper")))
        # At most 2^12 buckets of a source are left.
        up_to = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        sums = sums.withColumn("after", F.col("before") + up_to).withColumn("before", F.col("after") - F.col("words"))
        edge = stored(sums.where("before <= rest AND rest < after").select("source", "rest", "bucket", "before", "after"), "mix-edge")
        if shift:
            # Only what lies in the bucket goes on. One bucket of one source is a key of its own: no hot one.
            e = edge.select(F.col("source").alias("s"), F.col("bucket").alias("b"))
            here = F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("place", shift) == F.col("b"))
            inside = stored(inside.join(e, here).select("source", "size", "place"), "mix-inside")
            edge = edge.select("source", "rest", "bucket", "before")
    nearer = (F.col("after") - F.col("rest") < F.col("rest") - F.col("before")).cast("bigint")
    ends = edge.select(F.col("source").alias("s"), (F.col("bucket") + nearer).alias("threshold"))
    found = sources.join(ends, F.col("source").eqNullSafe(F.col("s")), "left")
    return found.select("source", "source_size", "target", "copies", F.coalesce("threshold", F.lit(0)).alias("threshold"))


def plan(docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS, seed: str = SEED,
         doc_id: str = "doc_id", text: str = "text", source: str = "source") -> Mix:
    """Sizes and places of all documents in one pass over the texts, then targets and thresholds of the sources."""
    if repeats < 1 or not weights or min(weights) < 1:
        raise ValueError("weights and repeats must be positive")
    size, place = measured(F.col(doc_id), F.col(text), seed)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size"), place.alias("place"))
    rows = stored(rows, "mix-sizes")
    sizes = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    sources = with_thresholds(rows, targets(sizes, weights, repeats), repeats)
    return Mix(stored(sources, "mix-plan"), rows)


def _by_source(rows: DataFrame, key: str, salt: Column, sources: DataFrame) -> DataFrame:
    """rows joined with their sources. A source with a third of all rows is dealt out over SALTS partitions."""
    salted = sources.withColumnRenamed("source", "__of").withColumn("__grain", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("__salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
    return rows.join(salted, F.col(key).eqNullSafe(F.col("__of")) & (F.col("__salt") == F.col("__grain")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row per row of docs. Options as for plan().

    size is the number of words, 0 for null and empty texts. copies says how often the
    document is in the mix, taken is that times its size. Null is a source of its own, the
    last. Rows of the same id and text share a place: all of them are below a threshold or
    none. A source without words has the target 0, and its documents are there once or not
    at all. Repeated rows give repeated results, a null doc_id stays null, an empty table
    gives no rows. Other columns are not read. The same rows give the same mix.
    """
    made = plan(docs, **options)
    found = _by_source(made.measured, "source", F.col("place"), made.sources)
    copies = F.col("copies") + (F.col("place") < F.col("threshold")).cast("bigint")
    return found.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs as often as the mix has them, with all their columns. Options as for plan().

    The documents are filtered by the threshold of their source, where they are read.
    """
    made = plan(docs, **options)
    names = {k: options.get(k, k) for k in ("doc_id", "text", "source")}
    _, place = measured(F.col(names["doc_id"]), F.col(names["text"]), options.get("seed", SEED))
    # All columns of docs lie in one, so that none clashes with those added here.
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(names["source"]).cast("string").alias("source"), place.alias("place"))
    found = _by_source(rows, "source", F.col("place"), made.sources)
    copies = (F.col("copies") + (F.col("place") < F.col("threshold")).cast("bigint")).cast("int")
    return found.select("doc", F.explode(F.array_repeat(F.lit(True), copies))).select("doc.*")


def oracle_sql(table: str = "documents", weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS, seed: str = SEED) -> str:
    """DuckDB SQL for the query of mix(): sources capped in the order of size by weight, documents sorted by place."""
    return f"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(COALESCE(text, ''), '{WORD}'))::BIGINT AS size,
                ('0x' || substr(md5(concat('{seed}:', COALESCE(doc_id::VARCHAR, ''), ':', COALESCE(text, ''))), 1, {PLACE_BITS // 4}))::BIGINT AS place
            FROM {table}),
        s AS (SELECT source, sum(size)::BIGINT AS n,
                {list(weights)}[1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1)::BIGINT % {len(weights)}]::BIGINT AS w
            FROM d GROUP BY source),
        -- rest and weight that are left for a source and all behind it, if those before it are capped
        o AS (SELECT *, row_number() OVER by_ratio AS k,
                (sum(n) OVER () - {repeats} * COALESCE(sum(n) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS r,
                (sum(w) OVER (by_ratio ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS v
            FROM s WINDOW by_ratio AS (ORDER BY n * {math.lcm(*weights)} // w, source ASC NULLS LAST)),
        first AS (SELECT min(k) AS k FROM o WHERE {repeats}::HUGEINT * n * v >= r::HUGEINT * w),
        free AS (SELECT r, v FROM o JOIN first USING (k)),
        t AS (SELECT source, n, CASE WHEN EXISTS (FROM first WHERE o.k >= first.k)
                THEN (w * (SELECT r FROM free))::DOUBLE / (SELECT v FROM free)::DOUBLE ELSE ({repeats} * n)::DOUBLE END AS target FROM o),
        c AS (SELECT *, CASE WHEN n > 0 THEN least(floor(target / n), {repeats})::BIGINT ELSE 0 END AS copies FROM t),
        b AS (SELECT *, CASE WHEN copies < {repeats} THEN greatest(target - copies * n, 0) ELSE 0 END AS rest FROM c),
        p AS (SELECT source, place, sum(size) AS words FROM d WHERE size > 0 GROUP BY ALL),
        q AS (SELECT source, place, sum(words) OVER (PARTITION BY source ORDER BY place) AS up_to, words FROM p),
        e AS (SELECT b.source, place + CASE WHEN up_to - rest < rest - (up_to - words) THEN 1 ELSE 0 END AS threshold
            FROM q JOIN b ON q.source IS NOT DISTINCT FROM b.source WHERE up_to - words <= rest AND rest < up_to)
        SELECT doc_id, size, n AS source_size, target,
            (size * (copies + CASE WHEN place < COALESCE(threshold, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source"""
