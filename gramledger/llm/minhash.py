"""Near-duplicate groups by b-bit MinHash.

1. Every text is sketched: minima of HASHES hash functions over its set of word
   shingles; bands of whole minima make bucket keys, the low BITS of each minimum
   are packed into a signature.
2. Equal texts become one class, before anything else is shuffled.
3. Classes that share a bucket are candidates. First each one is paired with the
   smallest of its bucket, so that a bucket of m members gives m - 1 pairs.
4. A pair must reach FLOOR by its signature (share of equal low bits, corrected for
   chance) and is then confirmed on the full sets. Confirmed links make components,
   by alternating stars.
5. What is still in different components of a bucket is compared on signatures, block
   by block: the members outside the bucket's largest component against all. Those
   that reach FLOOR make clusters, and within a cluster the same is done once more on
   the full sets. Tasks hand on links and clusters, never the pairs they looked at.

At a similarity of exactly 0.75 a pair shares no band with a probability of
(1 - 0.75^4)^32 = 5e-6, and its signature falls below FLOOR with one of 4e-6; both
are smaller for more similar pairs. Links are never taken on estimates alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramledger.llm.text import WORD_BYTES, WordHashes, batch, forget, hashes_of, mixed, stored, utf8

SHINGLE = 5
SIMILARITY = 75  # per cent
HASHES, ROWS, BITS = 128, 4, 4
BANDS = HASHES // ROWS
LONGS = HASHES * BITS // 64
FLOOR = 0.57  # four and a half standard deviations below 0.75
LOWEST = sum(1 << k for k in range(0, 64, BITS))  # the lowest bit of each minimum in a long
SMALL_PART = 100_000  # rows of a few numbers that one task writes
BLOCK = 2048  # members of a group compared at a time with as many
BLOCK_SHINGLES = 1 << 20  # and shingles, about, where full sets are compared
SENT_IDS = 1 << 22  # ids that are sent to all tasks at most: some 100 MB

_random = np.random.default_rng(20240229)
FACTORS = _random.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2)
PLACES = _random.integers(1, 1 << 63, SHINGLE + ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """The distinct shingles of a text, as sorted 64-bit hashes, from the hashes of its words."""
    if not len(words):
        return words
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += words[k : k + n] * PLACES[k]
    return np.unique(mixed(total))


def minima(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 512):
        part = shingles[start : start + 512, None] * FACTORS + ADDENDS
        np.minimum(least, part.min(axis=0), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """The low BITS of each minimum, 64 bits to a long; rows of minima to rows of longs."""
    each = 64 // BITS
    low = (least & np.uint64((1 << BITS) - 1)).reshape(len(least), LONGS, each)
    return (low << (np.arange(each, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64).view(np.int64)


def band_keys(least: np.ndarray) -> np.ndarray:
    bands = (least.reshape(len(least), BANDS, ROWS) * PLACES[SHINGLE:]).sum(axis=2, dtype=np.uint64)
    return mixed(bands + np.arange(BANDS, dtype=np.uint64) * PLACES[0]).view(np.int64)


def digest_of(words: np.ndarray) -> bytes:
    """Equal for texts of the same words."""
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


SKETCH = pa.schema(
    [("doc_id", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()), ("signature", pa.list_(pa.int64())),
     ("bands", pa.list_(pa.int64()))]
)
SETS = pa.schema([("id", pa.int64()), ("digest", pa.binary()), ("shingles", pa.list_(pa.int64()))])
SLICE = 512


def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE):
            rows = whole.slice(start, SLICE)
            words = [hashes_of(x.as_py(), WORD_BYTES, known) for x in rows.column(1)]
            sets = [shingle_set(w) for w in words]
            least = np.stack([minima(s) for s in sets])
            yield batch(SKETCH, [rows.column(0), [digest_of(w) for w in words], [len(s) for s in sets],
                                 packed(least).tolist(), band_keys(least).tolist()])


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE):
            rows = whole.slice(start, SLICE)
            words = [hashes_of(x.as_py(), WORD_BYTES, known) for x in rows.column(1)]
            sets = [shingle_set(w) for w in words]
            ends = np.cumsum([0, *map(len, sets)])
            values = pa.array(np.concatenate(sets).view(np.int64))
            yield batch(SETS, [rows.column(0), [digest_of(w) for w in words], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)])


# -- similarity -----------------------------------------------------------------


def estimate(a: Column, b: Column) -> Column:
    """Similarity by two signatures: the share of equal low bits, less what chance gives."""
    equal = F.lit(HASHES)
    for k in range(LONGS):
        x = a[k].bitwiseXOR(b[k])
        for shift in range(1, BITS):
            x = x.bitwiseOR(F.shiftrightunsigned(a[k].bitwiseXOR(b[k]), shift))
        equal = equal - F.bit_count(x.bitwiseAND(F.lit(LOWEST)))
    chance = 2.0**-BITS
    return (equal / HASHES - chance) / (1 - chance)


def alike_sizes(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def sets_of(docs: DataFrame, ids: DataFrame, repeated: bool) -> DataFrame:
    """(id, digest, shingles) of the texts of the ids (rep). repeated: whether an id has several rows; then each text once."""
    sets = docs.join(ids, docs.id == ids.rep, "left_semi").mapInArrow(full_sets, "id bigint, digest binary, shingles array<bigint>")
    return sets.groupBy("id", "digest").agg(F.first("shingles").alias("shingles")) if repeated else sets


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, repeated: bool, parts: int) -> DataFrame:
    """The pairs (a, b) whose signatures allow a link, with linked: whether their full sets make one."""
    side = classes.select("rep", "digest", "n_shingles", "signature")
    likely = (
        pairs.join(side.toDF("a", "da", "na", "sa"), "a")
        .join(side.toDF("b", "db", "nb", "sb"), "b")
        .where(alike_sizes(F.col("na"), F.col("nb")) & (estimate(F.col("sa"), F.col("sb")) >= FLOOR))
        .select("a", "b", "da", "db", "na", "nb")
    )
    likely = stored(likely, "likely", parts)
    sets = stored(sets_of(docs, likely.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), repeated), "shingle-sets")
    common = F.size(F.array_intersect("xa", "xb"))
    both = likely.join(sets.toDF("a", "da", "xa"), ["a", "da"]).join(sets.toDF("b", "db", "xb"), ["b", "db"])
    linked = 100 * common >= SIMILARITY * (F.col("na") + F.col("nb") - common)
    out = stored(both.groupBy("a", "b").agg(F.max(linked).alias("linked")), "confirmed", parts)
    forget(likely, sets)
    return out


# -- components -----------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of edges (a, b), stored; a component is known by its smallest node."""
    edges = stored(_falling(edges.select("a", "b")), "edges")
    # Stars never have more edges than there were: their number says how many files they fill.
    parts = edges.count() // SMALL_PART + 1
    while True:
        # Nodes above a node are linked to the least of its neighbours, then those below it.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least", parts)
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(_falling(large), "large-star", parts)
        forget(edges, least)
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least", parts)
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        edges = stored(_falling(small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))), "edges", parts)
        forget(large, least)
        # Done when every edge leads from a node to a root: a node with one edge, to one that has none.
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out")).unionByName(
            edges.select(F.col("b").alias("node"), F.lit(0).alias("out")).distinct())
        if ends.groupBy("node").agg(F.count("*").alias("m")).where("m > 1").isEmpty():
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    out = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots), "components", parts)
    forget(edges)
    return out


def _falling(edges: DataFrame) -> DataFrame:
    """Each edge once, larger node first, loops dropped."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


# -- what one pairing with the smallest leaves open -------------------------------

PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def group_rows(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of rows sorted by the first `keys` columns, one after the other."""
    rest: list[pa.RecordBatch] = []
    last = None
    for rows in batches:
        if not rows.num_rows:
            continue
        columns = [rows.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(rows.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.append(np.flatnonzero(change), rows.num_rows)
        if rest and last != tuple(c[0] for c in columns):
            yield pa.Table.from_batches(rest)
            rest = []
        begin = 0
        for end in starts:
            rest.append(rows.slice(begin, end - begin))
            if end < rows.num_rows:
                yield pa.Table.from_batches(rest)
                rest = []
            begin = end
        last = tuple(c[-1] for c in columns)
    if rest:
        yield pa.Table.from_batches(rest)


def in_blocks(rows: DataFrame, key: str, block: int, block_shingles: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """Rows of groups with several components, dealt out so that any two that differ in it meet in one (key, low, high).

    Members of the group's largest component go to blocks of their own, which meet the
    blocks of the others but not each other: work grows with the others times all.
    part says which of the two blocks a row is in. The second table is what they are dealt by.
    """
    sizes = rows.groupBy(key, "component").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    largest = F.max(F.struct("m", "component", "w")).alias("top")

    def blocks(m, w):
        return F.greatest(F.ceil(m / block), F.ceil(w / block_shingles)).cast("int")

    groups = sizes.groupBy(key).agg(largest, F.sum("m").alias("m"), F.sum("w").alias("w"), F.count("*").alias("kinds")).where("kinds > 1")
    groups = stored(groups.select(
        key, F.col("top.component").alias("most"), blocks(F.col("top.m"), F.col("top.w")).alias("large"),
        blocks(F.col("m") - F.col("top.m"), F.col("w") - F.col("top.w")).alias("other")), "open-groups", parts)
    dealt = rows.join(groups, key)
    place = F.xxhash64(F.col("rep"), F.lit(7))
    in_most = F.col("component") == F.col("most")
    part = F.when(in_most, F.col("other") + F.pmod(place, F.col("large"))).otherwise(F.pmod(place, F.col("other"))).cast("int")
    last = F.when(in_most, F.col("other")).otherwise(F.col("other") + F.col("large")) - 1
    dealt = dealt.withColumn("part", part).withColumn("meets", F.explode(F.sequence(F.lit(0), last)))
    dealt = dealt.withColumn("low", F.least("part", "meets")).withColumn("high", F.greatest("part", "meets"))
    dealt = dealt.select(key, "low", "high", "part", *[c for c in rows.columns if c != key])
    return dealt.repartition(key, "low", "high").sortWithinPartitions(key, "low", "high"), groups


def sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    part, low, high = (group.column(k).to_numpy() for k in ("part", "low", "high"))
    return np.flatnonzero(part == low), np.flatnonzero(part == high)


def likely_pairs(group: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows of different components have signatures and sizes that allow a link, left by right."""
    component, size = (group.column(k).to_numpy() for k in ("component", "n"))
    signature = np.array(group.column("signature").to_pylist(), np.int64).view(np.uint64).reshape(len(size), LONGS)
    chance = 2.0**-BITS
    least_equal = int(np.ceil((FLOOR * (1 - chance) + chance) * HASHES))
    good = np.empty((len(left), len(right)), bool)
    for start in range(0, len(left), 256):
        rows = left[start : start + 256]
        unequal = np.zeros((len(rows), len(right)), np.uint8 if HASHES < 256 else np.int32)
        for k in range(LONGS):
            x = signature[rows, k][:, None] ^ signature[right, k][None, :]
            y = x
            for shift in range(1, BITS):
                y = y | (x >> np.uint64(shift))
            unequal += np.bitwise_count(y & np.uint64(LOWEST))
        a, b = size[rows][:, None], size[right][None, :]
        near = (unequal <= HASHES - least_equal) & (component[rows][:, None] != component[right][None, :])
        good[start : start + 256] = near & (100 * np.minimum(a, b) >= SIMILARITY * np.maximum(a, b))
    return good


def block_clusters(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows that likely pairs connect, each with the first one of its cluster."""
    left, right = sides(group)
    good = likely_pairs(group, left, right)
    rep = group.column("rep").to_numpy()
    roots, ends = [], []
    open_left, open_right = good.any(axis=1), np.ones(len(right), bool)
    while open_left.any():
        first = front = np.flatnonzero(open_left)[:1]
        open_left[front] = False
        while len(front):
            reached = np.flatnonzero(good[front].any(axis=0) & open_right)
            open_right[reached] = False
            front = np.flatnonzero(good[:, reached].any(axis=1) & open_left)
            open_left[front] = False
            for found in (rep[right[reached]], rep[left[front]]):
                roots.append(np.repeat(rep[left[first]], len(found)))
                ends.append(found)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *roots]), np.concatenate([none, *ends])


def block_links(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of different components by their full sets: for every row one to each component it is linked with."""
    left, right = sides(group)
    none = np.empty(0, np.int64)
    if not len(left) or not len(right):  # rows are dealt by hash: a block of few long sets may get none
        return none, none
    component, rep = group.column("component").to_numpy(), group.column("rep").to_numpy()
    sets = group.column("shingles").combine_chunks()
    ends = sets.offsets.to_numpy()
    _, codes = np.unique(sets.values.to_numpy(), return_inverse=True)
    size = np.diff(ends)
    inside = np.concatenate([np.arange(ends[r], ends[r + 1]) for r in right])
    others, starts = codes[inside], np.cumsum(size[right]) - size[right]
    mark = np.zeros(int(codes.max()) + 1, np.int32)
    from_, to = [], []
    for i in left:
        own = codes[ends[i] : ends[i + 1]]
        far = component[right] != component[i]
        if not far.any():
            continue
        mark[own] = 1
        common = np.add.reduceat(mark[others], starts)
        mark[own] = 0
        linked = np.flatnonzero(far & (100 * common >= SIMILARITY * (size[i] + size[right] - common)))
        if len(linked):
            _, one = np.unique(component[right[linked]], return_index=True)
            to.append(rep[right[linked[one]]])
            from_.append(np.repeat(rep[i], len(one)))
    return np.concatenate([none, *from_]), np.concatenate([none, *to])


def by_group(compare, dealt: DataFrame) -> DataFrame:
    """compare(rows of one (key, low, high)) for all of them: pairs (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in group_rows(batches, 3):
            yield batch(PAIRS, compare(group))

    return dealt.mapInArrow(run, "a bigint, b bigint")


def open_links(members: DataFrame, classes: DataFrame, labels: DataFrame, docs: DataFrame, repeated: bool, parts: int) -> DataFrame:
    """Links (a, b) between what is still in different components of a bucket."""
    now = members.join(labels, members.rep == labels.node, "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed_ = now.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c <> d").select("key")
    rows = now.join(mixed_, "key").join(classes.select("rep", F.col("n_shingles").alias("n"), "signature"), "rep")
    rows = stored(rows.select("key", "rep", "component", "n", "signature"), "open-members", parts)
    dealt, groups = in_blocks(rows, "key", BLOCK, 1 << 62, parts)
    pairs = stored(by_group(block_clusters, dealt), "open-pairs", parts)
    forget(rows, groups)
    clusters = components(pairs)
    inside = (
        clusters.toDF("node", "cluster").join(labels.toDF("node", "component"), "node", "left")
        .select("node", "cluster", F.coalesce("component", "node").alias("component"))
        .join(classes.select("rep", "digest"), F.col("node") == F.col("rep")).select("cluster", "rep", "digest", "component")
    )
    sets = sets_of(docs, inside.select("rep").distinct(), repeated)
    rows = inside.join(sets.toDF("rep", "digest", "shingles"), ["rep", "digest"])
    rows = stored(rows.select("cluster", "rep", "component", F.size("shingles").cast("bigint").alias("n"), "shingles"), "clustered")
    dealt, groups = in_blocks(rows, "cluster", BLOCK, BLOCK_SHINGLES, parts)
    out = stored(by_group(block_links, dealt), "open-links", parts)
    forget(pairs, clusters, rows, groups)
    return out


# -- all of it ------------------------------------------------------------------


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A document's
    set: its distinct five-word shingles, or all its words as one if it has fewer.
    Documents are linked if 100 * common >= 75 * united. component_id is the smallest
    doc_id that links lead to, kept whether it is the document's own.

    Null, empty and word-less texts have no shingles and are linked with nothing. Rows
    that share a doc_id are one document: what any of them is linked with, all are. A
    null doc_id is linked with nothing, its component_id is null, and it is kept. An
    empty table gives no rows. Other columns are not looked at.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), utf8(text).alias("text"))
    sketch = stored(
        docs.mapInArrow(sketches, "doc_id bigint, digest binary, n_shingles bigint, signature array<bigint>, bands array<bigint>"),
        "sketches",
    )
    rows = sketch.count()
    parts = rows * BANDS // (10 * SMALL_PART) + 1  # for what has a few numbers per bucket and document at most
    real = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    least = F.min(F.struct("doc_id", "n_shingles", "signature", "bands"))
    classes = stored(
        real.groupBy("digest").agg(least.alias("c")).select("digest", F.col("c.doc_id").alias("rep"), "c.n_shingles", "c.signature", "c.bands"),
        "classes",
    )
    each = classes.select("rep", F.explode("bands").alias("key"))
    hubs = stored(each.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("m")).where("m > 1"), "hubs", parts)
    members = stored(each.join(hubs, "key").select("key", "rep", "hub"), "members", parts)

    repeated = stored(
        real.groupBy("doc_id").agg(F.count("*").alias("m"), F.min("digest").alias("d"), F.max("digest").alias("e")).where("m > 1"),
        "repeated", parts,
    )
    again = not repeated.isEmpty()
    same = _same_document(repeated.where("d <> e"), real, classes)

    first = members.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    near = confirmed(first, classes, docs, again, parts)
    links = near.where("linked").select("a", "b").unionByName(same)
    early = components(links)
    late = open_links(members, classes, early, docs, again, parts)
    labels = components(links.unionByName(late))
    named = stored(
        classes.join(labels, classes.rep == labels.node, "left").select("digest", F.coalesce("component", "rep").alias("component")),
        "named", parts,
    )
    forget(classes, hubs, members, repeated, same, near, early, late, labels)
    whole = sketch.join(named, "digest", "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.col("component")).otherwise(F.col("doc_id"))
    return whole.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _same_document(ids: DataFrame, real: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of different texts that share a doc_id."""
    rows = real.select("doc_id", "digest").join(ids.select("doc_id"), "doc_id").join(classes.select("digest", "rep"), "digest")
    return stored(rows.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct(), "same-document", 1 + ids.count() // SMALL_PART)


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one document of each group left, the one with the smallest doc_id, and one row of each doc_id."""
    groups = stored(near_duplicates(docs, doc_id=doc_id, text=text), "near-duplicates")
    gone = stored(groups.where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct(), "dropped-ids")
    # The texts stay where they are while the ids are few enough, by count, for every task to have them.
    sent = F.broadcast(gone) if gone.count() <= SENT_IDS else gone
    left = docs.join(sent, docs[doc_id] == sent["__gone"], "left_anti")
    again = groups.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    again = stored(again.select(F.col("doc_id").alias("__again")), "repeated-ids")
    if again.isEmpty():
        return left
    once = left.join(again, left[doc_id] == again["__again"], "left_anti")
    return once.unionByName(left.join(again, left[doc_id] == again["__again"], "left_semi").dropDuplicates([doc_id]))


def oracle_sql(table: str = "documents") -> str:
    """DuckDB SQL for near_duplicates: full sets joined on shingles, then the closure of the links."""
    return f"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
            translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') AS w FROM {table}),
        s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[p : p + {SHINGLE - 1}], ' ') AS shingle
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1)::BIGINT + 1)) AS p FROM d WHERE len(w) > 0)),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        link AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
            JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
            GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= {SIMILARITY} * (nx.n + ny.n - count(*))),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
        SELECT d.doc_id, COALESCE(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
        FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)"""
