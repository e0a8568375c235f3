"""Near-duplicates against sets compared pair by pair."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from gramledger.llm import minhash
from gramledger.llm.text import WORD_BYTES, WordHashes, hashes_of

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(rows):
    """doc_id -> smallest doc_id reachable."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in sets}


def variants(seed, groups, size, length=60):
    draw = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{draw.randrange(500)}" for _ in range(length)]
        for _ in range(size):
            words = list(base)
            for _ in range(draw.randint(0, 4)):
                words[draw.randrange(length)] = f"v{draw.randrange(10_000)}"
            rows.append(" ".join(words))
    draw.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return minhash.near_duplicates(df).collect()


def test_groups_equal_brute_force(spark):
    rows = variants(1, 6, 12)
    rows += [(1000, rows[0][1].upper()), (1001, None), (1002, ""), (1003, "a b"), (1004, "A  b"), (1005, "a b c"), (1006, " \t ")]
    want = brute(rows)
    got = found(spark, rows)
    assert {r.doc_id: r.component_id for r in got} == want
    texts = dict(rows)
    assert all(r.n_shingles == len(shingles(texts[r.doc_id])) and r.kept == (r.doc_id == r.component_id) for r in got)


def test_chains_that_no_smallest_member_joins(spark, monkeypatch):
    """A chain of texts, each near the next alone: buckets are compared within, in blocks of two."""
    monkeypatch.setattr(minhash, "BLOCK", 2)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 70)
    words = [f"w{i}" for i in range(160)]
    rows = [(50 - k, " ".join(words[4 * k : 4 * k + 60])) for k in range(20)]
    assert {r.doc_id: r.component_id for r in found(spark, rows)} == brute(rows)


def test_few_long_texts_leave_blocks_empty(spark, monkeypatch):
    """Alike texts, not enough to be linked, each with more shingles than a block should have."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 50)
    words = [f"w{i}" for i in range(1200)]
    rows = [(1, " ".join(words[:1000])), (2, " ".join(words[160:1160])), (3, " ".join(words[:990]))]
    assert {r.doc_id: r.component_id for r in found(spark, rows)} == brute(rows) == {1: 1, 2: 2, 3: 1}
    assert {r.doc_id: r.component_id for r in found(spark, rows[:2])} == {1: 1, 2: 2}


def test_odd_rows(spark, messy, nothing):
    got = minhash.near_duplicates(messy).collect()
    assert len(got) == messy.count()
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    want = brute(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id]
    assert minhash.near_duplicates(nothing).collect() == []
    left = minhash.drop_near_duplicates(messy)
    assert left.columns == messy.columns
    ids = [r.doc_id for r in left.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted({want[i] for i in want})
    assert ids.count(None) == 2
    assert minhash.drop_near_duplicates(nothing).collect() == []


def test_estimate_is_close_and_the_same_in_both_forms(spark):
    known, draw = WordHashes(), random.Random(4)
    base = [f"w{i}" for i in range(400)]
    sets, signatures = [], []
    for _ in range(30):
        words = [w if draw.random() > 0.03 else f"x{draw.random()}" for w in base]
        s = minhash.shingle_set(hashes_of(" ".join(words).encode(), WORD_BYTES, known))
        sets.append(set(s.tolist()))
        signatures.append(minhash.packed(minhash.minima(s)[None, :])[0])
    a, b = signatures[:15], signatures[15:]
    df = spark.createDataFrame([(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)], "a array<bigint>, b array<bigint>")
    from pyspark.sql import functions as F

    by_sql = [r[0] for r in df.select(minhash.estimate(F.col("a"), F.col("b"))).collect()]
    true = [len(x & y) / len(x | y) for x, y in zip(sets[:15], sets[15:], strict=True)]
    assert np.abs(np.array(by_sql) - true).mean() < 0.06
    n = minhash.HASHES
    for x, y, e in zip(a, b, by_sql, strict=True):
        x, y = (sum(int(v) % (1 << 64) << (64 * k) for k, v in enumerate(z)) for z in (x, y))
        low = (1 << minhash.BITS) - 1
        equal = sum((x >> (minhash.BITS * k)) & low == (y >> (minhash.BITS * k)) & low for k in range(n))
        chance = 2.0**-minhash.BITS
        assert e == pytest.approx((equal / n - chance) / (1 - chance))


def table(**columns):
    return pa.table(columns | {"low": [0] * len(columns["rep"]), "high": [max(columns["part"])] * len(columns["rep"])})


def test_clusters_of_a_block():
    draw = np.random.default_rng(0)
    one, two = (draw.integers(0, 1 << 62, minhash.LONGS).tolist() for _ in range(2))
    rows = table(part=[0, 0, 0, 0, 1, 1, 1], rep=[1, 2, 3, 7, 4, 5, 6], component=[1, 1, 3, 7, 1, 5, 5], n=[100, 100, 10, 100, 100, 90, 80],
                 signature=[one, one, one, two, one, one, one])
    a, b = minhash.block_clusters(rows)
    assert a.tolist() == [1] * 3 and sorted(b.tolist()) == [2, 5, 6]  # 3 is too small, 4 is of the same component, 7 another text


def test_links_of_a_block():
    sets = [range(100), range(5, 100), range(30, 130), range(5, 105), range(60)]
    rows = table(part=[0, 0, 1, 1, 1], rep=[1, 2, 3, 4, 5], component=[1, 2, 3, 4, 5], n=[100, 95, 100, 100, 60],
                 shingles=pa.array([list(s) for s in sets], pa.list_(pa.int64())))
    a, b = minhash.block_links(rows)
    want = {(i + 1, j + 1) for i in (0, 1) for j in (2, 3, 4)
            if 100 * len(set(sets[i]) & set(sets[j])) >= 75 * len(set(sets[i]) | set(sets[j]))}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want and want


@pytest.mark.parametrize("part", [0, 1])
def test_links_of_a_block_without_rows_on_one_side(part):
    group = pa.table({"part": [part], "low": [0], "high": [1], "rep": [1], "component": [1], "n": [3],
                      "shingles": pa.array([[1, 2, 3]], pa.list_(pa.int64()))})
    a, b = minhash.block_links(group)
    assert len(a) == len(b) == 0


def test_components_of_random_edges(spark):
    draw = random.Random(6)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(130)] + [(k, k + 1) for k in range(300, 340)]
    got = dict(map(tuple, minhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert minhash.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
