"""Importance resampling against a plain computation; brackets that have to be widened."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gramledger.llm import resampling
from gramledger.llm.order import numbered
from gramledger.llm.resampling import Options, WordBuckets
from pyspark.sql import functions as F

ROWS = "doc_id bigint, text string"


def runs(text, longest):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return w, [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, o):
    def bucket(f):
        return zlib.crc32(f.encode()) % o.buckets

    s = Counter(bucket(f) for _, t in docs for f in runs(t, o.longest)[1])
    t = Counter(bucket(f) for x in target for f in runs(x, o.longest)[1])
    all_s, all_t = sum(s.values()) + o.buckets, sum(t.values()) + o.buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in s}
    rows = []
    for name, text in docs:
        w, found = runs(text, o.longest)
        h = int(hashlib.sha256(f"{o.seed}:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in found)
        rows.append([name, len(w), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in rows if r[1] >= o.least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for k, r in enumerate(able[: len(able) * o.drawn // 100], 1):
        r[5] = k
    return sorted(map(tuple, rows), key=str)


def texts(n=300, seed=4):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["ÉTÉ", "naïve", "日本", "Zebra"]
    rows = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(0, 60)))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " .,- "), (None, rows[7][1]), (None, rows[7][1] + " more"), (None, rows[7][1])]
    return rows + rows[:4]


@pytest.mark.parametrize("options", [
    Options(), Options(longest=3, buckets=997, drawn=25, least_words=5, seed="x"), Options(drawn=100, least_words=0), Options(drawn=0)])
def test_resampling_equals_plain_computation(spark, options):
    rows, target = texts(), [None, "", "w1 w2 w3 zebra w1", "naïve été ÉTÉ w7"]
    docs = spark.createDataFrame(rows, ROWS).repartition(4)
    got = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), options).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, target, options)


def test_runs_across_parts_of_a_long_text(monkeypatch):
    text = " ".join(f"w{i}" for i in range(500))
    known = WordBuckets(10_000)
    whole = np.sort(np.concatenate([b for _, b in resampling.features(text.encode(), known, 3)]))
    monkeypatch.setattr("gramledger.llm.text.CHUNK", 64)
    parts = list(resampling.features(text.encode(), known, 3))
    assert len(parts) > 10 and sum(n for n, _ in parts) == 500
    assert (np.sort(np.concatenate([b for _, b in parts])) == whole).all() and len(whole) == 500 + 499 + 498


@pytest.mark.parametrize("scores", [[5] * 900, list(range(900)), [0] * 899 + [9], [-(2**60)] + [3] * 500 + [2**60] * 399])
@pytest.mark.parametrize("k", [1, 2, 90, 899, 900])
def test_bracket_holds_the_cutoff(spark, scores, k, monkeypatch):
    monkeypatch.setattr(resampling, "ACCURACY", 10)  # a sketch that is often wrong
    rows = spark.createDataFrame(list(enumerate(scores)), "row bigint, score bigint")
    low, high, above = resampling.bracket(rows, len(scores), k)
    ordered = sorted(scores, reverse=True)
    cut = ordered[k - 1]
    assert (low is None or low <= cut) and (high is None or cut <= high)
    assert above == sum(high is not None and s > high for s in scores) < k


def test_ties_are_settled_by_id(spark):
    rows = spark.createDataFrame([(i, i % 50 or None, 30, 30, 0, 7) for i in range(200)], "row bigint, doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")
    ordered = sorted((i % 50 or 10**9, i) for i in range(200))
    for k in (1, 4, 100, 197, 200):
        last = resampling.cutoff(rows, k, 200)
        assert last.row == ordered[k - 1][1]
        assert {r.row for r in rows.where(resampling.not_after(last)).collect()} == {r for _, r in ordered[:k]}


def test_drawn_documents_look_more_like_the_target(spark):
    draw = random.Random(1)
    docs = [(i, " ".join(draw.choices([f"{'good' if i % 5 == 0 else 'other'}{j}" for j in range(40)], k=40))) for i in range(500)]
    target = spark.createDataFrame([(" ".join(f"good{j}" for j in range(40)),)], "text string")
    drawn = resampling.resample(spark.createDataFrame(docs, ROWS), target).where("rank IS NOT NULL").collect()
    assert len(drawn) == 50 and all(r.doc_id % 5 == 0 for r in drawn)


def test_odd_tables(spark, messy, nothing):
    target = spark.createDataFrame([("some words",)], "text string")
    assert resampling.resample(nothing, target).collect() == []
    assert resampling.resample(messy, target).count() == messy.count()
    assert resampling.resample(messy, target.limit(0), Options(drawn=50)).where("rank IS NOT NULL").count() > 0


def test_numbers_in_a_global_order(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    assert [r.n for r in numbered(rows, F.col("x").desc(), name="n").orderBy(F.desc("x")).collect()] == list(range(1, 1001))
    assert numbered(rows.limit(0), F.col("x"), name="n").collect() == []
