"""Source mixes against a plain computation, and what a threshold promises."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from llm_rows import DOCS
from pyspark.sql import functions as F

from gramledger.llm import mixing

ROWS = "doc_id bigint, text string, source string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights, repeats):
    """Shares by weight; what is above its bound is cut to it, and the rest shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    found, rest = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in found]
        share = {s: Fraction(rest * weight[s], sum(weight[x] for x in free)) for s in free} if free else {}
        above = [s for s in free if share[s] > repeats * sizes[s]]
        if not above:
            return {s: float(v) for s, v in {**found, **share}.items()}
        for s in above:
            found[s] = Fraction(repeats * sizes[s])
            rest -= repeats * sizes[s]


def plain_mix(rows, weights, repeats, seed="mix"):
    sizes, places = Counter(), defaultdict(Counter)
    for i, text, source in rows:
        place = int(hashlib.md5(f"{seed}:{'' if i is None else i}:{text or ''}".encode()).hexdigest()[:15], 16)
        sizes[source] += words(text)
        places[source][place] += words(text)
    out, target = [], plain_targets(sizes, weights, repeats)
    threshold, copies = {}, {}
    for s, n in sizes.items():
        copies[s] = min(repeats, int(target[s] // n)) if n else 0
        rest = max(0.0, target[s] - copies[s] * n) if copies[s] < repeats else 0.0
        # Every set of documents below some threshold, the smallest set first.
        best, taken = (rest, 0), 0
        for p in sorted(p for p, w in places[s].items() if w):
            taken += places[s][p]
            if abs(taken - rest) < best[0]:
                best = (abs(taken - rest), p + 1)
        threshold[s] = best[1]
    for i, text, source in rows:
        place = int(hashlib.md5(f"{seed}:{'' if i is None else i}:{text or ''}".encode()).hexdigest()[:15], 16)
        out.append((i, words(text), sizes[source], target[source], words(text) * (copies[source] + (place < threshold[source]))))
    return sorted(out, key=str)


def mixed_rows(seed=1):
    draw = random.Random(seed)
    rows = [(i, " ".join(["w"] * int(draw.paretovariate(0.8))), draw.choice(["hot"] * 8 + ["a", "b", "é", "Z", "日本", None, ""])) for i in range(400)]
    rows += [(500, None, "a"), (501, "", "nothing"), (502, None, "nothing"), (None, "no id here", "b"), (None, "no id here", "b")]
    return rows + rows[3:6]  # repeated rows


@pytest.mark.parametrize("weights, repeats", [((1, 2, 3), 3), ((1,), 1), ((7, 1), 2)])
def test_mix_equals_plain_computation(spark, weights, repeats):
    rows = mixed_rows()
    docs = spark.createDataFrame(rows, ROWS).repartition(5)
    got = mixing.mix(docs, weights=weights, repeats=repeats).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, got), key=str) == plain_mix(rows, weights, repeats)


def test_targets_are_met_and_no_document_is_taken_too_often(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "big" if i % 10 else f"s{i % 3}") for i in range(3000)], ROWS)
    rows = mixing.mix(docs).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("copies")).alias("copies")).collect()
    assert all(abs(r.taken - r.target) <= 7 and r.copies <= 3 for r in rows)
    assert sum(r.target for r in rows) == pytest.approx(sum(1 + i % 7 for i in range(3000)))


def test_a_larger_budget_keeps_what_a_smaller_one_has(spark):
    docs = spark.createDataFrame([(i, "one two three", "ab"[i % 2]) for i in range(1000)], ROWS)
    less, more = ({r.doc_id for r in mixing.mix(docs, weights=w).where("copies > 0 AND source = 'a'").collect()} for w in ((1, 9), (1, 3)))
    assert less < more


def test_mixed_has_the_rows_as_often_as_the_mix_says(spark):
    rows = [(i, "a b c", None, ["x", "y", "y", "y"][i % 4], 5, "clash", 1, 2, "l", 3, "w", i) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    want = Counter({r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies})
    assert Counter(r.doc_id for r in got.collect()) == want


def test_odd_tables(spark, messy, nothing):
    assert mixing.mix(nothing).collect() == [] and mixing.mixed(nothing).collect() == []
    assert mixing.mix(messy).count() == messy.count()
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], ROWS)
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0]
    with pytest.raises(ValueError):
        mixing.mix(blank, weights=())
