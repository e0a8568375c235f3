"""Two load scenarios with known counts."""

from __future__ import annotations

import random

import model
from pyspark.sql import functions as F

from gramledger import Ledger, LedgerOptions

ONLY, PANIC, OVER = "is only a test", "test do not panic", "the test is over"
TEST, ENDED = "This is only a test", "The test is over, for now."

# uri, content, counts after the load
SCENARIO = [
    ("/foo1", "This is only a test.  Do not panic. This is only a test.", {ONLY: (1, 2), PANIC: (1, 1)}),
    ("/foo2", TEST, {ONLY: (2, 3), PANIC: (1, 1)}),
    ("/foo3", TEST, {ONLY: (2, 3), PANIC: (1, 1)}),
    ("/foo1", ENDED, {OVER: (1, 1), ONLY: (1, 1), PANIC: (0, 0)}),
    ("/foo2", ENDED, {OVER: (1, 1), ONLY: (1, 1), PANIC: (0, 0)}),
    ("/foo3", ENDED, {OVER: (1, 1), ONLY: (0, 0), PANIC: (0, 0)}),
]


def test_documents_come_change_and_go(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), LedgerOptions(buckets=2))
    digest = model.digest(TEST)

    def stored():
        row = ledger.documents().where(F.col("hash") == digest).first()
        return row and (row.content, row.ref_count)

    for seq, (uri, content, want) in enumerate(SCENARIO):
        if seq == 5:
            assert stored() == (TEST, 1)
        ledger.load(feed([(uri, content, seq)]))
        assert {p: ledger.lookup_one(p) for p in want} == want
        if seq == 2:
            ledger.compact()
    assert stored() is None
    stats = ledger.corpus_stats().first()
    assert tuple(stats) == (3, 1, 1)


def test_many_documents_share_a_phrase(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), LedgerOptions(buckets=2))
    rng = random.Random(11)
    filler = 0

    def word():
        nonlocal filler
        filler += 1
        return f"w{filler}x{rng.choice('abc')}"

    def load(start, end, phrase):
        ledger.load(feed([
            (f"/foo{i}", f"{phrase} {' '.join(word() for _ in range(12))}", 0) for i in range(start, end)
        ]))

    def only():
        return ledger.lookup_one("this is only a"), ledger.lookup_one("is only a test")

    def not_a():
        return ledger.lookup_one("this is not a"), ledger.lookup_one("is not a test")

    load(0, 100, "This is only a test")
    assert only() == ((100, 100), (100, 100))
    load(0, 2, "This is not a test")
    assert (only(), not_a()) == (((98, 98),) * 2, ((2, 2),) * 2)
    load(2, 100, "This is not a test")
    assert (only(), not_a()) == (((0, 0),) * 2, ((100, 100),) * 2)
    load(0, 50, "This is only a test")
    assert (only(), not_a()) == (((50, 50),) * 2, ((50, 50),) * 2)
