from __future__ import annotations

import random
import time
from collections import Counter

import model
import pytest
from pyspark.sql import functions as F

from gramledger.functions.text import content_hash, normalized, phrases, tokens
from gramledger.operators import documents
from gramledger.operators.counts import text_counts
from gramledger.operators.documents import document_phrases, text_pieces, with_normalized

# content, tokens, phrases, hash
CASES = [
    ("This is only a test", "this,is,only,a,test", ["this is only a", "is only a test"],
     "00bb2e31a01ac0422d0b08f752e4e72f4391ce15"),
    ("  This is only a test", ",this,is,only,a,test",
     [" this is only", "this is only a", "is only a test"],
     "00bb2e31a01ac0422d0b08f752e4e72f4391ce15"),
    ("This is only a test.", "this,is,only,a,test", ["this is only a", "is only a test"],
     "00bb2e31a01ac0422d0b08f752e4e72f4391ce15"),
    ("ab c", "ab,c", [], "9f04f41a848514162050e3d68c1a7abb441dc2b5"),
    ("a bc", "a,bc", [], "9f04f41a848514162050e3d68c1a7abb441dc2b5"),
    ("Café olé x y", "caf,ol,x,y", ["caf ol x y"], "30cbfd26742c778660ff7e1afbfd680216719232"),
    ("a b a b a b", "a,b,a,b,a,b", ["a b a b", "b a b a", "a b a b"], None),
    (", a b c", ",a,b,c", [" a b c"], None),
    ("a b c d ...", "a,b,c,d", ["a b c d"], None),
    ("aİb c d e", "ai,b,c,d,e", ["ai b c d", "b c d e"], None),
    ("one\ntwo\tthree_four", "one,two,three,four", ["one two three four"], None),
]


@pytest.mark.parametrize("case", CASES, ids=lambda c: repr(c[0]))
def test_literal_cases(spark, case):
    content, toks, found, digest = case
    c = F.lit(content)
    row = spark.range(1).select(
        tokens(c).alias("t"), phrases(normalized(c)).alias("p"), content_hash(c).alias("h")
    ).first()
    assert row.t == toks.split(",")
    assert row.p == found
    if digest:
        assert row.h == digest


@pytest.mark.parametrize("content", ["", "...", " \n "])
def test_token_free_texts_are_one_document_without_phrases(spark, content):
    c = F.lit(content)
    row = spark.range(1).select(
        tokens(c).alias("t"), phrases(normalized(c)).alias("p"), content_hash(c).alias("h")
    ).first()
    assert row.h == "da39a3ee5e6b4b0d3255bfef95601890afd80709"
    assert row.p == []
    assert row.t == model.tokens(content)


def random_text(rng: random.Random, words: int) -> str:
    alphabet = "abAB01 é.,\nKßİ日"
    return "".join(rng.choice(alphabet) for _ in range(words))


def test_random_texts_against_the_model(spark):
    rng = random.Random(7)
    texts = [random_text(rng, rng.randrange(0, 60)) for _ in range(400)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, content string")
    c = F.col("content")
    got = rows.select(
        "id", tokens(c).alias("t"), phrases(normalized(c)).alias("p"), content_hash(c).alias("h")
    ).collect()
    for r in got:
        assert r.t == model.tokens(texts[r.id])
        assert r.p == model.phrases(texts[r.id])
        assert r.h == model.digest(texts[r.id])


def test_other_phrase_lengths(spark):
    text = normalized(F.lit(", a b c d e"))
    row = spark.range(1).select(phrases(text, 2).alias("two"), phrases(text, 5).alias("five")).first()
    assert row.two == [" a", "a b", "b c", "c d", "d e"]
    assert row.five == [" a b c d", "a b c d e"]


def test_long_runs_cost_no_more_than_their_length(spark):
    rows = spark.range(1).select(
        F.concat(F.repeat(F.lit(" "), 2_000_000), F.lit("a"), F.repeat(F.lit("."), 2_000_000),
                 F.repeat(F.lit("b"), 2_000_000)).alias("content")
    )
    c = F.col("content")
    start = time.time()
    row = rows.select(
        F.size(phrases(normalized(c))).alias("n"), content_hash(c).alias("h"), F.size(tokens(c)).alias("t")
    ).first()
    assert (row.n, row.t) == (0, 3)
    assert time.time() - start < 30


def test_pieces_of_a_text_have_its_phrases(spark):
    rng = random.Random(3)
    texts = [random_text(rng, 300) for _ in range(20)]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "hash string, content string")
    pieces = text_pieces(with_normalized(docs), 4, tokens=7)
    got = sorted((r.hash, r.phrase) for r in document_phrases(pieces, 4, "hash").collect())
    assert got == sorted((str(i), p) for i, t in enumerate(texts) for p in model.phrases(t))


def test_texts_in_pieces_count_like_the_model(spark, monkeypatch):
    rng = random.Random(5)
    texts = [random_text(rng, rng.randrange(0, 400)) for _ in range(40)]
    docs = with_normalized(
        spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "hash string, content string")
    )
    found = [model.phrases(t) for t in texts]
    want = sorted(
        (p, sum(p in f for f in found), sum(f.count(p) for f in found)) for p in {p for f in found for p in f}
    )
    for tokens in (1, 3, 4096):
        monkeypatch.setattr(documents, "text_pieces", lambda t, n, tokens=tokens: text_pieces(t, n, tokens))
        assert sorted(map(tuple, text_counts(docs).collect())) == want


@pytest.mark.parametrize("chars", [1 << 22, 50, 7])
def test_texts_in_shares_count_like_the_model(spark, monkeypatch, chars):
    """Within a row, whole or in shares; an empty text and one too short have nothing."""
    rng = random.Random(11)
    texts = ["", "one two three", *(random_text(rng, rng.randrange(0, 400)) for _ in range(30))]
    docs = with_normalized(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "hash string, content string"))
    monkeypatch.setattr(documents, "SHARE_CHARS", chars)
    monkeypatch.setattr(documents, "PIECE_TOKENS", 5)
    counts = documents.document_phrase_counts(docs)
    want = sorted((str(i), p, n) for i, t in enumerate(texts) for p, n in Counter(model.phrases(t)).items())
    assert sorted(map(tuple, counts.collect())) == want


def test_texts_without_repeats_are_not_sorted(spark):
    """A text's phrases come as they stand in it, once each; only those of texts that repeat some are put in order."""
    docs = spark.createDataFrame([("1", "z y x w v"), ("2", "b a b a b a b"), ("3", ""), ("4", " one two three")], "hash string, text string")
    got = documents.document_phrase_counts(docs.coalesce(1)).collect()
    assert [tuple(r) for r in got] == [
        ("1", "z y x w", 1), ("1", "y x w v", 1), ("2", "a b a b", 2), ("2", "b a b a", 2), ("4", " one two three", 1)]


def test_phrases_of_tokens_of_any_length(spark):
    """Short and long tokens, an empty first one and an open end, against the model."""
    rng = random.Random(17)
    texts = ["".join(rng.choice(["", " "])) + " ".join("x" * rng.choice([1, 2, 9, 500]) for _ in range(rng.randrange(9))) + rng.choice(["", " ", "."]) for _ in range(60)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", phrases(normalized(F.col("t"))).alias("p")).collect()
    assert [(r.t, r.p) for r in rows] == [(t, model.phrases(t)) for t in texts]
