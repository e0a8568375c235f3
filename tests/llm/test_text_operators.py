"""Licences, decontamination, quality and pieces against plain Python."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from gramledger.llm import decontaminate, licenses, piece_bpe, quality
from gramledger.llm.text import TERM_BYTES, split_words
from gramledger.llm import text as text_module

TERM = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def test_words_across_chunks(monkeypatch):
    text = ("Äb c9-d " * 50 + "x" * 70 + " É" * 9).encode()
    for size in (1, 7, 64, 10_000):
        monkeypatch.setattr(text_module, "CHUNK", size)
        got = [w.decode() for part in split_words(text, TERM_BYTES) for w in part]
        assert got == terms(text.decode())


# -- licences -------------------------------------------------------------------


def test_scan_of_odd_rows(messy, nothing):
    rows = licenses.scan_licenses(messy).collect()
    assert len(rows) == messy.count()
    mit = next(r for r in rows if r.doc_id == 8)
    assert (mit.n_base, mit.first_word, mit.last_word, mit.base_labels, mit.labels, mit.score) == (1, 3, 3, "mit", "mit", 1.0)
    empty = [r for r in rows if r.doc_id in (0, 1)]
    assert all((r.n_words, r.n_base, r.first_word, r.labels, r.score) == (0, 0, None, "", 0.0) for r in empty)
    assert licenses.scan_licenses(nothing).collect() == []


def test_every_place_is_found_whatever_is_rare():
    draw = random.Random(3)
    vocabulary = "mit license apache general public gnu the lesser cc by nc sa 4 0 x".split()
    templates = licenses.all_templates()
    for counts in ({}, {b"license": 9, b"mit": 50}, {b"public": 1, b"general": 2, b"license": 0}):
        index = licenses.Index(templates, counts)
        for _ in range(60):
            words = [draw.choice(vocabulary) for _ in range(draw.randint(0, 40))]
            _, found = licenses.places(" ".join(words).encode(), index.words)
            got = sorted((t.label, t.words, s, round(x, 9)) for t, s, x in index.alignments(found))
            want = []
            for t in templates:
                own = [w.decode() for w in t.words]
                for s in range(-len(own), len(words)):
                    here = [0 <= s + i < len(words) and words[s + i] == w for i, w in enumerate(own)]
                    if all(here[i] for i in t.key):
                        want.append((t.label, t.words, s, round(sum(here) / len(own), 9)))
            assert got == sorted(want)


# -- decontamination ------------------------------------------------------------


def brute(text, items, window):
    words, hit, found = terms(text), set(), set()
    for name, item in items:
        own = terms(item)
        size = min(window, len(own))
        grams = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1) if grams else ():
            if tuple(words[i : i + size]) in grams:
                hit.update(range(i, i + size))
                found.add(name)
    return len(words), len(hit), sorted(str(x) for x in found if x is not None)


@pytest.mark.parametrize(("shard", "chunk", "block"), [(1 << 21, 1 << 22, 1 << 22), (8, 16, 2), (64, 5, 1)])
def test_matches_equal_brute_force(spark, monkeypatch, shard, chunk, block):
    draw = random.Random(shard)
    words = list("abcdefg")
    items = [(k, " ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 2, 4, 9])))) for k in range(9)] + [(None, "g g g g"), (3, "a a a")]
    texts = [" ".join(draw.choice([*words, "zz"]) for _ in range(draw.randint(0, 90))) for _ in range(25)] + [None, ""]
    tests = decontaminate.TestSet.of([(None if k is None else str(k), t.encode()) for k, t in items], 4)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    monkeypatch.setattr(text_module, "CHUNK", chunk)
    import pyarrow as pa

    rows = pa.RecordBatch.from_pydict({"row": pa.array(range(len(texts))), "id": pa.array(range(len(texts))),
                                       "text": pa.array([None if t is None else t.encode() for t in texts])})
    out = [r for b in decontaminate.matches(iter([rows]), tests, 4) for r in b.to_pylist()]
    for r, text in zip(out, texts, strict=True):
        spans = list(zip(r["hits"][::2], r["hits"][1::2], strict=True))
        assert (r["n_words"], sum(e - b for b, e in spans), sorted(set(r["items"]))) == brute(text, items, 4)
        assert all(spans[i][1] < spans[i + 1][0] for i in range(len(spans) - 1))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.undo()
    found = decontaminate.judged(decontaminate.find_matches(docs, bench, window=4, block_words=block)).collect()
    for r in found:
        n, hit, names = brute(texts[r.doc_id], items, 4)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(names), digest)
        assert r.contaminated == (hit > 0 and 20 * hit >= n)


def test_removal_and_odd_rows(spark, messy, nothing):
    bench = spark.createDataFrame([(1, "another text of a repeated id"), (2, None)], "item_id bigint, text string")
    left = decontaminate.remove_contaminated(messy, bench)
    assert left.columns == messy.columns
    gone = sorted(r[0] for r in messy.exceptAll(left).select("doc_id").collect())
    assert gone == [7, 7, 7, 7]  # all rows of the id go
    assert decontaminate.remove_contaminated(messy, bench.where("false")).count() == messy.count()
    assert decontaminate.remove_contaminated(nothing, bench).count() == 0


def test_suffix_array_is_sorted():
    draw = np.random.default_rng(1)
    words = np.append(draw.integers(0, 4, 300), 0).astype(np.int32)
    at = np.flatnonzero(words)
    order = decontaminate.suffix_array(words, at, 8)

    def suffix(i):
        part = words[i : i + 8].tolist()
        return part[: part.index(0)] if 0 in part else part

    keys = [suffix(i) for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == at.tolist()


# -- quality --------------------------------------------------------------------


def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)} if len(grams) < 2000 else None
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), hit and len(hit) or 0)


def test_quality_of_odd_rows(messy, nothing):
    rows = quality.judge(messy).collect()
    assert len(rows) == messy.count()
    texts = {}
    for r in messy.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, set()).add(r.text)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        wanted = [plain_quality(t) for t in texts[r.doc_id]]
        assert got in wanted or r.n_words > 2000
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
    assert quality.judge(nothing).collect() == []
    assert set(quality.keep_good(messy).columns) == set(messy.columns)


def test_repeated_windows(spark):
    draw = random.Random(8)
    texts = [" ".join(draw.choice("ab") for _ in range(draw.randint(0, 40))) for _ in range(40)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    for r in quality.judge(df).collect():
        assert r.n_repeat_words == plain_quality(texts[r.doc_id])[4]


# -- pieces ---------------------------------------------------------------------

ODD_TEXTS = ["", "a", " ", "  a  b ", "\n\n x\t\ty", "héllo wörld 你好 🎉🎉 ▁x ▁▁", "<s> </s> <0x0A> <unk>", "\x00\x01 a\x00", "     " * 20 + "x", "a" * 5000,
             " a\nb c\n", "1234 5678 3.14", "ﬁ ½", "日本語、です。 नमस्ते", "\r\n a \r\n", "▁", "▁▁ a▁b", " \n ", "…—“x”", "don't I'm we're", "x" * 70 + " " * 40]


def test_ids_and_texts_equal_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    draw = random.Random(2)
    texts = ODD_TEXTS + ["".join(draw.choice("ab e.\n▁é,'1日") for _ in range(draw.randint(0, 60))) for _ in range(200)] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for checked in (True, False):
        rows = piece_bpe.encode(docs, path, checked=checked).collect()
        assert len(rows) == len(texts)
        for r in rows:
            want = library.encode(texts[r.doc_id] or "", add_eos=True)
            assert (r.ids, r.n_tokens, r.decoded, r.differing) == (want, len(want), library.decode(want), 0)
    for r in piece_bpe.digests(docs, path).collect():
        want = library.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want).encode()).hexdigest()


def test_pieces_of_odd_rows(messy, nothing):
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert piece_bpe.digests(messy, path).count() == messy.count()
    assert piece_bpe.digests(nothing, path).collect() == []
