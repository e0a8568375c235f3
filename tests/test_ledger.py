from __future__ import annotations

import random
import shutil
from collections import Counter

import model
import pytest
from pyspark.sql import functions as F

from gramledger import Ledger, LedgerOptions
from gramledger.operators.documents import current_docs, latest_by_uri, ref_counts, unique_docs
from gramledger.plans import delta as D
from gramledger.plans.combined import CombinedTable, most, sketched, summed
from gramledger.sources.change_feed import change_feed, complete

OPTIONS = LedgerOptions(buckets=2)


def counts_of(ledger):
    return {r.phrase: (r.doc_count, r.total_count) for r in ledger.phrase_counts().collect()}


def assert_like(ledger, want: model.Model):
    assert counts_of(ledger) == want.counts()
    assert {r.uri: r.hash for r in ledger.uri_state().collect()} == want.uris
    got = {r.hash: (r.content, r.ref_count) for r in ledger.documents().collect()}
    refs = want.refs()
    assert got == {h: (t, refs[h]) for h, t in want.texts.items()}
    n = len(want.texts)
    assert tuple(ledger.corpus_stats().first()) == (len(want.uris), n, n)


def history(rng, batches, uris=6, variants=True):
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(3, 9))) for _ in range(5)]
    if variants:
        texts += [texts[0].upper(), ", " + texts[1], texts[2].replace(" ", "", 1)]
    seq = 0
    for _ in range(batches):
        rows = []
        for _ in range(rng.randrange(1, 6)):
            rows.append((f"u{rng.randrange(uris)}", rng.choice(texts), seq))
            seq += 1
        yield rows


@pytest.mark.parametrize("seed", range(2))
def test_random_histories_give_the_model_state(spark, feed, tmp_path, seed):
    rng = random.Random(seed)
    ledger, want = Ledger.create(spark, str(tmp_path), OPTIONS), model.Model()
    for k, rows in enumerate(history(rng, 3)):
        ledger.load(feed(rows))
        want.apply(rows)
        if k == 1:
            ledger.compact()
    assert_like(ledger, want)
    if seed == 0:
        reopened = Ledger.open(spark, str(tmp_path))
        assert reopened.options == OPTIONS
        assert counts_of(reopened) == want.counts()


def test_result_does_not_depend_on_the_cut(spark, feed, tmp_path):
    rows = [r for batch in history(random.Random(9), 4, variants=False) for r in batch]
    want = model.Model()
    want.apply(rows)
    mixed = list(rows)
    random.Random(1).shuffle(mixed)
    for name, order, cut in (("whole", rows, len(rows)), ("cut", rows, -(-len(rows) // 3)), ("mixed", mixed, -(-len(rows) // 3))):
        ledger = Ledger.create(spark, str(tmp_path / name), OPTIONS)
        for i in range(0, len(order), cut):
            ledger.load(feed(order[i : i + cut]))
        assert counts_of(ledger) == want.counts()
        assert {r.uri: r.hash for r in ledger.uri_state().collect()} == want.uris


def test_an_older_write_changes_nothing(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    ledger.load(feed([("u", "the text of ten", 10), ("v", "some other text here", 3)]))
    ledger.load(feed([("u", "the text of five", 5)]))
    assert counts_of(ledger) == {"the text of ten": (1, 1), "some other text here": (1, 1)}
    ledger.compact()
    ledger.load(feed([("u", "The text, of ten", 12)]))  # the same document again, later
    ledger.load(feed([("u", "the text of eleven", 11)]))
    assert counts_of(ledger)["the text of ten"] == (1, 1)
    ledger.load(feed([("u", "the text of twelve", 12)]))  # of equal seq the later batch counts
    assert counts_of(ledger) == {"the text of twelve": (1, 1), "some other text here": (1, 1)}


def test_a_source_that_changes_between_reads_stops_the_load(spark, feed, tmp_path, monkeypatch):
    from gramledger.plans import ledger as module

    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    real = module.with_text
    for other in ([("a", "one two three five", 0)], [("a", "one two three four", 1)], []):
        monkeypatch.setattr(module, "with_text", lambda wanted, _, other=other: real(wanted, feed(other)))
        with pytest.raises(ValueError, match="source changed"):
            ledger.load(feed([("a", "one two three four", 0)]))
        assert counts_of(ledger) == {}


def test_buckets_can_change(spark, feed, tmp_path):
    ledger, want = Ledger.create(spark, str(tmp_path), OPTIONS), model.Model()
    for k, rows in enumerate(history(random.Random(4), 3)):
        ledger.load(feed(rows))
        want.apply(rows)
        if k == 0:
            ledger.compact()
        if k == 1:
            ledger.compact(buckets=5)
    assert Ledger.open(spark, str(tmp_path)).options.buckets == 5
    assert_like(ledger, want)
    ledger.compact(buckets=3)
    assert_like(Ledger.open(spark, str(tmp_path)), want)


def test_folding_bounds_what_is_read(spark, feed, tmp_path):
    root = str(tmp_path / "it's here")
    ledger, want = Ledger.create(spark, root, OPTIONS), model.Model()
    for k, rows in enumerate(history(random.Random(6), 6)):
        ledger.load(feed(rows))
        want.apply(rows)
        if k % 3 == 2:
            ledger.compact()
            ledger.compact_texts()
            gone = ledger.vacuum()
            assert gone
    assert_like(ledger, want)
    assert ledger._base("text", ledger._position()).count() == len(want.texts)  # dead ones are left behind
    for name in ("write", "uri", "doc", "text", "phrase"):
        assert ledger._folders(f"{root}/{name}_log", lambda _: True) == []
    assert len(ledger._folders(f"{root}/phrase_base", lambda _: True)) == 1
    rows = [("u0", "a b c d e f", 999)]
    ledger.load(feed(rows))
    want.apply(rows)
    assert_like(ledger, want)


def test_vacuum_keeps_what_the_kept_batches_are_read_from(spark, feed, tmp_path):
    root = str(tmp_path)
    ledger, totals, bases = Ledger.create(spark, root, OPTIONS), [], []
    for k in range(9):
        ledger.load(feed([(f"u{k}", f"one two three four {'x ' * k}", k)]))
        totals.append(k + 1)
        if k % 3 == 2:
            ledger.compact()
            bases.append(k)
    ledger.vacuum(keep_batches=4)
    kept = {int(f.rsplit("version=", 1)[1].split("_")[0]) for f in ledger._folders(f"{root}/phrase_base", lambda _: True)}
    assert kept == {2, 5, 8}  # batch 5 is read from the base at 5, batch 4 from the one at 2
    for batch in (5, 6, 7, 8):
        got = {r.phrase: r.doc_count for r in ledger.changed_values(batch).collect()}
        assert got["one two three four"] == totals[batch]
    ledger.vacuum(keep_batches=2)
    for batch in (6, 7, 8):
        assert {r.phrase: r.doc_count for r in ledger.changed_values(batch).collect()}["one two three four"] == totals[batch]
    for batch in (0, 2, 4, 5):
        with pytest.raises(ValueError, match="vacuum"):
            ledger.changed_values(batch)
    assert ledger.lookup_one("one two three four") == (9, 9)


def test_a_missing_base_is_no_empty_one(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    ledger.load(feed([("a", "one two three four", 0)]))
    ledger.compact()
    (folder,) = tmp_path.glob("phrase_base/*")
    shutil.rmtree(folder)
    with pytest.raises(FileNotFoundError):
        ledger.phrase_counts()


def test_compactions_at_one_batch_leave_each_other_alone(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    ledger.load(feed([("a", "one two three four five", 0)]))
    ledger.compact(buckets=4)
    reading = ledger.phrase_counts()
    ledger.compact(buckets=3)
    ledger.compact(buckets=4)
    assert reading.count() == ledger.phrase_counts().count() == 2


def test_commit_rows_are_folded(spark, feed, tmp_path):
    ledger, want = Ledger.create(spark, str(tmp_path), OPTIONS), model.Model()
    for k, rows in enumerate(history(random.Random(9), 6)):
        assert ledger.load(feed(rows), "s", k) == k
        want.apply(rows)
        if k in (1, 3):
            ledger.compact()
            assert len(list(tmp_path.glob("commits/*.json"))) == 0
            assert len(list(tmp_path.glob("commits_folded/*"))) == 1
            assert ledger.commits().count() <= 3 + k
    assert_like(Ledger.open(spark, str(tmp_path)), want)
    assert ledger.load(feed([("u0", "never to be seen at all", 99)]), "s", 3) == 3
    assert ledger.load(feed([("u0", "never to be seen at all", 99)]), "s", 5) == 5
    for batch in range(2, 6):
        assert ledger.changed_values(batch).count() >= 0
    assert_like(ledger, want)


def test_counters_are_kept_and_show_a_lag(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    assert tuple(ledger.corpus_stats().first()) == (0, 0, 0)
    for k, rows in enumerate(history(random.Random(5), 4)):
        ledger.load(feed(rows))
        if k == 2:
            ledger.compact()
        assert tuple(ledger.corpus_stats().first()) == tuple(ledger.counted_stats().first())
    uris, docs, done = ledger.corpus_stats().first()
    assert docs == done
    stopping = ledger.within(spark)
    stopping._signed_texts = lambda *_: (_ for _ in ()).throw(InterruptedError())
    late = feed([("new", "a text that nobody has seen", 1000), ("new", "a text that nobody saw", 1001)])
    with pytest.raises(InterruptedError):
        stopping.load(late)
    assert tuple(ledger.corpus_stats().first()) == (uris + 1, docs + 1, docs)
    assert ledger.lookup_one("a text that nobody") == (0, 0)
    row = ledger.progress().orderBy(F.desc("batch_id")).first()
    assert (row.batch_id, row.done, row.rows_read, row.born, row.gone, row.phrases, row.backlog) == (4, False, 2, 1, 0, None, 1)
    assert ledger.load(late) == 4
    assert tuple(ledger.corpus_stats().first()) == (uris + 1, docs + 1, docs + 1) == tuple(ledger.counted_stats().first())
    row = ledger.progress().orderBy(F.desc("batch_id")).first()
    assert (row.done, row.rows_read, row.phrases, row.backlog) == (True, 2, 2, 0)


@pytest.mark.parametrize("few", [1000, 0])
def test_texts_are_found_in_the_base_and_in_the_logs(spark, feed, tmp_path, monkeypatch, few):
    """Documents die and come back before and after texts are folded, with few keys to look up and with many."""
    monkeypatch.setattr("gramledger.plans.ledger.FEW_KEYS", few)
    ledger, want = Ledger.create(spark, str(tmp_path), OPTIONS), model.Model()
    for k, rows in enumerate(history(random.Random(11), 8)):
        ledger.load(feed(rows))
        want.apply(rows)
        if k in (2, 5):
            ledger.compact_texts()
        if k == 3:
            ledger.compact(buckets=3)
        if k == 6:
            ledger.compact()
            ledger.compact_texts()
            ledger.vacuum()
    assert_like(ledger, want)


def test_repeated_and_interrupted_batches(spark, feed, tmp_path):
    ledger, want = Ledger.create(spark, str(tmp_path), OPTIONS), model.Model()
    first = [("a", "one two three four five", 0), ("b", "one two three four", 1)]
    second = [("a", "six seven eight nine", 2), ("b", "six seven eight nine", 3)]
    assert ledger.load(feed(first), "s", 0) == 0
    assert ledger.load(feed(first), "s", 0) == 0
    want.apply(first)
    assert_like(ledger, want)

    # The batch writes all its folders and dies before its commit row.
    dying = Ledger(spark, str(tmp_path), OPTIONS)
    dying._commit = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("executor lost"))
    with pytest.raises(RuntimeError):
        dying.load(feed([("c", "never to be seen at all", 2)]), "s", 1)
    assert_like(ledger, want)
    assert ledger.load(feed(second), "s", 1) == 1
    want.apply(second)
    assert_like(ledger, want)

    # Loading the same content again changes nothing, delivered twice or not.
    ledger.load(feed(second + second))
    assert_like(ledger, want)
    assert ledger.batch_deltas(2).count() == 0


def test_document_that_dies_and_returns_with_another_text(spark, feed, tmp_path):
    ledger, want = Ledger.create(spark, str(tmp_path), OPTIONS), model.Model()
    for k, text in enumerate(["a b c d e", "x y z w", ", A, B C-D e!", "x y z w"]):
        rows = [("u", text, k)]
        ledger.load(feed(rows))
        want.apply(rows)
    assert_like(ledger, want)


def test_first_text_of_a_document_wins(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    ledger.load(feed([("z", "ab cd ef gh", 1), ("y", "abc def g h", 0), ("x", "a b c d e f g h", 1)]))
    row = ledger.documents().first()
    assert (row.content, row.ref_count) == ("abc def g h", 3)
    assert counts_of(ledger) == {"abc def g h": (1, 1)}
    ledger.load(feed([("x", "abcd e f gh", 5), ("w", "abcd e f gh", 6)]))
    assert ledger.documents().first().content == "abc def g h"
    assert ledger.documents().first().ref_count == 4


def test_one_document_behind_a_third_of_all_uris(spark, feed, tmp_path):
    rng = random.Random(1)
    rows = [
        (f"u{i}", "the very same text everywhere" if i % 3 == 0 else f"text number {i} of many", i)
        for i in range(3000)
    ]
    rng.shuffle(rows)
    ledger, want = Ledger.create(spark, str(tmp_path), OPTIONS), model.Model()
    ledger.load(feed(rows))
    want.apply(rows)
    assert_like(ledger, want)


def test_changed_values_are_totals_of_changed_phrases(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    ledger.load(feed([("a", "one two three four", 0), ("b", "one two three four five", 1)]))
    ledger.compact()
    ledger.load(feed([("b", "two three four five six", 2)]))
    got = {r.phrase: (r.seq, r.doc_count, r.total_count) for r in ledger.changed_values(1).collect()}
    assert got == {"one two three four": (1, 1, 1), "three four five six": (1, 1, 1)}
    first = {r.phrase: (r.seq, r.doc_count, r.total_count) for r in ledger.changed_values(0).collect()}
    assert first == {"one two three four": (0, 2, 2), "two three four five": (0, 1, 1)}
    ledger.compact()
    assert {r.phrase: (r.seq, r.doc_count, r.total_count) for r in ledger.changed_values(1).collect()} == got
    with pytest.raises(ValueError):
        ledger.changed_values(2)


def test_lookup_of_many_with_default(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    assert ledger.lookup_one("a b c d") == (0, 0)
    ledger.load(feed([("a", "a b c d e", 0)]))
    wanted = spark.createDataFrame([("a b c d",), ("no such phrase here",), ("a b c d",)], "phrase string")
    got = sorted(tuple(r) for r in ledger.lookup(wanted).collect())
    assert got == [("a b c d", 1, 1), ("no such phrase here", 0, 0)]


def test_views_answer_sql(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    ledger.load(feed([("a", "a b c d e", 0), ("b", "b c d e", 0)]))
    ledger.create_views("t_")
    row = spark.sql("SELECT sum(doc_count), max(phrase) FROM t_phrases").first()
    assert tuple(row) == (3, "b c d e")
    assert spark.sql("SELECT * FROM t_uris JOIN t_documents USING (hash)").count() == 2


def test_recreate_forgets_everything(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    ledger.load(feed([("a", "a b c d e", 0)]))
    ledger.compact()
    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    assert counts_of(ledger) == {}
    ledger.load(feed([("a", "f g h i", 0)]))
    ledger.compact()
    assert counts_of(ledger) == {"f g h i": (1, 1)}


def test_other_tokenizer_version_is_refused(spark, tmp_path):
    Ledger.create(spark, str(tmp_path), LedgerOptions(buckets=2, tokenizer_version=0))
    with pytest.raises(ValueError, match="tokenizer version 0"):
        Ledger.open(spark, str(tmp_path))


def test_buckets_follow_the_session(spark, tmp_path):
    Ledger.create(spark, str(tmp_path))
    assert Ledger.open(spark, str(tmp_path)).options.buckets == int(spark.conf.get("spark.sql.shuffle.partitions")) == 2


def test_phrase_length_option(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), LedgerOptions(buckets=2, phrase_length=2))
    ledger.load(feed([("a", "x y x y", 0)]))
    assert counts_of(ledger) == {"x y": (1, 2), "y x": (1, 1)}


# -- steps without stored state --------------------------------------------------


def test_feed_rows_without_uri_or_content_stop_the_job(spark, feed):
    for row in [(None, "text", 0), ("uri", None, 0), ("uri", "text", None)]:
        with pytest.raises(Exception, match="change feed row without"):
            complete(change_feed(feed([row]))).collect()
        with pytest.raises(Exception, match="change feed row without"):
            unique_docs(feed([row])).collect()


def test_same_hash_at_the_same_uri_is_no_change(spark, feed):
    old = latest_by_uri(feed([("a", "Some text", 0), ("b", "more", 0)])).select("uri", "hash")
    new = latest_by_uri(feed([("a", "some, TEXT", 1), ("b", "less", 1), ("c", "new", 1)]))
    assert sorted(r.uri for r in D.changed_uris(new, old).collect()) == ["b", "c"]


def test_transitions(spark):
    deltas = spark.createDataFrame(
        [("born", 2), ("more", 1), ("less", -1), ("gone", -2)], "hash string, delta bigint"
    ).withColumn("first", F.lit(None).cast("struct<seq: bigint, uri: string>"))
    state = spark.createDataFrame([("more", 1), ("less", 2), ("gone", 2)], "hash string, ref_count bigint")
    got = {r.hash: (r.old_count, r.new_count, r.multiplier) for r in D.transitions(deltas, state).collect()}
    assert got == {"born": (0, 2, 1), "more": (1, 2, 0), "less": (2, 1, 0), "gone": (2, 0, -1)}
    below = spark.createDataFrame([("gone", 1)], "hash string, ref_count bigint")
    with pytest.raises(Exception, match="negative reference count"):
        D.transitions(deltas.where("hash = 'gone'"), below).collect()


def test_batch_operators_on_a_feed_with_repeats(spark, feed):
    rows = [("a", "one", 0), ("a", "Two", 1), ("a", "Two", 1), ("b", "two", 5), ("c", "three", 2)]
    docs = {(r.content, r.ref_count) for r in current_docs(feed(rows)).collect()}
    assert docs == {("Two", 2), ("three", 1)}
    refs = {r.hash: r.ref_count for r in ref_counts(latest_by_uri(feed(rows))).collect()}
    assert refs == {model.digest("two"): 2, model.digest("three"): 1}


def test_combiners_with_and_without_undo(spark, feed, tmp_path):
    ledger, want = Ledger.create(spark, str(tmp_path / "ledger"), OPTIONS), model.Model()
    values = CombinedTable(ledger, str(tmp_path / "values"), [
        summed("total", lambda: F.col("n")), most("most", lambda: F.col("n")), sketched("about", lambda: F.col("hash"))])

    def expected():
        out = {}
        for text in want.texts.values():
            for phrase, n in Counter(model.phrases(text)).items():
                d, total, most_, _ = out.get(phrase, (0, 0, 0, 0))
                out[phrase] = (d + 1, total + n, max(most_, n), d + 1)
        return out

    for k, rows in enumerate(history(random.Random(21), 6)):
        ledger.load(feed(rows))
        want.apply(rows)
        if k != 3:  # then two batches at a time
            assert values.advance() == k == values.batch()
            assert {r.phrase: tuple(r)[1:] for r in values.read().collect()} == expected()
        if k == 4:
            ledger.compact()
    assert values.advance() == 5
    ledger.load(feed([("u0", "quite another text this time", 999)]))
    ledger.compact_texts()
    with pytest.raises(ValueError, match="not kept"):
        values.advance()
    want.apply([("u0", "quite another text this time", 999)])
    values.rebuild()
    assert {r.phrase: tuple(r)[1:] for r in values.read().collect()} == expected()


def test_buckets_follow_the_size_of_the_state(spark, feed, tmp_path, monkeypatch):
    """A state too large for its buckets gets more at its compaction; counts and loads after it are the same."""
    from gramledger.plans import ledger as module

    monkeypatch.setattr(module, "BUCKET_ROWS", 100)
    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    ledger.load(feed([(f"u{i}", f"a document that has number {i} and more", 0) for i in range(200)]))
    before = sorted(map(tuple, ledger.phrase_counts().collect()))
    ledger.compact()
    buckets = ledger.position().buckets
    assert buckets > OPTIONS.buckets
    assert sorted(map(tuple, ledger.phrase_counts().collect())) == before
    ledger.load(feed([("u7", "a document that has something else", 1)]))
    ledger.compact()
    assert ledger.position().buckets == buckets  # not for every batch anew
    assert ledger.lookup_one("a document that has") == (200, 200)
    assert ledger.lookup_one("number 7 and more") == (0, 0)


def test_a_phrase_summed_in_several_parts_is_one_everywhere(spark, feed, tmp_path, monkeypatch):
    """The log of a batch has a phrase once for every part of its texts; readers see one row for it."""
    monkeypatch.setattr("gramledger.plans.ledger.PART_CHARS", 20)
    ledger = Ledger.create(spark, str(tmp_path), OPTIONS)
    ledger.load(feed([(f"u{i}", f"aa bb cc dd only{i}", 0) for i in range(12)]))
    ledger.load(feed([("u0", "aa bb cc dd ee", 1), ("u1", "nothing of it", 1)]))
    assert ledger._log("phrase", -1, 0).where("phrase = 'aa bb cc dd'").count() > 1
    assert [tuple(r) for r in ledger.batch_deltas(0).where("phrase = 'aa bb cc dd'").collect()] == [("aa bb cc dd", 12, 12, 0)]
    assert {r.batch_id: r.phrases for r in ledger.progress().collect()} == {0: 13, 1: 4}
    want = {("aa bb cc dd", 1, 11, 11), ("bb cc dd only0", 1, 0, 0), ("bb cc dd only1", 1, 0, 0), ("bb cc dd ee", 1, 1, 1)}
    for _ in range(2):
        assert sorted(map(tuple, ledger.changed_values(1).collect())) == sorted(want)
        assert ledger.lookup_one("aa bb cc dd") == (11, 11)
        assert ledger.phrase_counts().count() == 12
        ledger.compact()
    assert ("aa bb cc dd", 0, 12, 12) in set(map(tuple, ledger.changed_values(0).collect()))
