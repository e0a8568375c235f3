from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from gramledger import Ledger, LedgerOptions
from gramledger.__main__ import main
from gramledger.operators.counts import combine, newest_exports, published_rows, report, stats_report
from gramledger.sinks.outside import OutsideStore, Store
from gramledger.sinks.query_table import ExportSink, QueryTable
from gramledger.sources.changes import stream_changes
from gramledger.sources.text_directory import Folder, FolderStream, read_text_directory, stream_text_directory
from gramledger.streaming.stream import drain, lag, start_stream

OPTIONS = LedgerOptions(buckets=2)


def exports(spark, rows):
    return spark.createDataFrame(rows, "phrase string, seq bigint, doc_count bigint, total_count bigint")


def test_newest_export_wins_and_deletes_are_remembered(spark, tmp_path):
    sink = ExportSink(spark, str(tmp_path))
    sink.apply(exports(spark, [("p", 2, 3, 4), ("q", 1, 1, 1)]), 0)
    sink.apply(exports(spark, [("p", 1, 1, 1)]), 1)
    assert sorted(map(tuple, sink.scan().collect())) == [("p", 3, 4), ("q", 1, 1)]
    sink.apply(exports(spark, [("p", 3, 0, 0)]), 2)
    assert list(map(tuple, sink.scan().collect())) == [("q", 1, 1)]
    sink.apply(exports(spark, [("p", 2, 3, 4)]), 3)
    sink.apply(exports(spark, [("p", 2, 3, 4)]), 3)
    assert list(map(tuple, sink.scan().collect())) == [("q", 1, 1)]
    assert sink.newest().where("phrase = 'p'").first().seq == 3
    for _ in range(2):
        sink.fold()
        assert list(map(tuple, sink.scan().collect())) == [("q", 1, 1)]
        sink.apply(exports(spark, [("p", 2, 3, 4)]), 3)
        sink.apply(exports(spark, [("p", 1, 9, 9)]), 7)
    assert list(map(tuple, sink.scan().collect())) == [("q", 1, 1)]
    sink.apply(exports(spark, [("p", 4, 1, 2)]), 8)
    assert sorted(map(tuple, sink.scan().collect())) == [("p", 1, 2), ("q", 1, 1)]


def test_exports_in_any_order(spark):
    rows = [(f"p{i}", s, (i + s) % 3, (i + s) % 3 * 2) for i in range(20) for s in range(5)]
    shuffled = rows + rows
    random.Random(0).shuffle(shuffled)
    got = sorted(map(tuple, published_rows(newest_exports(exports(spark, shuffled))).collect()))
    assert got == sorted((p, d, t) for p, s, d, t in rows if s == 4 and d)


def test_combine_adds_signed_updates(spark):
    schema = "phrase string, d_doc bigint, d_total bigint"
    one = spark.createDataFrame([("p", 1, 3), ("q", 1, 1)], schema)
    two = spark.createDataFrame([("p", -1, -3), ("q", 1, 2)], schema)
    assert sorted(map(tuple, combine(one, two).collect())) == [("p", 0, 0), ("q", 2, 3)]


def test_published_table_is_in_ranges_and_replaced_as_a_whole(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path / "ledger"), OPTIONS)
    table = QueryTable(spark, str(tmp_path / "table")).recreate()
    assert table.scan().count() == 0
    words = [f"w{i:03d}" for i in range(400)]
    ledger.load(feed([("a", " ".join(words), 0)]))
    ledger.publish(table, files=4)
    spans = (
        table.scan().groupBy(F.input_file_name())
        .agg(F.min("phrase").alias("lo"), F.max("phrase").alias("hi"))
        .orderBy("lo").collect()
    )
    assert len(spans) == 4
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))
    before = table.scan()
    ledger.publish(table, files=4)
    ledger.load(feed([("a", "now a short text", 1)]))
    ledger.publish(table, files=4)
    assert before.count() == 397
    wanted = spark.createDataFrame([("now a short text",), ("none of these words",)], "phrase string")
    assert sorted(map(tuple, table.lookup(wanted).collect())) == [("none of these words", 0, 0), ("now a short text", 1, 1)]
    other = Ledger.create(spark, str(tmp_path / "other"), OPTIONS)
    other.load(feed([("a", "of another ledger here", 0)]))
    with pytest.raises(ValueError, match="older"):
        other.publish(table)
    assert [tuple(r) for r in table.scan().collect()] == [("now a short text", 1, 1)]
    assert table.recreate().scan().count() == 0


def test_report_lines(spark):
    rows = spark.createDataFrame(
        [("b c", 12, 345), ("B", 1, 1), (" a", 2, 2)], "phrase string, doc_count bigint, total_count bigint"
    )
    assert [r.value for r in report(rows).collect()] == [
        "      2       2 ' a'", "      1       1 'B'", "     12     345 'b c'",
    ]
    stats = spark.createDataFrame([(1234567, 2, 1)], "uris bigint, unique_docs bigint, processed_docs bigint")
    assert [r.value for r in stats_report(stats).collect()] == [
        "# uris                : 1,234,567", "# unique documents    : 2", "# processed documents : 1",
    ]


def make_texts(folder):
    folder.mkdir()
    (folder / "sub").mkdir()
    (folder / "a.txt").write_text("one two three four\nfive", encoding="utf-8")
    (folder / "b c.txt").write_bytes(b"ein zwei drei \xff vier")
    (folder / "empty.txt").write_text("")
    (folder / "c.md").write_text("not this one here")
    (folder / "D.TXT").write_text("nor this one here")
    (folder / "sub" / "e.txt").write_text("nor the one below")


def test_text_directory(spark, tmp_path):
    folder = tmp_path / "texts"
    make_texts(folder)
    rows = {r.uri.rsplit("/", 1)[1]: r for r in read_text_directory(spark, str(folder)).collect()}
    assert rows["a.txt"].content == "one two three four\nfive"
    assert set(rows) == {"a.txt", "b%20c.txt", "empty.txt"}
    assert rows["empty.txt"].content == ""
    assert rows["b%20c.txt"].content.split() == ["ein", "zwei", "drei", "�", "vier"]
    assert all(r.uri.startswith("file:/") for r in rows.values())
    below = read_text_directory(spark, str(folder), recursive=True).select("uri").collect()
    assert any(r.uri.endswith("sub/e.txt") for r in below)


def test_edited_file_is_a_change(spark, tmp_path):
    folder = tmp_path / "texts"
    make_texts(folder)
    ledger = Ledger.create(spark, str(tmp_path / "ledger"), OPTIONS)
    ledger.load(read_text_directory(spark, str(folder)))
    assert ledger.lookup_one("two three four five") == (1, 1)
    (folder / "a.txt").write_text("something else is here now")
    ledger.load(read_text_directory(spark, str(folder)))
    assert ledger.lookup_one("two three four five") == (0, 0)
    assert ledger.lookup_one("something else is here") == (1, 1)
    assert ledger.lookup_one("ein zwei drei vier") == (1, 1)
    (folder / "a.txt").write_text("")
    ledger.load(read_text_directory(spark, str(folder)))
    assert ledger.lookup_one("something else is here") == (0, 0)
    assert ledger.corpus_stats().first().uris == 3


def test_stream_of_a_directory_catches_up_and_restarts(spark, tmp_path):
    folder = tmp_path / "texts"
    make_texts(folder)
    ledger = Ledger.create(spark, str(tmp_path / "ledger"), OPTIONS)
    sink = ExportSink(spark, str(tmp_path / "sink"))

    seen = []

    def export(values):
        return values.where("phrase <> 'one two three four'")

    def run():
        changes = stream_text_directory(spark, str(folder), files_per_batch=2)
        query = start_stream(
            ledger, changes, str(tmp_path / "checkpoint"), "texts", compact_every=2, exporter=export, sink=sink,
            after_batch=lambda _, batch_id: seen.append(batch_id),
        )
        drain(query)
        return lag(query)

    state = run()
    assert state["active"] is False
    assert ledger.lookup_one("ein zwei drei vier") == (1, 1)
    (folder / "late.txt").write_text("one two three four again")
    run()
    assert ledger.lookup_one("one two three four") == (2, 2)
    run()
    got = sorted(map(tuple, sink.scan().collect()))
    assert got == sorted(map(tuple, ledger.phrase_counts().where("phrase <> 'one two three four'").collect()))
    assert seen == sorted(seen) and seen


def test_stream_of_a_directory_sees_edits_and_empty_files(spark, tmp_path):
    folder = tmp_path / "texts"
    make_texts(folder)
    ledger = Ledger.create(spark, str(tmp_path / "ledger"), OPTIONS)

    def run():
        drain(start_stream(ledger, stream_text_directory(spark, str(folder)), str(tmp_path / "checkpoint"), "texts"))
        return ledger.commits().where("batch_id >= 0").count()

    batches = run()
    assert ledger.lookup_one("two three four five") == (1, 1)
    assert ledger.corpus_stats().first().uris == 3
    assert run() == batches  # nothing new, no batch
    (folder / "a.txt").write_text("something else is here now")
    run()
    assert ledger.lookup_one("two three four five") == (0, 0)
    assert ledger.lookup_one("something else is here") == (1, 1)
    (folder / "a.txt").write_text("")
    (folder / "late.txt").write_text("")
    run()
    assert ledger.lookup_one("something else is here") == (0, 0)
    assert tuple(ledger.corpus_stats().first()) == (4, 2, 2)


def test_files_of_one_time_are_all_seen(spark, tmp_path):
    """A file that gets the very time another one had, after that was read."""
    (tmp_path / "b.txt").write_text("b")
    os.utime(tmp_path / "b.txt", ns=(10**18, 10**18))
    stream = FolderStream(Folder({"path": str(tmp_path)}), None)
    first = stream.initialOffset()
    second = stream.latestOffset()
    for name in ("a.txt", "c.txt"):
        (tmp_path / name).write_text(name)
        os.utime(tmp_path / name, ns=(10**18, 10**18))
    again = FolderStream(Folder({"path": str(tmp_path)}), None)
    shares = again.partitions(second, third := again.latestOffset())
    got = sorted(c for s in shares for rows in again.read(s) for c in rows.column(1).to_pylist())
    assert got == ["a.txt", "c.txt"]
    assert again.latestOffset() == third
    assert sorted(c for s in again.partitions(first, second) for rows in again.read(s) for c in rows.column(1).to_pylist()) == ["b"]
    few = FolderStream(Folder({"path": str(tmp_path)}), 2)
    places = [few.initialOffset()]
    while (at := few.latestOffset()) != places[-1]:
        places.append(at)
    read = [sorted(c for s in few.partitions(x, y) for rows in few.read(s) for c in rows.column(1).to_pylist()) for x, y in zip(places, places[1:])]
    assert read == [["a.txt", "b"], ["c.txt"]]


def test_changes_as_a_stream_and_to_a_store_outside(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path / "ledger"), OPTIONS)
    store = OutsideStore(spark, str(tmp_path / "store"))

    late = OutsideStore(spark, str(tmp_path / "late"))

    def run(store=store, checkpoint="checkpoint"):
        drain(store.stream(stream_changes(spark, ledger.root), str(tmp_path / checkpoint)))
        return len(list((tmp_path / "store" / "deliveries").glob("*.json")))

    texts = ["one two three four", "two three four five", "three four five six"]
    for k, text in enumerate(texts):
        ledger.store_values(ledger.load(feed([("a", text, k)])))
    assert run() == 1
    assert run() == 1
    run(late, "late checkpoint")
    assert list(map(tuple, store.scan().collect())) == [("three four five six", 1, 1)]
    assert store.newest().count() == 3
    ledger.store_values(ledger.load(feed([("a", "one two three four", 9)])))
    ledger.store_values(3)  # again: nothing happens
    ledger.compact()
    ledger.load(feed([("a", "not stored yet at all", 10)]))
    assert run() == 2
    assert list(map(tuple, store.scan().collect())) == [("one two three four", 1, 1)]
    with pytest.raises(ValueError, match="not the next"):
        ledger.store_values(ledger.load(feed([("a", "one more text is here", 11)])))
    ledger.vacuum()
    with pytest.raises(Exception, match="value_log/batch_id=3"):  # it has not read that one, and must not go on as if it had
        run(late, "late checkpoint")
    run(OutsideStore(spark, str(tmp_path / "new")), "new checkpoint")  # begins behind what there was


def test_a_delivery_is_seen_whole_or_not_at_all(spark, tmp_path):
    store = OutsideStore(spark, str(tmp_path / "store"))
    rows = [(f"p{i}", 1, i + 1, i + 1) for i in range(100)]
    store.apply(exports(spark, rows).repartition(4), 0)
    assert store.scan().count() == 100
    broken = exports(spark, rows).repartition(4).withColumn("doc_count", F.when(F.col("phrase") == "p50", F.raise_error(F.lit("lost"))).otherwise(F.lit(7)).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        store.apply(broken.withColumn("seq", F.lit(2).cast("bigint")), 1)
    assert sorted(map(tuple, store.newest().collect())) == sorted(rows)
    store.apply(exports(spark, rows[:10]), 0)  # a repeat replaces what it delivered before
    assert store.scan().count() == 10
    assert set(Store(store.root).parts()) <= {f.name for f in (tmp_path / "store" / "parts").iterdir()}


def test_small_changes_are_published_as_layers(spark, feed, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path / "ledger"), OPTIONS)
    table = QueryTable(spark, str(tmp_path / "table")).recreate()
    ledger.load(feed([(f"u{i}", f"text number {i} of many others", 0) for i in range(200)]))
    ledger.publish(table, files=4)
    before, files = table.scan(), set((tmp_path / "table").glob("version-*/*.parquet"))
    for k in range(3):
        ledger.load(feed([(f"u{k}", f"now {k} is another one", k + 1), ("u9", f"the ninth is at {k}", k + 1)]))
        assert ledger.publish(table) == k + 1 == table.version()
        assert sorted(map(tuple, table.scan().collect())) == sorted(map(tuple, ledger.phrase_counts().collect()))
        assert [r.phrase for r in table.scan_ordered().collect()] == sorted(r.phrase for r in ledger.phrase_counts().collect())
    assert set((tmp_path / "table").glob("version-*/*.parquet")) == files  # not one of them written anew
    assert len(list((tmp_path / "table").glob("layer-*"))) == 3
    assert ledger.publish(table) == 3 and len(list((tmp_path / "table").glob("layer-*"))) == 3
    wanted = spark.createDataFrame([("the ninth is at",), ("text number 9 of",), ("text number 10 of",)], "phrase string")
    assert sorted(map(tuple, table.lookup(wanted).collect())) == [("text number 10 of", 1, 1), ("text number 9 of", 0, 0), ("the ninth is at", 1, 1)]
    assert before.count() == 2 * 200 + 200  # 'text number i of', 'number i of many', 'i of many others'
    ledger.load(feed([(f"u{i}", f"all of it is new, {i}", 50) for i in range(200)]))
    ledger.publish(table)  # too much for a layer
    assert sorted(map(tuple, table.scan().collect())) == sorted(map(tuple, ledger.phrase_counts().collect()))
    assert len(set((tmp_path / "table").glob("version-*"))) > 2
    ledger.load(feed([("u0", "and a small one again", 60)]))
    ledger.compact()
    ledger.vacuum()
    ledger.publish(table)  # the logs since then are gone
    assert sorted(map(tuple, table.scan().collect())) == sorted(map(tuple, ledger.phrase_counts().collect()))


def test_sink_before_its_first_delivery(spark, tmp_path):
    sink = ExportSink(spark, str(tmp_path))
    assert sink.scan().collect() == []
    for k in range(4):
        sink.apply(exports(spark, [("p", k, k, k)]), k)
        sink.fold()
    assert sorted(f.name for f in (tmp_path / "deliveries").glob("delivery=*")) == ["delivery=3"]
    sink.apply(exports(spark, [("p", 0, 5, 5)]), 0)  # a late repeat of what was folded and deleted
    assert list(map(tuple, sink.scan().collect())) == [("p", 3, 3)]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr("gramledger.__main__.build_session", lambda **_: spark)
    make_texts(tmp_path / "texts")
    ledger, table, out = (str(tmp_path / n) for n in ("ledger", "table", "out"))
    main(["setup", ledger, "--buckets", "2"])
    main(["load", ledger, str(tmp_path / "texts")])
    main(["lookup", ledger, "one two three four", "none of these words"])
    assert capsys.readouterr().out.splitlines() == [
        "      0       0 'none of these words'", "      1       1 'one two three four'",
    ]
    main(["print", ledger, out])
    assert "# unique documents    :" in capsys.readouterr().out
    assert spark.read.text(out).count() == 3
    main(["compact", ledger])
    QueryTable(spark, table).recreate()
    main(["publish", ledger, table])
    assert QueryTable(spark, table).scan().count() == 3


def test_a_local_folder_is_listed_bit_by_bit(tmp_path, monkeypatch):
    """No task asks for the whole folder at once, and about files of others not at all."""
    from gramledger.sources import files as module
    from gramledger.sources.text_directory import Folder, FolderStream, Share

    for k in range(50):
        (tmp_path / f"f{k}.txt").write_text("x")
    (tmp_path / ".hidden.txt").write_text("x")
    (tmp_path / "other.md").write_text("x")
    asked = []

    class Local(module.pafs.LocalFileSystem):
        def get_file_info(self, what):
            asked.append(len(what))
            return super().get_file_info(what)

    monkeypatch.setattr(module, "LISTED", 8)
    names = [i.base_name for i in module.files_below(Local(), str(tmp_path), wanted=lambda p: p.endswith(".txt"))]
    assert sorted(names) == sorted(f"f{k}.txt" for k in range(50))
    assert max(asked) <= 8 and sum(asked) == 50
    folder = Folder({"path": str(tmp_path)})
    shares = [[path for _, path in folder.files(Share(k, 4))] for k in range(4)]
    assert sorted(sum(shares, [])) == sorted(path for _, path in folder.files())
    stream = FolderStream(folder, None)
    assert stream.latestOffset()["mtime"] == max(mtime for mtime, _ in folder.files())
