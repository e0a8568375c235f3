"""The physical plans that scale depends on."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from gramledger import Ledger, LedgerOptions
from gramledger.contract import queries as Q
from gramledger.operators import counts as C
from gramledger.operators.documents import with_text
from gramledger.plans import delta as D

SF = "/root/testdata/sf0.001"


def plan(df, mode="simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)


@pytest.fixture(scope="module")
def ledger(spark, tmp_path_factory):
    ledger = Ledger.create(spark, str(tmp_path_factory.mktemp("plans")), LedgerOptions(buckets=4))
    for k, changes in enumerate(Q.rounds(Q.document_feed(spark, SF))[:2]):
        ledger.load(changes)
        if k == 0:
            ledger.compact()
    return ledger


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_flagship_shuffles_by_hash_and_by_phrase_only(spark):
    text = plan(Q.phrase_counts(spark, SF))
    keys = [re.sub(r"#\d+L?", "", k) for k in exchanges(text)]
    assert keys == ["phrase", "hash"]
    assert text.count("FileScan") == 1
    assert "n_chars" not in text
    assert "ArrowEval" not in text and "BatchEval" not in text
    assert re.search(r"partial_min_by", text) and re.search(r"partial_sum", text)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_regex_is_not_evaluated_again_in_a_filter(spark):
    text = plan(Q.phrase_counts(spark, SF))
    assert not re.search(r"Filter [^\n]*regexp_extract_all", text)


def test_full_state_neither_moves_nor_sorts_the_base(ledger):
    for state in (ledger.phrase_state(), ledger.uri_state(), ledger.doc_state()):
        text = plan(state)
        assert "Bucketed: true" in text
        base = next(line for line in text.splitlines() if "Bucketed: true" in line)
        join = next(i for i, line in enumerate(text.splitlines()) if "FullOuter" in line)
        assert text.splitlines()[join + 1].lstrip(" :+-") == base.lstrip(" :+-")
        assert len(exchanges(text)) == 1  # the logs


@pytest.mark.parametrize("partitions", [2, 4, 64])
def test_the_base_stays_put_whatever_the_shuffle_partitions(spark, ledger, no_broadcast, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        keys = ledger._log("write", 0, 1)
        for state in (ledger.phrase_state(), ledger.uri_state(keys)):
            lines = plan(state).splitlines()
            base = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
            assert not any("Exchange" in line or "Sort " in line for line in lines[base - 2 : base])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_large_batch_joins_the_base_in_its_buckets(ledger, no_broadcast):
    keys = ledger._log("write", 0, 1)
    text = plan(D.changed_uris(keys.drop("batch_id"), ledger.uri_state(keys)))
    lines = text.splitlines()
    base = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    assert "Exchange" not in lines[base - 1] and "Sort " not in lines[base - 1]
    assert "LeftSemi" in lines[base - 2]


def test_small_batch_is_broadcast_past_the_base(ledger):
    keys = ledger._log("write", 0, 1)
    text = plan(ledger.uri_state(keys))
    assert re.search(r"BroadcastHashJoin .*LeftSemi, BuildRight", text)


def test_point_lookup_reads_one_bucket_with_a_pushed_filter(ledger):
    at = ledger._position()
    text = plan(ledger._base("phrase", at).where(F.col("phrase") == "a b c d"), "formatted")
    assert "PushedFilters: [IsNotNull(phrase), EqualTo(phrase,a b c d)]" in text


def test_stored_texts_are_pruned_to_the_batches_of_retracted_documents(ledger):
    moved = ledger._log("doc", 0, 1)
    text = plan(ledger._signed_texts(ledger._log("text", 0, 1), moved, 1, ledger._position()))
    assert "dynamicpruning" in text


def test_only_texts_to_store_are_shuffled(spark, ledger, no_broadcast):
    feed = Q.rounds(Q.document_feed(spark, SF))[2]
    wanted = D.first_writes(ledger._log("doc", 0, 1))
    lines = plan(with_text(wanted, feed)).splitlines()
    moved = next(i for i, line in enumerate(lines) if "Exchange" in line and any("content" in x and "Project" in x for x in lines[i : i + 3]))
    assert any("might_contain" in line for line in lines[moved : moved + 5])


def test_texts_counted_by_document_are_not_shuffled_again(ledger):
    moved = ledger._log("doc", 0, 1)
    signed = ledger._signed_texts(ledger._log("text", 0, 1), moved, 1, ledger._position())
    keys = [re.sub(r"#\d+L?", "", k) for k in exchanges(plan(C.signed_counts(signed, "multiplier")))]
    assert keys[:2] == ["phrase", "hash"]


def test_lookup_reaches_below_the_aggregation(spark):
    lines = plan(Q.phrase_lookup(spark, SF)).splitlines()
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    assert any("partial_sum" in line for line in lines[:semi])


def test_changes_move_no_text(spark):
    text = plan(Q.changed_uris(spark, SF))
    assert exchanges(text)
    for line in text.splitlines():
        if "Aggregate" in line:
            assert "content" not in line


def wide_ledger(spark, folder, buckets=8):
    """Texts folded into a base, a batch behind it."""
    ledger = Ledger.create(spark, str(folder), LedgerOptions(buckets=buckets))
    feed = "uri string, content string, seq bigint"
    ledger.load(spark.createDataFrame([(f"u{i}", f"the text of document number {i}", 0) for i in range(300)], feed))
    ledger.compact()
    ledger.compact_texts()
    ledger.load(spark.createDataFrame([("u7", "now another text is here", 1)], feed))
    return ledger


def test_one_retracted_document_opens_one_bucket_of_the_texts(spark, tmp_path):
    ledger = wide_ledger(spark, tmp_path)
    moved = ledger._log("doc", 0, 1)
    assert moved.where("multiplier = -1").count() == 1
    text = plan(ledger._signed_texts(ledger._log("text", 0, 1), moved, 1, ledger._position()), "formatted")
    assert re.search(r"PushedFilters: \[[^\n]*EqualTo\(hash,", text)
    gone = moved.where("multiplier = -1").first().hash
    base = ledger._base("text", ledger._position()).where(F.col("hash").isin([gone]))
    scan = base._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert sum(len(part.files()) for part in scan.inputRDD().getPartitions()) == 1  # of 8
    assert base.count() == 1


def test_folded_texts_stay_in_their_buckets(spark, tmp_path, no_broadcast):
    ledger = wide_ledger(spark, tmp_path)
    moved = ledger._log("doc", 0, 1)
    for rows in (ledger.documents(), ledger._live_texts(ledger._position()), ledger._base_texts(moved, ledger._position())):
        lines = plan(rows).splitlines()
        base = next(i for i, line in enumerate(lines) if "Bucketed: true" in line and "content" in line)
        above = [line for line in lines[:base] if re.search(r"Exchange|Sort ", line)]
        indent = len(lines[base]) - len(lines[base].lstrip(" :+-"))
        # An operator stands above another if it is less indented and nothing in between is as little.
        depth, moved_ = indent, []
        for line in reversed(lines[:base]):
            own = len(line) - len(line.lstrip(" :+-"))
            if own < depth:
                depth = own
                moved_ += [line] if line in above and "Join" not in line else []
                if "Join" in line:
                    break
        assert moved_ == []


def test_phrases_and_texts_are_written_with_bloom_filters(spark, tmp_path):
    """A look-up over many logs opens the footers, and of the row groups few."""
    ledger = Ledger.create(spark, str(tmp_path), LedgerOptions(buckets=2))
    feed = "uri string, content string, seq bigint"
    for k in range(50):
        ledger.load(spark.createDataFrame([(f"u{k}", f"aa bb cc dd{k} and zz yy xx ww", k)], feed))
    at = ledger._position()
    here = ledger._log("phrase", at.base, at.last).where(F.col("phrase") == "bb cc dd17 and")
    assert [r.batch_id for r in here.collect()] == [17]
    found = here._jdf.queryExecution().executedPlan()
    scan = found.collectLeaves().head()
    rows = here.sparkSession._jvm.scala.jdk.javaapi.CollectionConverters.asJava(scan.metrics())["numOutputRows"].value()
    assert rows < 10 * 6  # without the filter all 50 logs would be read, 6 rows each


def test_ordered_scan_shuffles_nothing_and_opens_few_files(spark, tmp_path):
    from gramledger.sinks.query_table import QueryTable

    table = QueryTable(spark, str(tmp_path)).recreate()
    rows = spark.range(4000).select(F.format_string("p%05d", "id").alias("phrase"), F.lit(1).cast("bigint").alias("doc_count"), F.col("id").alias("total_count"))
    table.publish(rows, 0, files=16)
    assert "Exchange" not in plan(C.report(table.scan_ordered(), in_order=True))
    assert plan(table.scan_ordered()).count("FileScan") == 16
    assert plan(table.scan_ordered("p012", "p01234")).count("FileScan") <= 2
    assert [r.total_count for r in table.scan_ordered("p012", "p01234").collect()] == list(range(1235, 1300))
    assert [r.total_count for r in table.scan_ordered().collect()] == list(range(4000))
    changes = [("a first", 1, -1), ("p01236", 0, 0), ("p01237", 9, 99), ("p01237x", 1, 7), ("z last", 1, -2)]
    assert table.apply(spark.createDataFrame(changes, "phrase string, doc_count bigint, total_count bigint"), 1)
    assert [r.total_count for r in table.scan_ordered("p012", "p01234").collect()] == [1235, 99, 7, *range(1238, 1300)]
    assert [r.total_count for r in table.scan_ordered().collect()] == [-1, *range(1236), 99, 7, *range(1238, 4000), -2]
    assert [r.phrase for r in table.scan_ordered(after="p03998").collect()] == ["p03999", "z last"]


def test_phrases_of_a_document_are_counted_without_a_table_of_all(spark):
    """Only the texts are aggregated (by hash) and the sums (by phrase); no task holds (hash, phrase) of its documents."""
    assert not re.search(r"Aggregate\(keys=\[[^\]]*phrase", plan(Q.doc_phrase_counts(spark, SF)))
    keys = re.findall(r"Aggregate\(keys=\[([^\]]*)\]", plan(Q.phrase_counts(spark, SF)))
    assert keys and not [k for k in keys if "phrase" in k and "hash" in k]


def test_phrases_are_dealt_to_more_tasks_than_the_session_has_partitions(spark):
    found = Q.phrase_counts(spark, SF)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
    assert "hashpartitioning(phrase" in plan(found)
    assert all(int(n) >= 600 for n in re.findall(r"Exchange hashpartitioning\([^\n]*, (\d+)\)", plan(found)))


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    """Six deliveries would else lie on disk six times, until the driver collects its garbage."""
    ledger = Ledger.create(spark, str(tmp_path), LedgerOptions(buckets=2))
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = set(str(k) for k in iter_keys(spark, manager))
    ledger._write_log("phrase", 0, spark.range(1000).select(
        F.col("id").cast("string").alias("phrase"), F.lit(1).cast("bigint").alias("d_doc"), F.lit(1).cast("bigint").alias("d_total")).repartition(4, "phrase"))
    assert set(str(k) for k in iter_keys(spark, manager)) <= before


def iter_keys(spark, statuses):
    return list(spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(statuses.keySet()))


def test_a_load_sums_phrases_where_the_texts_lie(ledger, no_broadcast):
    moved = ledger._log("doc", 0, 1)
    signed = ledger._signed_texts(ledger._log("text", 0, 1), moved, 1, ledger._position(), 3)
    keys = [re.sub(r"#\d+L?", "", k) for k in exchanges(plan(C.signed_counts(signed, "multiplier", 4, "part")))]
    assert "part" in keys and not [k for k in keys if "phrase" in k]


def test_a_first_compaction_moves_the_logs_once(spark, tmp_path):
    ledger = Ledger.create(spark, str(tmp_path), LedgerOptions(buckets=4))
    ledger.load(spark.createDataFrame([("u", "aa bb cc dd ee", 1)], "uri string, content string, seq bigint"))
    keys = exchanges(plan(ledger.phrase_state(buckets=5)))
    assert len([k for k in keys if "phrase" in k]) <= 2  # the log, and the base that is empty
    ledger.compact(buckets=5)
    assert len({f.rsplit("/", 1)[1] for f in ledger._base("phrase", ledger._position()).inputFiles()}) <= 5
    assert ledger.phrase_counts().count() == 2


def test_changed_values_move_the_logs_once(ledger, no_broadcast):
    """The base and what a compacted batch changed: no look-up of the keys before, and the base stays where it is."""
    text = plan(ledger.changed_values(0))
    assert len(exchanges(text)) == 1
    assert "LeftSemi" not in text


FEED = "uri string, content string, seq bigint"


def three_rounds(spark, folder):
    """A ledger without a base, of which every round writes all URIs anew."""
    ledger = Ledger.create(spark, str(folder), LedgerOptions(buckets=2))
    for k in range(3):
        ledger.load(spark.createDataFrame([(f"u{i}", f"text {i} of round {k} in full", k) for i in range(20)], FEED))
    return ledger


def test_a_version_is_published_with_one_move_and_without_a_base(spark, tmp_path):
    from gramledger.plans.commits import NOTHING
    from gramledger.sinks.query_table import QueryTable

    ledger = three_rounds(spark, tmp_path / "ledger")
    table, plans = QueryTable(spark, str(tmp_path / "table")).recreate(), []
    write = table._write
    table._write = lambda rows, *rest: (plans.append(plan(rows)), write(rows, *rest))
    assert ledger.publish(table, files=3) == 2
    assert ledger.position().base == NOTHING
    assert plans[0].count("Exchange rangepartitioning") == 1 and not exchanges(plans[0])
    assert sorted(map(tuple, table.scan().collect())) == sorted(map(tuple, ledger.phrase_counts().collect()))
    files = table.ranges().orderBy("low").collect()
    assert sum(f.rows for f in files) == table.scan().count() and all(f.low <= f.high for f in files)
    assert all(a.high < b.low for a, b in zip(files, files[1:]))


def test_changed_values_of_a_large_batch_are_not_looked_up_in_the_logs_before(spark, tmp_path, no_broadcast):
    ledger = three_rounds(spark, tmp_path)
    text = plan(ledger.changed_values(2))
    assert "LeftSemi" not in text
    assert len([k for k in exchanges(text) if "phrase" in k]) <= 2  # the logs, and the base that is empty
    want = {r.phrase: (r.doc_count, r.total_count) for r in ledger.phrase_counts().collect()}
    got = {r.phrase: (r.doc_count, r.total_count) for r in ledger.changed_values(2).collect()}
    assert {p: c for p, c in got.items() if c != (0, 0)} == {p: want[p] for p in got if p in want}
    assert set(want) <= set(got) | {r.phrase for r in ledger.batch_deltas(0).collect()}
    ledger.load(spark.createDataFrame([("u0", "a small change of one text", 9)], FEED))
    assert "LeftSemi" in plan(ledger.changed_values(3))  # few rows: those before are cut down to its phrases


def test_many_layers_over_a_table_move_each_row_once(spark, tmp_path, no_broadcast):
    from gramledger.sinks.query_table import QueryTable

    ledger, table = Ledger.create(spark, str(tmp_path / "ledger"), LedgerOptions(buckets=2)), QueryTable(spark, str(tmp_path / "table")).recreate()
    table.LAYER_SHARE = 0
    for k in range(3):
        ledger.load(spark.createDataFrame([(f"u{i}", f"text {i} of round {k} in full", k) for i in range(20)], FEED))
        ledger.publish(table)
    assert len(table._newest().layers) == 2 and not list((tmp_path / "table").glob("changes-*"))
    assert len(exchanges(plan(table.scan()))) == 1
    assert sorted(map(tuple, table.scan().collect())) == sorted(map(tuple, ledger.phrase_counts().collect()))
    assert [r.phrase for r in table.scan_ordered().collect()] == sorted(r.phrase for r in ledger.phrase_counts().collect())


def test_combined_values_move_phrases_once(spark, tmp_path, no_broadcast):
    """What came and went is dealt to the table's buckets once, live texts once more; the table and what lies beside it stay."""
    from gramledger.plans.combined import CombinedTable, most, sketched, summed

    ledger, plans = Ledger.create(spark, str(tmp_path / "ledger"), LedgerOptions(buckets=2)), []
    values = CombinedTable(ledger, str(tmp_path / "values"), [
        summed("total", lambda: F.col("n")), most("longest", lambda: F.col("n")), sketched("about", lambda: F.col("hash"))])
    store = values._store
    values._store = lambda rows, *rest: (plans.append(plan(rows)), store(rows, *rest))[1]
    for k in range(2):
        ledger.load(spark.createDataFrame([(f"u{i}", f"text {i} of round {k} in full and in full and in", k) for i in range(20)] + [(f"k{k}", "a b c d", 0)], FEED))
        values.advance()
    moves = [[k for k in exchanges(text) if "phrase" in k] for text in plans]
    assert [len(m) for m in moves] == [1, 1, 1]  # built; what moved; the table after it
    got = {r.phrase: (r.documents, r.total, r.longest, r.about) for r in values.read().collect()}
    assert got["a b c d"] == (1, 1, 1, 1) and got["in full and in"] == (20, 40, 2, 20)
    assert {p: v[:2] for p, v in got.items()} == {r.phrase: (r.doc_count, r.total_count) for r in ledger.phrase_counts().collect()}


def test_exports_in_buckets_are_not_moved(spark, tmp_path, no_broadcast):
    """Deliveries, folds and reads leave a ledger's changed values in its buckets, and see what a sink without buckets sees."""
    from gramledger.sinks.query_table import ExportSink

    ledger = three_rounds(spark, tmp_path / "ledger")
    ledger.compact(buckets=3)
    ledger.load(spark.createDataFrame([(f"u{i}", f"text {i} of a fourth round", 9) for i in range(5)], FEED))
    sink, other, plans = ExportSink(spark, str(tmp_path / "it's here"), 3), ExportSink(spark, str(tmp_path / "other")), []
    assert sink.scan().count() == 0
    for n, seq in enumerate([3, 2, 1, 0, 2, 3, 1, 0]):
        values = ledger.changed_values(seq)
        if seq == 3:
            assert len([k for k in exchanges(plan(values.repartition(3, "phrase"))) if "phrase" in k]) == 1  # the logs
        for s in (sink, ExportSink(spark, sink.root), other):
            s.apply(values, seq)
        if n in (1, 4, 6):
            plans.append(plan(sink.newest()))
            sink.fold()
            other.fold()
        plans.append(plan(sink.scan()))
        got = sorted(map(tuple, sink.newest().collect()))
        assert got == sorted(map(tuple, other.newest().collect())) and len({r[0] for r in got}) == len(got)
    assert not [p for p in plans if "Exchange" in p]
    assert sorted(map(tuple, sink.scan().collect())) == sorted(map(tuple, ledger.phrase_counts().collect()))
    assert len(list((tmp_path / "it's here" / "deliveries").glob("fold=*"))) <= 2


def test_deliveries_outside_are_sorted_once_and_stored_by_difference(spark, tmp_path, no_broadcast):
    import pyarrow.parquet as pq

    from gramledger.sinks.outside import OutsideStore

    ledger, store = three_rounds(spark, tmp_path / "ledger"), OutsideStore(spark, str(tmp_path / "store"))
    for seq in (2, 0, 1):
        store.apply(ledger.changed_values(seq), seq)
    for file in (tmp_path / "store" / "parts").glob("*.parquet"):
        part = pq.ParquetFile(file)
        assert "DELTA_BYTE_ARRAY" in part.metadata.row_group(0).column(0).encodings if part.metadata.num_row_groups else True
        found = [r["phrase"].encode() for r in part.read().to_pylist()]
        assert found == sorted(found)
    text = plan(store.newest())
    assert len(exchanges(text)) == 1 and "Aggregate" not in text[text.index("Exchange"):]  # not before rows move as well
    assert sorted(map(tuple, store.scan().collect())) == sorted(map(tuple, ledger.phrase_counts().collect()))


def test_stored_values_are_sorted(spark, tmp_path):
    ledger = three_rounds(spark, tmp_path)
    ledger.store_values(2)
    found = [r.phrase for r in ledger._log("value", 1, 2).coalesce(1).collect()]
    files = len(ledger._log("value", 1, 2).inputFiles())
    assert sum(b < a for a, b in zip(found, found[1:])) < files
