"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 3; the best run counts, "first" has the first one, before code is
compiled). Every result is computed in full into the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from gramledger.config import LedgerOptions  # noqa: E402
from gramledger.contract import queries as Q  # noqa: E402
from gramledger.plans.ledger import Ledger  # noqa: E402
from gramledger.session import build_session, new_folder  # noqa: E402
from gramledger.sinks.query_table import QueryTable  # noqa: E402

BATCH_QUERIES = [
    "phrase_counts", "doc_phrase_counts", "unique_docs", "page_phrase_counts",
    "conversation_phrase_counts", "latest_by_uri", "phrase_lookup", "phrase_report",
    "changed_uris", "doc_transitions", "doc_phrases",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    first_run: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        took = round(time.perf_counter() - start, 3)
        seconds[name] = min(seconds.get(name, took), took)
        first_run.setdefault(name, took)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    for name in BATCH_QUERIES:
        for _ in range(runs):
            timed(name, lambda name=name: drain(Q.QUERIES[name](spark, folder)))

    feed = Q.document_feed(spark, folder)
    for _ in range(runs):
        ledger = Ledger.create(spark, new_folder(spark, "bench"), LedgerOptions(buckets=int(cpus)))
        table = QueryTable(spark, new_folder(spark, "bench-table")).recreate()
        first, second, third = Q.rounds(feed)
        timed("ledger_first_load", lambda: ledger.load(first))
        timed("ledger_compaction", lambda: ledger.compact())
        timed("ledger_second_load", lambda: ledger.load(second))
        timed("ledger_third_load", lambda: ledger.load(third))
        # Every hundredth URI gets the text of another document.
        small = third.where("uri % 100 = 0").withColumn("seq", F.col("seq") + 10)
        small = small.withColumn("content", F.concat("content", F.lit(" and a bit more")))
        timed("ledger_small_load", lambda: ledger.load(small))
        timed("ledger_counts", lambda: drain(ledger.phrase_counts()))
        timed("ledger_changed_values", lambda: drain(ledger.changed_values(2)))
        timed("ledger_point_lookup", lambda: ledger.lookup_one("of the and the"))
        timed("ledger_corpus_stats", lambda: drain(ledger.corpus_stats()))
        wanted = ledger.batch_deltas(2).select("phrase")
        timed("ledger_lookup_many", lambda: drain(ledger.lookup(wanted)))
        timed("ledger_publish", lambda: ledger.publish(table))
        timed("phrase_table_scan", lambda: drain(table.scan()))
        timed("phrase_table_ordered", lambda: drain(table.scan_ordered()))
        timed("ledger_compact_texts", lambda: ledger.compact_texts())
        again = small.withColumn("seq", F.col("seq") + 10).withColumn("content", F.concat("content", F.lit(" more")))
        timed("ledger_small_load_on_folded_texts", lambda: ledger.load(again))
        timed("ledger_publish_small", lambda: ledger.publish(table))
        timed("phrase_table_layered_scan", lambda: drain(table.scan()))

    print(
        json.dumps(
            {
                "metric": "total seconds over the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first": first_run,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
