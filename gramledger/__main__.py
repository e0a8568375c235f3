"""Command line: setup, load, print, lookup, compact, vacuum, publish."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from gramledger.config import LedgerOptions
from gramledger.operators.counts import report, stats_report
from gramledger.plans.ledger import Ledger
from gramledger.session import build_session
from gramledger.sinks.query_table import QueryTable
from gramledger.sources.text_directory import read_text_directory


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gramledger", description=__doc__)
    top.add_argument("--master", help="Spark master; default: as configured")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("ledger", help="ledger folder")
        return sub

    sub = command("setup", "create an empty ledger")
    sub.add_argument("--buckets", type=int, help="files per compacted table; default: as many as shuffle partitions")
    sub.add_argument("--phrase-length", type=int, default=LedgerOptions.phrase_length)
    sub = command("load", "load the *.txt files of a folder")
    sub.add_argument("folder")
    sub.add_argument("--recursive", action="store_true")
    sub = command("print", "write the report to a folder and show the corpus counters")
    sub.add_argument("out")
    sub = command("lookup", "show the counts of phrases")
    sub.add_argument("phrases", nargs="+")
    sub = command("compact", "fold the logs into the base tables")
    sub.add_argument("--buckets", type=int, help="deal the base tables out anew")
    sub.add_argument("--texts", action="store_true", help="fold the texts of live documents too")
    sub = command("vacuum", "delete logs and bases nothing needs any more")
    sub.add_argument("--keep-batches", type=int, default=0)
    sub = command("publish", "write a new version of a query table")
    sub.add_argument("table")
    sub.add_argument("--files", type=int)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(master=args.master)
    if args.command == "setup":
        buckets = args.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        Ledger.create(spark, args.ledger, LedgerOptions(phrase_length=args.phrase_length, buckets=buckets))
        return
    ledger = Ledger.open(spark, args.ledger)
    if args.command == "load":
        ledger.load(read_text_directory(spark, args.folder, args.recursive))
    elif args.command == "print":
        report(ledger.phrase_counts()).write.mode("overwrite").text(args.out)
        for row in stats_report(ledger.corpus_stats()).collect():
            print(row.value)
    elif args.command == "lookup":
        wanted = spark.createDataFrame([(p,) for p in args.phrases], "phrase string")
        for row in ledger.lookup(wanted).orderBy(F.col("phrase")).collect():
            print(f"{row.doc_count:7d} {row.total_count:7d} '{row.phrase}'")
    elif args.command == "compact":
        ledger.compact(args.buckets)
        if args.texts:
            ledger.compact_texts()
    elif args.command == "vacuum":
        for folder in ledger.vacuum(args.keep_batches):
            print(folder)
    elif args.command == "publish":
        ledger.publish(QueryTable(spark, args.table), args.files)


if __name__ == "__main__":
    main()
