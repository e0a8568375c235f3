"""The commit log: one small JSON row per batch or compaction, folded now and then.

    <root>/commits                   rows, each written whole or not at all
    <root>/commits_folded/upto=M     what still counts of the rows up to number M

A reader lists the rows before the folds: a row that a fold takes in meanwhile is then
missed by neither. One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramledger.session import file_system
from gramledger.sinks.query_table import append_record

NOTHING = -1

# batch_id, base, text_base, floor, values_to: what the row commits, NOTHING for the rest.
# uris, unique_docs, processed_docs: the counters after it. pending: the batch whose documents
# the counters hold already, its phrases not yet.
COMMIT_SCHEMA = (
    "batch_id bigint, base bigint, text_base bigint, floor bigint, values_to bigint, pending bigint, made bigint, "
    "source string, source_batch bigint, uris bigint, unique_docs bigint, processed_docs bigint, "
    "rows_read bigint, born bigint, gone bigint, phrases bigint, "
    "phrase_length int, buckets int, tokenizer_version int"
)
COUNTERS = ("uris", "unique_docs", "processed_docs")


@dataclass(frozen=True)
class Position:
    """Where a ledger stands: newest batch, newest base and text base with their buckets and commit numbers.

    made: the number of the newest row. counters: those after the newest batch. floor:
    batches up to it cannot be read on their own any more.
    """

    last: int
    base: int
    buckets: int
    base_made: int
    text_base: int
    text_buckets: int
    text_made: int
    made: int
    floor: int
    values_to: int
    counters: tuple[int, ...]


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, name: str) -> list[str]:
        fs, path = file_system(self.spark, f"{self.root}/{name}")
        if not fs.exists(path):
            return []
        return [s.getPath().toString() for s in fs.listStatus(path) if not s.getPath().getName().startswith(("_", "."))]

    def rows(self) -> DataFrame:
        """All rows that were not folded, and what the last fold kept."""
        new = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.root}/commits")
        folds = self._folder("commits_folded")
        if not folds:
            return new
        kept = self.spark.read.schema(COMMIT_SCHEMA + ", upto bigint").option("basePath", f"{self.root}/commits_folded").json(folds)
        last = kept.agg(F.max("upto")).first()[0]  # a handful of rows
        return new.unionByName(kept.where(F.col("upto") == last).drop("upto")) if last is not None else new

    def add(self, record: dict, mode: str = "append") -> None:
        if mode == "overwrite":
            self._delete(self._folder("commits_folded"))
        append_record(self.spark, f"{self.root}/commits", record, COMMIT_SCHEMA, mode)

    def newest(self) -> dict:
        return self.rows().orderBy(F.desc("made")).first().asDict()

    def applied(self, source: str, source_batch: int) -> int | None:
        """The batch that a source's micro-batch became, or None. Once folded, that of the source's newest one."""
        of = self.rows().where((F.col("source") == source) & (F.col("source_batch") >= source_batch))
        row = of.orderBy("source_batch").select("batch_id").first()
        return row.batch_id if row else None

    def position(self, until: int | None = None) -> Position:
        """Where the ledger stands, or stood after a batch: with the newest base that is not past it."""
        here = F.lit(True) if until is None else F.col("base") <= until
        row = self.rows().agg(
            F.max("batch_id").alias("last"),
            F.max(F.when(here, F.struct("base", "made", "buckets"))).alias("b"),
            F.max(F.struct("text_base", "made", "buckets")).alias("t"),
            F.max("made").alias("made"), F.max("floor").alias("floor"), F.max("values_to").alias("values_to"),
            F.max_by(F.array(*COUNTERS), F.when(F.col("pending") == NOTHING, F.col("made"))).alias("counters"),
        ).first()
        if until is not None and until < row.floor:
            raise ValueError(f"batch {until} was given up by vacuum, {row.floor} is the first state left")
        last = row.last if until is None else min(until, row.last)
        return Position(last, row.b.base, row.b.buckets, row.b.made, row.t.text_base, row.t.buckets, row.t.made,
                        row.made, row.floor, row.values_to, tuple(row.counters))

    def bases(self, least: int) -> list[tuple[int, int, int]]:
        """(base, buckets, made) of the bases that stand at `least` or later, the newest one of each batch."""
        rows = self.rows().where(F.col("base") >= least).groupBy("base").agg(F.max(F.struct("made", "buckets")).alias("b"))
        return [(r.base, r.b.buckets, r.b.made) for r in rows.collect()]

    def fold(self) -> None:
        """Puts into one file what still counts, and deletes the rows.

        That is: the newest row of each base and source, the newest text base, batch and row.
        Between two folds there are as many rows as batches: few enough for the driver.
        """
        files, earlier = self._folder("commits"), self._folder("commits_folded")
        rows = sorted(self.rows().collect(), key=lambda r: r.made)
        floor = max(r.floor for r in rows)
        kept = {}
        for r in rows:  # later rows replace earlier ones of the same key
            kept["newest"] = r
            if r.pending == NOTHING:
                kept["settled"] = r
            if r.base >= floor or r.base == NOTHING:
                kept["base", r.base] = r
            if r.text_base >= kept.get("text", r).text_base:
                kept["text"] = r
            if r.batch_id >= kept.get("batch", r).batch_id:
                kept["batch"] = r
            if r.source is not None and r.source_batch >= kept.get(("source", r.source), r).source_batch:
                kept["source", r.source] = r
        kept = list({r.made: r for r in kept.values()}.values())
        fold = f"{self.root}/commits_folded/upto={rows[-1].made}"
        self.spark.createDataFrame(kept, COMMIT_SCHEMA).coalesce(1).write.mode("overwrite").json(fold)
        self._delete(files)
        self._delete([f for f in earlier if not f.endswith(f"upto={rows[-1].made}")])

    def _delete(self, files: list[str]) -> None:
        for file in files:
            fs, path = file_system(self.spark, file)
            fs.delete(path, True)
