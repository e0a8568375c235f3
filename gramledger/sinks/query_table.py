"""The published query table: versions sorted by phrase, and an export log."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gramledger.operators.counts import lookup, newest_exports, published_rows
from gramledger.session import STORED, file_system, one_write

COUNTS_SCHEMA = "phrase string, doc_count bigint, total_count bigint"
EXPORT_SCHEMA = "phrase string, seq bigint, doc_count bigint, total_count bigint"


def append_record(spark: SparkSession, path: str, record: dict, schema: str, mode: str = "append") -> None:
    """Adds one row to a small log of commits. The new file appears whole or not at all."""
    types = {f.name: f.dataType for f in StructType.fromDDL(schema)}
    row = spark.range(1).select(*(F.lit(v).cast(types[k]).alias(k) for k, v in record.items()))
    row.coalesce(1).write.mode(mode).json(path)


class QueryTable:
    """Versions of the counts, in force once the newest row of `<root>/published` names them.

    A version is a base, written in ranges of phrases, and layers over it with the new totals
    of phrases that changed since. Publishing a change writes a layer and leaves the base's
    files to the next version; readers of earlier versions keep theirs.
    """

    VERSION_SCHEMA = "made bigint, seq bigint, folder string, rows bigint, layers array<string>, layer_rows bigint"
    RANGE_SCHEMA = "file string, low string, high string, rows bigint"
    MOST_LAYERS = 16
    LAYER_SHARE = 8  # layers may have one row for so many of the base

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def recreate(self) -> QueryTable:
        """Starts over with an empty table. Readers of the versions before keep their files."""
        self._write(self.spark.createDataFrame([], COUNTS_SCHEMA), -1, 0, "overwrite")
        return self

    def publish(
        self, rows: DataFrame, seq: int, files: int | None = None, counted: Callable[[DataFrame], DataFrame] = lambda ranged: ranged
    ) -> None:
        """Writes a whole version in ranges of phrases, sorted, and switches readers to it.

        A seq below the one in force is refused: it would take newer counts back.
        Sampling for the ranges reads the phrases of `rows` once more, so pass
        a stored table rather than a long computation. `counted` makes the counts of the rows
        once these lie in ranges, where all rows of a phrase are together: nothing moves for it.
        """
        now = self._checked(seq)
        ranged = rows.repartitionByRange(files, "phrase") if files else rows.repartitionByRange("phrase")
        self._write(counted(ranged).sortWithinPartitions("phrase"), seq, now.made + 1, "append")

    def apply(self, changes: DataFrame, seq: int) -> bool:
        """Puts the new totals (phrase, doc_count, total_count) of changed phrases, (0, 0) for gone ones, over the version in force.

        Writes the changes and nothing else. Returns False, without switching readers, if there
        would be more layers than readers should merge: then it is time for a whole version.
        """
        now = self._checked(seq)
        if len(now.layers) >= self.MOST_LAYERS:
            return False
        folder = f"layer-{uuid.uuid4().hex}"
        # Stored as they come first: sampling for the ranges would compute them a second time.
        found = f"{self.root}/changes-{uuid.uuid4().hex}"
        rows = changes.select("phrase", F.lit(seq).cast("bigint").alias("seq"), "doc_count", "total_count")
        with one_write(self.spark):
            rows.write.options(**STORED).parquet(found)
        rows = self.spark.read.schema(EXPORT_SCHEMA).parquet(found)
        more = rows.count()
        fits = (now.layer_rows + more) * self.LAYER_SHARE <= now.rows
        if fits:
            with one_write(self.spark):
                rows.repartitionByRange("phrase").sortWithinPartitions("phrase").write.options(**STORED).parquet(f"{self.root}/{folder}")
        fs, path = file_system(self.spark, found)
        fs.delete(path, True)
        if not fits:
            return False
        self._switch({**now.asDict(), "made": now.made + 1, "seq": seq, "layers": [*now.layers, folder], "layer_rows": now.layer_rows + more})
        return True

    def _checked(self, seq: int) -> Row:
        now = self._newest()
        if seq < now.seq:
            raise ValueError(f"{self.root} stands at {now.seq}, {seq} is older; recreate it to start over")
        return now

    def _write(self, rows: DataFrame, seq: int, made: int, mode: str) -> None:
        folder = f"version-{uuid.uuid4().hex}"
        with one_write(self.spark):
            rows.write.options(**STORED).parquet(f"{self.root}/{folder}")
        # Files are sorted: their first and last rows have their ends.
        written = self._base(folder).select("phrase", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
        sizes = written.groupBy("file").agg(F.count("*").alias("rows"))
        ends = written.join(F.broadcast(sizes), "file").where((F.col("at") == 0) | (F.col("at") == F.col("rows") - 1))
        ends = ends.groupBy("file").agg(F.min("phrase").alias("low"), F.max("phrase").alias("high"), F.first("rows").alias("rows"))
        ends.coalesce(1).write.json(f"{self.root}/{folder}-ranges")
        total = self.ranges(folder).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        self._switch({"made": made, "seq": seq, "folder": folder, "rows": total, "layers": [], "layer_rows": 0}, mode)

    def _switch(self, record: dict, mode: str = "append") -> None:
        append_record(self.spark, f"{self.root}/published", record, self.VERSION_SCHEMA, mode)

    def _newest(self) -> Row:
        log = self.spark.read.schema(self.VERSION_SCHEMA).json(f"{self.root}/published")
        return log.orderBy(F.desc("made")).first()

    def _base(self, folder: str) -> DataFrame:
        return self.spark.read.schema(COUNTS_SCHEMA).parquet(f"{self.root}/{folder}")

    def version(self) -> int:
        """The seq of the version in force."""
        return self._newest().seq

    def ranges(self, folder: str | None = None) -> DataFrame:
        """(file, low, high, rows) of each file of a base, of the one in force if none is named."""
        folder = folder or self._newest().folder
        return self.spark.read.schema(self.RANGE_SCHEMA).json(f"{self.root}/{folder}-ranges")

    def _changed(self, now: Row) -> DataFrame:
        """The newest totals of what the layers have. They hold a small share of the base, see apply()."""
        return newest_exports(self._layers(now))

    def _layers(self, now: Row) -> DataFrame:
        return self.spark.read.schema(EXPORT_SCHEMA).parquet(*(f"{self.root}/{f}" for f in now.layers))

    @staticmethod
    def _over(base: DataFrame, changed: DataFrame) -> DataFrame:
        """The base with changed totals in place of its own. The base is streamed past the changes, or they come to it."""
        return base.join(changed.select("phrase"), "phrase", "left_anti").unionByName(published_rows(changed))

    def scan(self) -> DataFrame:
        """(phrase, doc_count, total_count) of the version in force.

        Filters on `phrase` reach the files, whose row groups hold narrow ranges.
        """
        now = self._newest()
        base = self._base(now.folder)
        if now.layer_rows * type(self).LAYER_SHARE > now.rows:  # too many to be sent to the base: each row moves once
            rows = base.withColumn("seq", F.lit(-1).cast("bigint")).unionByName(self._layers(now))
            return published_rows(newest_exports(rows.repartition("phrase")))
        return self._over(base, self._changed(now)) if now.layers else base

    def scan_ordered(self, prefix: str = "", after: str | None = None) -> DataFrame:
        """scan() of the phrases that begin with a prefix and come after one, in their order.

        The files are read in the order of their ranges, and only those whose range may have such
        phrases; nothing is shuffled. Rows of layers are sorted into the file they belong to.
        """
        now = self._newest()
        wanted = F.col("phrase").startswith(prefix) if prefix else F.lit(True)
        wanted = wanted & (F.col("phrase") > after) if after is not None else wanted
        files = self.ranges(now.folder).orderBy("low").collect()  # one row per file
        # A phrase belongs to the last file that begins at or before it; to the first, if none does.
        parts, ends = [], [f.low for f in files[1:]] + [None]
        for k, (f, end) in enumerate(zip(files, ends, strict=True)):
            if after is not None and end is not None and end.encode() <= after.encode():
                continue
            if prefix and (end is not None and end.encode() < prefix.encode() or k and f.low.encode() > prefix.encode() and not f.low.startswith(prefix)):
                continue
            part = self.spark.read.schema(COUNTS_SCHEMA).parquet(f.file).where(wanted)
            if now.layers:
                own = F.lit(True) if k == 0 else F.col("phrase") >= f.low
                own = own & (F.col("phrase") < end) if end is not None else own
                changed = self._changed(now).where(own & wanted)
                part = self._over(part, changed).coalesce(1).sortWithinPartitions("phrase")
            parts.append(part)
        if not parts:
            rest = self._changed(now).where(wanted) if now.layers and not files else None
            return published_rows(rest).orderBy("phrase") if rest else self.spark.createDataFrame([], COUNTS_SCHEMA)
        return reduce(DataFrame.union, parts)

    def lookup(self, requests: DataFrame) -> DataFrame:
        """Counts of the requested phrases, (0, 0) where there are none."""
        return lookup(requests, self.scan())


class ExportSink:
    """Takes sequenced exports in any order, any number of times.

    Each delivery overwrites the folder of its id, so a repeated one changes
    nothing; the highest sequence of a phrase wins, deletes included. fold() puts
    what has come so far into one base, which keeps the deletes.

    A new sink that is given a number of buckets keeps deliveries and bases in these, by phrase: exports that lie
    in as many, as those of a ledger lie in its own, are not moved, neither when they come nor when they are read.
    The deliveries since a fold lie below one folder, and are read as one table.
    """

    FOLD_SCHEMA = "made bigint, folder string, deliveries array<bigint>"
    LAYOUT_SCHEMA = "buckets bigint"

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        if buckets and not self._has("layout") and not self._has("deliveries"):
            append_record(spark, f"{self.root}/layout", {"buckets": buckets}, self.LAYOUT_SCHEMA)

    def _buckets(self) -> int | None:
        """As stored with the sink, whoever opens it."""
        if not self._has("layout"):
            return None
        return self.spark.read.schema(self.LAYOUT_SCHEMA).json(f"{self.root}/layout").first().buckets

    @staticmethod
    def _since(base: Row | None) -> str:
        """Where the deliveries after a fold lie in buckets."""
        return f"deliveries/fold={base.made if base else 0}"

    def _table(self, folder: str) -> str:
        return f"gramledger_{hashlib.sha256(f'{self.root}/{folder}'.encode()).hexdigest()[:24]}"

    def _write(self, rows: DataFrame, folder: str) -> None:
        buckets, path = self._buckets(), f"{self.root}/{folder}"
        with one_write(self.spark):
            if not buckets:
                rows.sortWithinPartitions("phrase").write.mode("overwrite").options(**STORED).parquet(path)
                return
            rows = rows.repartition(buckets, "phrase")  # nothing, if that is where they lie
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(folder)}")
            writer = rows.write.mode("overwrite").format("parquet").bucketBy(buckets, "phrase").sortBy("phrase").options(**STORED)
            writer.option("path", path).saveAsTable(self._table(folder))
            self.spark.sql(f"DROP TABLE {self._table(folder)}")  # its files stay

    def _in_buckets(self, folder: str) -> DataFrame:
        """All files below a folder as one table that says how it is bucketed. A union of such tables would not do:
        Spark 4.1 takes it to lie in their buckets, and does not put them together."""
        table, place = self._table(folder), f"{self.root}/{folder}".replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files may be others by now
        self.spark.sql(f"CREATE TABLE {table} ({EXPORT_SCHEMA}) USING parquet OPTIONS (recursiveFileLookup 'true') "
                       f"CLUSTERED BY (phrase) SORTED BY (phrase) INTO {self._buckets()} BUCKETS LOCATION '{place}'")
        return self.spark.table(table)

    def apply(self, exports: DataFrame, delivery: int) -> None:
        place = self._since(self._folds()) if self._buckets() else "deliveries"
        self._write(exports.select("phrase", "seq", "doc_count", "total_count"), f"{place}/delivery={delivery}")

    def _has(self, name: str) -> bool:
        fs, path = file_system(self.spark, f"{self.root}/{name}")
        return fs.exists(path)

    def _folds(self) -> Row | None:
        if not self._has("folds"):
            return None
        log = self.spark.read.schema(self.FOLD_SCHEMA).json(f"{self.root}/folds")
        return log.orderBy(F.desc("made")).first()

    def _deliveries(self) -> DataFrame:
        schema = EXPORT_SCHEMA + ", delivery bigint"
        if not self._has("deliveries"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/deliveries")

    def newest(self) -> DataFrame:
        """The newest export of every phrase: the base and what came after it."""
        base = self._folds()
        if self._buckets():
            return self._newest_in_buckets(base)
        rows = self._deliveries()
        columns = ["phrase", "seq", "doc_count", "total_count"]
        if base:
            # Folders of folded deliveries are left out by their partition.
            rows = rows.where(~F.col("delivery").isin(base.deliveries)).select(columns)
            rows = rows.unionByName(self.spark.read.schema(EXPORT_SCHEMA).parquet(f"{self.root}/{base.folder}"))
        return newest_exports(rows.select(columns))

    def _newest_in_buckets(self, base: Row | None) -> DataFrame:
        since = self._since(base)
        new = newest_exports(self._in_buckets(since)) if self._has(since) else None
        if new is None or base is None:
            return new or (self._in_buckets(base.folder) if base else self.spark.createDataFrame([], EXPORT_SCHEMA))
        new = new.select("phrase", F.struct("seq", "doc_count", "total_count").alias("new"))
        old = self._in_buckets(base.folder).select("phrase", F.struct("seq", "doc_count", "total_count").alias("old"))
        return old.join(new, "phrase", "full").select("phrase", F.greatest("old", "new").alias("last")).select("phrase", "last.*")

    def fold(self) -> None:
        """Folds all deliveries so far into a new base. A delivery repeated later changes nothing by its sequence.

        Folders that the fold before took in are deleted: who reads since then does without them.
        """
        base = self._folds()
        folder = f"base-{uuid.uuid4().hex}"
        if self._buckets():
            still, gone = [], [f"deliveries/fold={base.made - 1}"] if base else []
        else:
            folded = base.deliveries if base else []
            done = [r.delivery for r in self._deliveries().select("delivery").distinct().collect()]
            still, gone = sorted(set(done) - set(folded)), [f"deliveries/delivery={name}" for name in folded]
        self._write(self.newest(), folder)
        row = self.spark.createDataFrame([((base.made if base else 0) + 1, folder, still)], self.FOLD_SCHEMA)
        row.coalesce(1).write.mode("append").json(f"{self.root}/folds")
        for name in gone:
            fs, path = file_system(self.spark, f"{self.root}/{name}")
            fs.delete(path, True)

    def scan(self) -> DataFrame:
        return published_rows(self.newest())
