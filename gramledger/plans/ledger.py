"""The ledger: incremental state kept as Parquet tables.

    <root>/commits                 one JSON row per committed batch or compaction
    <root>/write_log/batch_id=N    uri, seq, hash, writes: last write of each URI in batch N
    <root>/uri_log/batch_id=N      uri, seq, old_hash, hash: those that are news
    <root>/doc_log/batch_id=N      hash, delta, multiplier, ...
    <root>/text_log/batch_id=N     hash, content of documents batch N brought to life
    <root>/phrase_log/batch_id=N   phrase, d_doc, d_total: summed by task, so that phrases are shuffled
                                   when they are read or compacted, and not here as well
    <root>/value_log/batch_id=N    phrase, seq, doc_count, total_count: for streams of them
    <root>/uri_base/version=V...   state after batch V, bucketed and sorted by its key
    <root>/doc_base/version=V...
    <root>/phrase_base/version=V...
    <root>/text_base/version=V...  texts of the documents alive after batch V

A batch writes whole folders of its own and is visible once its commit row is
there; a batch that failed half-way is written over by its retry. Reads add the
logs after the newest base to that base. One writer at a time.
"""

from __future__ import annotations

import hashlib
from dataclasses import asdict, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramledger.config import TOKENIZER_VERSION, LedgerOptions
from gramledger.operators import counts as C
from gramledger.operators.documents import latest_by_uri, with_normalized, with_text
from gramledger.plans import delta as D
from gramledger.plans.commits import COUNTERS, NOTHING, CommitLog, Position
from gramledger.session import STORED, file_system, one_write, tune_for_phrases
from gramledger.sinks.query_table import EXPORT_SCHEMA, QueryTable
from gramledger.sources.change_feed import change_feed, complete

LOGS = {
    "write": "uri string, seq bigint, hash string, writes bigint",
    "uri": "uri string, seq bigint, old_hash string, hash string",
    "doc": "hash string, delta bigint, multiplier int, first struct<seq: bigint, uri: string>, "
    "text_batch bigint",
    "text": "hash string, content string",
    "phrase": "phrase string, d_doc bigint, d_total bigint",
    "value": EXPORT_SCHEMA,
}
# Logs in which single keys are looked up: their row groups have a Bloom filter on it.
SOUGHT = {"phrase": "phrase", "text": "hash"}
BASES = {
    "uri": ("uri", "uri string, seq bigint, hash string"),
    "doc": ("hash", "hash string, ref_count bigint, indexed int, text_batch bigint"),
    "phrase": ("phrase", "phrase string, d_doc bigint, d_total bigint"),
    "text": ("hash", "hash string, content string, batch_id bigint"),
}
STATE = ("uri", "doc", "phrase")
# So many keys are sought as literals: they choose the buckets, files and row groups to open.
FEW_KEYS = 1000
# A batch with fewer rows than one in so many of the logs before it is looked up in them, before they move.
FEW_CHANGES = 8
# Phrases in a bucket or file. A task sorts them in some 100 to 200 bytes each, and with them those
# of the logs behind a base.
BUCKET_ROWS = 250_000
FILE_ROWS = 2_000_000
LEAST_FILE_ROWS = 10_000
# Characters of texts whose phrases a load sums together: some 160,000 phrases. By chance a task gets up to seven such parts.
PART_CHARS = 1 << 20
GONE_IN_PART = 1000  # documents that go are dealt so, if the batch brings none to tell their size by


class Ledger:
    def __init__(self, spark: SparkSession, root: str, options: LedgerOptions):
        self.spark = tune_for_phrases(spark)
        self.root = root.rstrip("/")
        self.options = options
        self._commits = CommitLog(self.spark, self.root)

    # -- life cycle ---------------------------------------------------------

    @classmethod
    def create(cls, spark: SparkSession, root: str, options: LedgerOptions | None = None) -> Ledger:
        """A new, empty ledger; one that was there before is no longer visible.

        Without options it has as many buckets as the session has shuffle partitions.
        """
        ledger = cls(spark, root, options or LedgerOptions(buckets=int(spark.conf.get("spark.sql.shuffle.partitions"))))
        ledger._commits.add({**ledger._record(), "made": 0}, "overwrite")
        return ledger

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> Ledger:
        row = CommitLog(spark, root).newest()
        fields = LedgerOptions.__dataclass_fields__
        ledger = cls(spark, root, LedgerOptions(**{k: row[k] for k in fields}))
        if ledger.options.tokenizer_version != TOKENIZER_VERSION:
            # Retraction cuts the stored text again and must get the same phrases.
            raise ValueError(
                f"{root} was written with tokenizer version {ledger.options.tokenizer_version}, "
                f"this is version {TOKENIZER_VERSION}: load the documents into a new ledger"
            )
        return ledger

    def within(self, spark: SparkSession) -> Ledger:
        """The same ledger seen from another session."""
        return Ledger(spark, self.root, self.options)

    def commits(self) -> DataFrame:
        """Rows of the commit log since it was last folded, and what the fold kept."""
        return self._commits.rows()

    def _record(self) -> dict:
        """A row that commits nothing."""
        places = dict.fromkeys(("batch_id", "base", "text_base", "floor", "values_to", "pending"), NOTHING)
        return {**places, "made": 0, **dict.fromkeys(COUNTERS, 0), **asdict(self.options)}

    def _commit(self, at: Position, **what) -> None:
        """The row after those `at` knows of, with its counters unless `what` has others."""
        kept = {"made": at.made + 1, "floor": at.floor, "values_to": at.values_to, **dict(zip(COUNTERS, at.counters, strict=True))}
        self._commits.add({**self._record(), **kept, **what})

    def _position(self, until: int | None = None) -> Position:
        return self._commits.position(until)

    def position(self) -> Position:
        """Where the ledger stands."""
        return self._position()

    # -- stored tables ------------------------------------------------------

    def _write_log(self, name: str, batch_id: int, rows: DataFrame) -> DataFrame:
        writer = rows.write.mode("overwrite").options(**STORED)
        if name in SOUGHT:
            writer = writer.option(f"parquet.bloom.filter.enabled#{SOUGHT[name]}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        with one_write(self.spark):
            writer.parquet(f"{self.root}/{name}_log/batch_id={batch_id}")
        return self._log(name, batch_id - 1, batch_id)

    def _log(self, name: str, after: int, last: int) -> DataFrame:
        """Log rows of the batches in (after, last], with their batch_id."""
        schema = LOGS[name] + ", batch_id bigint"
        if last <= after:
            return self.spark.createDataFrame([], schema)
        folder = f"{self.root}/{name}_log"
        paths = [f"{folder}/batch_id={b}" for b in range(after + 1, last + 1)]
        return self.spark.read.schema(schema).option("basePath", folder).parquet(*paths)

    def _base_folder(self, name: str, version: int, buckets: int, made: int) -> str:
        """A folder for every compaction, so that readers of an earlier one at the same batch keep theirs."""
        return f"{self.root}/{name}_base/version={version}_buckets={buckets}_made={made}"

    def _base_name(self, folder: str) -> str:
        return f"gramledger_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"

    def _base(self, name: str, at: Position) -> DataFrame:
        """A compacted table, read with its bucketing so that joins on the key
        leave it where it is and a look-up of one key reads one bucket."""
        key, schema = BASES[name]
        version, buckets, made = (at.text_base, at.text_buckets, at.text_made) if name == "text" else (at.base, at.buckets, at.base_made)
        if version == NOTHING:
            return self.spark.createDataFrame([], schema)
        folder = self._base_folder(name, version, buckets, made)
        fs, path = file_system(self.spark, folder)
        if not fs.exists(path):  # a table over a missing folder would read as an empty one
            raise FileNotFoundError(f"{folder} is gone: vacuumed, or written by an earlier format")
        table, place = self._base_name(folder), folder.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        return self.spark.table(table)

    def _write_base(self, name: str, version: int, buckets: int, made: int, rows: DataFrame) -> None:
        key, schema = BASES[name]
        folder = self._base_folder(name, version, buckets, made)
        table = self._base_name(folder)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        writer = (
            rows.select(*self.spark.createDataFrame([], schema).columns).write.mode("overwrite")
            .format("parquet")
            .bucketBy(buckets, key)
            .sortBy(key)
            .option("path", folder)
            .options(**STORED)
        )
        if name in SOUGHT:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        with one_write(self.spark):
            writer.saveAsTable(table)

    # -- state --------------------------------------------------------------
    # Each state is the base joined with the summary of the logs behind it. With
    # `keys`, both are first reduced to the keys of a batch. Whatever the session's
    # number of shuffle partitions, logs and keys come to the buckets of the base
    # and not the base to them. A log has one row per key and batch, that of phrases one per
    # phrase, batch and part of its texts, so sending its rows without summing them first
    # overloads no bucket. Where there is no base yet, the logs go to as many tasks as their
    # size asks for, or to the buckets of the base to be.

    def _parts(self, name: str, at: Position, keys: DataFrame | None, buckets: int | None = None):
        key, _ = BASES[name]
        parts = self._base(name, at), self._log(name, at.base, at.last)
        buckets = buckets if at.base == NOTHING else at.buckets

        def dealt(rows: DataFrame) -> DataFrame:
            return rows.repartition(buckets, key) if buckets else rows

        if keys is not None:
            keys = dealt(keys.select(key))
            parts = tuple(D.state_of(keys, part, key) for part in parts)
        return parts[0], dealt(parts[1])

    def uri_state(self, keys: DataFrame | None = None, at: Position | None = None, buckets: int | None = None) -> DataFrame:
        """(uri, seq, hash) of every URI seen. buckets: where its rows shall lie if there is no base yet."""
        base, log = self._parts("uri", at or self._position(), keys, buckets)
        newest = log.groupBy("uri").agg(F.max(F.struct("batch_id", "seq", "hash")).alias("new"))
        return base.join(newest, "uri", "full").select(
            "uri", F.coalesce("new.seq", "seq").alias("seq"), F.coalesce("new.hash", "hash").alias("hash")
        )

    def doc_state(self, keys: DataFrame | None = None, at: Position | None = None, buckets: int | None = None) -> DataFrame:
        """(hash, ref_count, indexed, text_batch) of every live document."""
        base, log = self._parts("doc", at or self._position(), keys, buckets)
        born = F.when(F.col("multiplier") == 1, F.col("batch_id"))
        moved = log.groupBy("hash").agg(
            F.sum("delta").alias("delta"),
            F.sum("multiplier").alias("steps"),
            F.max(born).alias("born"),
        )
        zero = F.lit(0)
        return (
            base.join(moved, "hash", "full")
            .select(
                "hash",
                (F.coalesce("ref_count", zero) + F.coalesce("delta", zero)).alias("ref_count"),
                (F.coalesce("indexed", zero) + F.coalesce("steps", zero)).cast("int").alias("indexed"),
                F.coalesce("born", "text_batch").alias("text_batch"),
            )
            .where(F.col("ref_count") > 0)
        )

    def phrase_state(self, keys: DataFrame | None = None, at: Position | None = None, buckets: int | None = None) -> DataFrame:
        """(phrase, d_doc, d_total): all updates so far, summed."""
        base, log = self._parts("phrase", at or self._position(), keys, buckets)
        new = log.groupBy("phrase").agg(F.sum("d_doc").alias("a"), F.sum("d_total").alias("b"))
        zero = F.lit(0)
        return (
            base.join(new, "phrase", "full")
            .select(
                "phrase",
                (F.coalesce("d_doc", zero) + F.coalesce("a", zero)).alias("d_doc"),
                (F.coalesce("d_total", zero) + F.coalesce("b", zero)).alias("d_total"),
            )
            .where(C.nonzero("d_doc", "d_total"))
        )

    # -- loading ------------------------------------------------------------

    def load(self, changes: DataFrame, source: str | None = None, source_batch: int | None = None) -> int:
        """Applies one batch of changes and returns its id.

        A batch that names its source and number there is applied once: a repeat
        returns without doing anything.
        """
        if source is not None:
            done = self._commits.applied(source, source_batch)
            if done is not None:
                return done
        at = self._position()
        batch = at.last + 1
        feed = complete(change_feed(changes))

        # Keys and hashes only: the text of unchanged documents goes nowhere. Each
        # step is written once and read back by all that need it, with its size
        # known to the planner.
        writes = self._write_log("write", batch, latest_by_uri(feed, "writes"))
        latest = writes.drop("batch_id", "writes")
        known = self.uri_state(latest, at)
        news = self._write_log("uri", batch, D.newer_writes(latest, known))
        changed = news.where(~F.col("old_hash").eqNullSafe(F.col("hash")))

        deltas = D.ref_deltas(changed.withColumnRenamed("hash", "new_hash"))
        moved = D.transitions(deltas, self.doc_state(deltas, at))
        moved = self._write_log(
            "doc", batch, moved.select("hash", "delta", "multiplier", "first", "text_batch")
        )

        # From here on the batch's documents are known and their phrases are not: a reader
        # of the counters sees that, and how far a load that stopped has come.
        counted = self._counted(writes, news, moved)
        uris, docs, processed = at.counters
        stats = {
            "uris": uris + counted.new_uris, "unique_docs": docs + counted.born - counted.gone,
            "rows_read": counted.rows_read, "born": counted.born, "gone": counted.gone,
        }
        self._commit(at, pending=batch, processed_docs=processed, **stats)
        at = replace(at, made=at.made + 1)

        # The keys of the documents to store are known: they cut the feed's texts down
        # in the scan, before anything is shuffled.
        wanted = D.first_writes(moved)
        born = self._write_log("text", batch, with_text(wanted, feed).select("hash", "content"))
        lost = wanted.join(born.where(F.col("content").isNotNull()), "hash", "left_anti").first()
        if lost:
            raise ValueError(f"the source changed while it was read: the text of {lost.uri} at {lost.seq} is gone")

        signed = self._signed_texts(born, moved, batch, at, self._text_parts(born, counted))
        deltas = C.signed_counts(signed, "multiplier", self.options.phrase_length, "part")
        self._write_log("phrase", batch, deltas.where(C.nonzero("d_doc", "d_total")).sortWithinPartitions("phrase"))

        self._commit(at, batch_id=batch, source=source, source_batch=source_batch,
                     processed_docs=processed + counted.born - counted.gone, **stats)
        return batch

    def _text_parts(self, born: DataFrame, counted) -> int:
        """In how many parts a batch's phrases are summed: by the characters it brings, and as many a document that goes."""
        chars = born.agg(F.sum(F.length("content"))).first()[0] or 0
        most = chars * (1 + counted.gone / counted.born) if counted.born else counted.gone * PART_CHARS / GONE_IN_PART
        return int(most / PART_CHARS) + 1

    def _counted(self, writes: DataFrame, news: DataFrame, moved: DataFrame):
        """What a batch brings to the counters, from its stored logs: nothing else is read."""
        rows = writes.select(F.col("writes").alias("rows_read"))
        rows = rows.unionByName(news.select(F.col("old_hash").isNull().cast("bigint").alias("new_uris")), allowMissingColumns=True)
        rows = rows.unionByName(moved.select(
            (F.col("multiplier") == 1).cast("bigint").alias("born"), (F.col("multiplier") == -1).cast("bigint").alias("gone")
        ), allowMissingColumns=True)
        return rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in rows.columns)).first()

    # Texts of the batches up to the text base lie there by hash, one for each document
    # that was alive; later ones lie in the logs, by batch.

    def _base_texts(self, keys: DataFrame, at: Position) -> DataFrame:
        """`content` added to the keys (hash, text_batch, ...) whose texts the base has. Few keys open
        only their buckets, and row groups whose Bloom filter has them; more of them come to the base, not it to them."""
        base = self._base("text", at).select("hash", "content")
        keys = keys.where(F.col("text_batch") <= at.text_base)
        few = [r.hash for r in keys.select("hash").limit(FEW_KEYS + 1).collect()]
        if len(few) <= FEW_KEYS:
            return base.where(F.col("hash").isin(few)).join(keys, "hash")
        return base.join(keys.repartition(at.text_buckets, "hash"), "hash")

    def _log_texts(self, keys: DataFrame, at: Position) -> DataFrame:
        """The same for texts in the logs. Batch folders that have none of the keys are not opened."""
        log = self._log("text", at.text_base, at.last).withColumnRenamed("batch_id", "text_batch")
        return log.join(keys.where(F.col("text_batch") > at.text_base), ["text_batch", "hash"])

    def _signed_texts(self, born: DataFrame, moved: DataFrame, batch: int, at: Position, parts: int | None = None) -> DataFrame:
        """(hash, multiplier, text) of the documents that come to life or go, lying by hash; in so many parts, by `part`."""
        added = born.select("hash", "content", F.lit(1).alias("multiplier"))
        if batch > 0:
            gone = moved.where(F.col("multiplier") == -1).select("hash", "multiplier", "text_batch")
            at = replace(at, last=batch - 1)
            added = added.unionByName(self._log_texts(gone, at).select(added.columns))
            if at.text_base != NOTHING:
                added = added.unionByName(self._base_texts(gone, at).select(added.columns))
        if parts:
            added = added.withColumn("part", F.pmod(F.xxhash64("hash"), F.lit(parts))).repartition(parts, "part")
        else:
            added = added.repartition("hash")
        return with_normalized(added)

    def signed_documents(self, batch_id: int) -> DataFrame:
        """(hash, multiplier, text) of the documents that came to life (1) or went (-1) in a batch.

        For batches behind the last compact_texts, which leaves the texts of dead documents behind.
        """
        at = self._position()
        if not at.text_base < batch_id <= at.last:
            raise ValueError(f"the texts of batch {batch_id} are not kept, only those of {at.text_base + 1} to {at.last}")
        born, moved = self._log("text", batch_id - 1, batch_id), self._log("doc", batch_id - 1, batch_id)
        return self._signed_texts(born, moved, batch_id, at)

    def _live_texts(self, at: Position) -> DataFrame:
        """(hash, content, ref_count, batch_id) of every live document. The base is neither moved nor sorted:
        documents and texts of the logs come to its buckets."""
        live = self.doc_state(at=at).select("hash", "text_batch", "ref_count")
        new = self._log_texts(live, at).select("hash", "content", "ref_count", F.col("text_batch").alias("batch_id"))
        if at.text_base == NOTHING:
            return new
        old = live.where(F.col("text_batch") <= at.text_base).repartition(at.text_buckets, "hash")
        kept = self._base("text", at).select("hash", "content", "batch_id").join(old.select("hash", "ref_count"), "hash")
        new = new.repartition(at.text_buckets, "hash").select("hash", *(F.col(c).alias(f"new_{c}") for c in new.columns if c != "hash"))
        both = kept.join(new, "hash", "full")
        return both.select("hash", *(F.coalesce(f"new_{c}", c).alias(c) for c in ("content", "ref_count", "batch_id")))

    # -- compaction and publication -----------------------------------------

    def compact(self, buckets: int | None = None) -> int:
        """Folds the logs into new base tables and returns the batch they stand at.

        The old base is read and written in its buckets; only the logs move. Another
        number of buckets deals the base out anew and holds from then on. Without a number
        there are as many as before, or so many more that a bucket stays of a size for one task.
        """
        at = self._position()
        buckets = buckets or self._buckets(at)
        if at.last == at.base and buckets == at.buckets:
            return at.base
        self.options = replace(self.options, buckets=buckets)
        for name in STATE:
            state = getattr(self, f"{name}_state")(at=at, buckets=buckets)
            lies = at.base == NOTHING or buckets == at.buckets
            self._write_base(name, at.last, buckets, at.made + 1, state if lies else state.repartition(buckets, BASES[name][0]))
        self._commit(at, base=at.last)
        self._commits.fold()
        return at.last

    def _buckets(self, at: Position) -> int:
        """The buckets there are, unless a base of the state now would have some too large for a task: then all are dealt anew.

        Counted by the files' footers.
        """
        rows = self._base("phrase", at).count() + self._log("phrase", at.base, at.last).count()
        needed = -(-rows // BUCKET_ROWS)
        return needed if needed > (at.buckets if at.base == NOTHING else 2 * at.buckets) else at.buckets

    def buckets(self) -> int:
        """How many buckets a table of all phrases should have now."""
        return self._buckets(self._position())

    def compact_texts(self) -> int:
        """Folds the texts of live documents into one table and leaves those of dead ones behind.

        Reads and writes all live texts where they lie; only those of the logs move.
        """
        at = self._position()
        if at.last != at.text_base:
            texts = self._live_texts(at)
            if at.text_base == NOTHING or at.text_buckets != self.options.buckets:
                texts = texts.repartition(self.options.buckets, "hash")
            self._write_base("text", at.last, self.options.buckets, at.made + 1, texts)
            self._commit(at, text_base=at.last)
        return at.last

    def vacuum(self, keep_batches: int = 0) -> list[str]:
        """Deletes logs and bases that reads of the last `keep_batches` batches and later ones do not open.

        Returns the folders. Readers that began before the last compaction must be done.
        changed_values of earlier batches and texts of dead documents are gone afterwards,
        and asking for them raises.
        """
        at = self._position()
        old = self._position(max(at.floor, at.last - keep_batches))
        # A kept batch is read from the newest base that is not past it: any from the oldest one needed on.
        keep = {self._base_folder("x", *b).rsplit("/", 1)[1] for b in self._commits.bases(old.base)}
        texts = {self._base_folder("x", at.text_base, at.text_buckets, at.text_made).rsplit("/", 1)[1]}
        if old.base > at.floor:
            self._commit(at, floor=old.base)  # first, so that nobody looks for what is being deleted
        gone = []
        for name in LOGS:
            until = min(at.text_base, old.last) if name == "text" else old.base
            gone += self._folders(f"{self.root}/{name}_log", lambda f, until=until: int(f.split("=")[1]) <= until)
        for name in BASES:
            used = texts if name == "text" else keep
            gone += self._folders(f"{self.root}/{name}_base", lambda f, used=used: f not in used)
        for folder in gone:
            fs, path = file_system(self.spark, folder)
            fs.delete(path, True)
            self.spark.sql(f"DROP TABLE IF EXISTS {self._base_name(folder)}")
        return gone

    def _folders(self, parent: str, wanted) -> list[str]:
        """Folders below parent whose names are wanted; there is one per batch or compaction since the last vacuum."""
        fs, path = file_system(self.spark, parent)
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return [f"{parent}/{n}" for n in names if "=" in n and wanted(n)]

    def publish(self, table: QueryTable, files: int | None = None) -> int:
        """Brings a query table to the newest batch and returns that.

        A table that stands at an earlier batch of which the logs are kept gets the new totals of
        the phrases changed since, and nothing else is written. Others, and those with many
        changes over them, get a whole version: base and logs move once, to their ranges, and are summed there.
        """
        at, since = self._position(), table.version()
        if NOTHING < since <= at.last and since >= at.floor and not files:
            if since == at.last or table.apply(self._changed_since(since, at), at.last):
                return at.last
        base, log = self._base("phrase", at), self._log("phrase", at.base, at.last)
        rows = base.unionByName(log.select(base.columns))
        table.publish(rows, at.last, files or self._files(base.count() + log.count()), lambda ranged: C.as_counts(C.combine(ranged)))
        return at.last

    def _files(self, rows: int) -> int:
        """Files of a published table: for every task of the session one, if there is enough for that, and none too large."""
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return max(1, min(max(tasks, -(-rows // FILE_ROWS)), -(-rows // LEAST_FILE_ROWS)))

    def _changed_since(self, batch_id: int, at: Position) -> DataFrame:
        """(phrase, seq, doc_count, total_count): totals now of the phrases that batches after one changed.

        The logs of these batches move once, to the buckets of the base, and need not be looked up
        in it first: their sums are joined with it as it lies. Logs between the base and these batches move
        with them; where they have far more rows than these, they are cut down to their phrases before.
        """
        deltas, base = self._log("phrase", batch_id, at.last), self._base("phrase", at)
        rows = deltas
        if batch_id > at.base:
            before = self._log("phrase", at.base, batch_id)
            rows = rows.unionByName(D.state_of(deltas, before, "phrase") if deltas.count() * FEW_CHANGES < before.count() else before)
        if at.base != NOTHING:
            rows = rows.repartition(at.buckets, "phrase")

        def summed(column: str, after: int) -> Column:
            return F.sum(F.when(F.col("batch_id") > after, F.col(column)).otherwise(F.lit(0)))

        sums = rows.groupBy("phrase").agg(
            summed("d_doc", batch_id).alias("d_doc"), summed("d_total", batch_id).alias("d_total"),
            # The base has what batches up to its own changed.
            summed("d_doc", at.base).alias("new_doc"), summed("d_total", at.base).alias("new_total"),
        )
        return D.export_rows(sums, base.select("phrase", F.col("d_doc").alias("base_doc"), F.col("d_total").alias("base_total")), at.last)

    # -- queries ------------------------------------------------------------

    def phrase_counts(self) -> DataFrame:
        """(phrase, doc_count, total_count) of every phrase held."""
        return C.as_counts(self.phrase_state())

    def lookup(self, requests: DataFrame) -> DataFrame:
        """Counts of the requested phrases, (0, 0) where there are none."""
        wanted = requests.select("phrase").distinct()
        return C.with_default(wanted, C.as_counts(self.phrase_state(wanted)))

    def lookup_one(self, phrase: str) -> tuple[int, int]:
        """(doc_count, total_count) of one phrase.

        The filter reaches the scans: one bucket of the base, and in it and in
        the logs only row groups around the phrase.
        """
        at = self._position()
        here = F.col("phrase") == phrase
        rows = C.combine(
            self._base("phrase", at).where(here), self._log("phrase", at.base, at.last).where(here)
        ).first()
        return (rows["d_doc"], rows["d_total"]) if rows else (0, 0)

    def documents(self) -> DataFrame:
        """(hash, content, ref_count) of every live document."""
        return self._live_texts(self._position()).select("hash", "content", "ref_count")

    def batch_deltas(self, batch_id: int) -> DataFrame:
        """(phrase, d_doc, d_total, batch_id): what a batch added and took back."""
        return self._summed(self._log("phrase", batch_id - 1, batch_id))

    def _summed(self, log: DataFrame) -> DataFrame:
        """The log of phrases with one row for each phrase and batch, of those that changed."""
        sums = log.groupBy("phrase", "batch_id").agg(F.sum("d_doc").alias("d_doc"), F.sum("d_total").alias("d_total"))
        return sums.where(C.nonzero("d_doc", "d_total")).select("phrase", "d_doc", "d_total", "batch_id")

    def changed_values(self, batch_id: int) -> DataFrame:
        """(phrase, seq, doc_count, total_count): totals after a batch of the phrases it changed.

        For any batch whose log is kept, compacted or not.
        """
        at = self._position(batch_id)
        if not 0 <= batch_id <= at.last:
            raise ValueError(f"there is no batch {batch_id}, the last one is {at.last}")
        if batch_id <= at.floor:
            raise ValueError(f"what batch {batch_id} changed was given up by vacuum")
        return self._changed_since(batch_id - 1, at)

    def store_values(self, batch_id: int) -> None:
        """Writes changed_values of a batch where streams of them read (sources.changes). Batches come in their order;
        one that is there already changes nothing."""
        at = self._position()
        if batch_id <= at.values_to:
            return
        if batch_id != at.values_to + 1 and at.values_to != NOTHING:
            raise ValueError(f"values are stored up to batch {at.values_to}, {batch_id} is not the next one")
        self._write_log("value", batch_id, self.changed_values(batch_id).sortWithinPartitions("phrase"))
        self._commit(at, values_to=batch_id)

    def corpus_stats(self) -> DataFrame:
        """One row (uris, unique_docs, processed_docs), from the newest commit row: no state is read.

        While a batch is being applied, or after that stopped half-way, its URIs and documents
        are counted already and its processed documents are not.
        """
        newest = self.commits().orderBy(F.desc("made")).limit(1)
        return newest.select(*COUNTERS)

    def counted_stats(self) -> DataFrame:
        """The same three numbers counted from the state tables, up to the newest batch."""
        at = self._position()
        one, none = F.lit(1), F.lit(0)
        uris = self.uri_state(at=at).select(
            one.alias("uris"), none.alias("unique_docs"), none.alias("processed_docs")
        )
        docs = self.doc_state(at=at).select(
            none.alias("uris"), one.alias("unique_docs"), F.col("indexed").alias("processed_docs")
        )
        rows = uris.unionByName(docs)
        return rows.agg(*(F.coalesce(F.sum(c), none).cast("bigint").alias(c) for c in rows.columns))

    def progress(self) -> DataFrame:
        """(batch_id, done, rows_read, born, gone, phrases, backlog) of the batches since the commit log was folded.

        rows_read: writes in the source; born, gone: documents; phrases: those it changed, counted
        in its log when they are asked for; backlog: documents whose phrases were not yet counted.
        phrases is null while it lasts, and once vacuum has given up the log.
        """
        rows = self.commits().withColumn("batch", F.greatest("batch_id", "pending")).where(F.col("batch") >= 0)
        newest = F.max_by(F.struct("*"), "made").alias("r")
        last = rows.groupBy("batch").agg(newest).select("r.*")
        at = self._position()
        counted = self._summed(self._log("phrase", at.floor, at.last)).groupBy(F.col("batch_id").alias("batch")).agg(F.count("*").alias("counted"))
        kept = (F.col("pending") < 0) & (F.col("batch") > at.floor)
        return last.join(counted, "batch", "left").select(
            F.col("batch").alias("batch_id"), (F.col("pending") < 0).alias("done"), "rows_read", "born", "gone",
            F.when(kept, F.coalesce("counted", F.lit(0).cast("bigint"))).otherwise(F.col("phrases")).alias("phrases"),
            (F.col("unique_docs") - F.col("processed_docs")).alias("backlog"),
        )

    def create_views(self, prefix: str = "") -> None:
        """Temporary views for SQL: phrases, uris and documents."""
        self.phrase_counts().createOrReplaceTempView(f"{prefix}phrases")
        self.uri_state().createOrReplaceTempView(f"{prefix}uris")
        self.documents().createOrReplaceTempView(f"{prefix}documents")
