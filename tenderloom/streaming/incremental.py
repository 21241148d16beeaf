"""Incremental ingest with Structured Streaming: new files only, keyed keep-last merge, late files, ledger."""

from __future__ import annotations

import datetime
import json
import time
import uuid
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..shipping import shared_root

C = F.col


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def month_of(name: Column) -> Column:
    """yyyy-MM from ``2024_03.json`` or ``cig_json_2024_03.zip``; NULL otherwise."""
    y, m = (F.nullif(F.regexp_extract(name, r"(?:^|/|_)((?:19|20)\d{2})[_-](\d{2})(?:\D|$)", i), F.lit("")) for i in (1, 2))
    return F.when(y.isNotNull(), F.concat_ws("-", y, m))


def missing_months(spark: SparkSession, first: str, last: str, present: DataFrame, month: str) -> DataFrame:
    """The months from first to last (yyyy-MM) that ``present`` has not."""
    all_ = spark.sql(f"SELECT explode(sequence(DATE '{first}-01', DATE '{last}-01', INTERVAL 1 MONTH)) AS day").select(F.date_format("day", "yyyy-MM").alias("month"))
    return all_.join(present.select(C(month).alias("month")).distinct(), "month", "left_anti")


def expected_feeds(months: DataFrame, switch: str = "2025-08") -> DataFrame:
    """Which feed a month comes from: releases before the switch, lot codes from it on."""
    return months.withColumn("feed", F.when(C("month") < switch, "releases").otherwise("lot_codes"))


def last_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def drop_late(df: DataFrame, period: str, processed: str) -> DataFrame:
    """The old rule: periods up to the last processed are ignored.  Without it, the checkpoint tracks files and late ones count."""
    return df.filter(C(period) > processed)


LEDGER = "sequence long, stream string, batch long, rows long, seconds double, updated timestamp, base array<string>, deltas array<string>, token string"


class Conflict(Exception):
    """Others were quicker, time and again."""


class KeyedTable:
    """A Parquet table of one row per key in a shared folder; it survives its Python object.

    A merge writes the batch's own last rows as a delta and one entry of the
    log, which names the folders that are the table from then on; so it writes
    as much as the batch holds, and one that breaks off leaves the table as it
    was.  Readers merge: rows of the base whose key no delta has, and the last
    rows of all others.  ``compact`` makes base and deltas a new base, by itself
    once deltas hold more than ``share`` of the base; ``vacuum`` deletes folders
    that no kept entry names.

    Several writers at a time: an entry is taken by a rename that fails if its
    number is there already; the slower writer looks again and takes the next
    one, since the last row of each key doesn't depend on the merges' order.
    Files are sorted by key, so that readers that ask for keys skip by statistics;
    a folder has ``parts`` of them, or as many as the shuffle gives.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], parts: int | None = None, share: float = 1.5, tries: int = 20):
        self.spark, self.path, self.keys, self.order, self.parts, self.share, self.tries = spark, path.rstrip("/"), keys, order, parts, share, tries

    # --- the log ---

    def _fs(self, *below: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *below)))
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def ledger(self) -> DataFrame:
        """One row per entry: sequence, stream, batch, rows of the batch, seconds, updated, and the folders of the table after it."""
        store, folder = self._fs("log")
        found = [f.getPath().toString() for f in store.listStatus(folder) if f.getPath().getName().endswith(".json")] if store.exists(folder) else []
        return self.spark.read.schema(LEDGER).json(found) if found else self.spark.createDataFrame([], LEDGER)

    def _last(self):
        return self.ledger().orderBy(F.desc("sequence")).first()

    def _commit(self, sequence: int, stream: str, batch: int, rows: int, seconds: float, base: list[str], deltas: list[str]) -> bool:
        """Whether the entry was ours."""
        token = uuid.uuid4().hex
        entry = {"sequence": sequence, "stream": stream, "batch": batch, "rows": rows, "seconds": seconds, "updated": datetime.datetime.now().astimezone().isoformat(), "base": base, "deltas": deltas, "token": token}
        store, fresh = self._fs("log", f"_{token}")
        _, target = self._fs("log", f"{sequence:012d}.json")
        out = store.create(fresh, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        took = self._taken(store, fresh, target)
        store.delete(fresh, False)
        return took

    def _taken(self, store, fresh, target) -> bool:
        """Put the entry in its place, unless there is one: a link on a local disk, whose renames replace; elsewhere a rename, which doesn't."""
        nio = self.spark._jvm.java.nio.file
        try:
            if store.getUri().getScheme() == "file":
                at = lambda p: nio.Paths.get(p.toUri().getPath(), self.spark.sparkContext._gateway.new_array(self.spark._jvm.String, 0))
                nio.Files.createLink(at(target), at(fresh))
                return True
            return not store.exists(target) and store.rename(fresh, target)
        except Exception as e:  # noqa: BLE001  whatever the file system calls it
            if "AlreadyExists" in str(e):
                return False
            raise

    # --- reading ---

    def _rows(self, folders: list[str]) -> DataFrame | None:
        return self.spark.read.parquet(*folders) if folders else None

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table, as it is or after the entry ``version``; None before the first merge and after ``clear``."""
        entry = self._last() if version is None else self.ledger().filter(C("sequence") == version).first()
        return self._merged(entry["base"], entry["deltas"]) if entry else None

    def _merged(self, base: list[str], deltas: list[str]) -> DataFrame | None:
        old, new = self._rows(base), self._rows(deltas)
        if new is None or old is None:
            return old if new is None else last_per_key(new, self.keys, [F.desc(c) for c in self.order])
        met = new.select(*self.keys).distinct().select(*[C(k).alias(f"_{i}") for i, k in enumerate(self.keys)])
        same = reduce(and_, [C(k).eqNullSafe(C(f"_{i}")) for i, k in enumerate(self.keys)])
        rest = old.join(met, same, "left_anti")
        touched = old.join(met, same, "left_semi").unionByName(new.select(*old.columns))
        return rest.unionByName(last_per_key(touched, self.keys, [F.desc(c) for c in self.order]))

    # --- writing ---

    def clear(self) -> None:
        """The empty table, for a run that reads everything again; the log goes on."""
        for _ in range(self.tries):
            last = self._last()
            if self._commit(last["sequence"] + 1 if last else 0, "clear", -1, 0, 0.0, [], []):
                return
        raise Conflict(self.path)

    def merge(self, batch: DataFrame, batch_id: int, stream: str = "") -> None:
        """Keep the last row of each key by the order (which is complete); for use in foreachBatch.

        A batch of a stream that the log has is not merged again, unless
        the table was cleared since.  The batch runs once: its rows are counted
        while the delta is written.
        """
        began, target = time.time(), f"{self.path}/data/{uuid.uuid4().hex}"
        if self._has(stream, batch_id):
            return
        seen = Observation()
        rows = last_per_key(batch.observe(seen, F.count(F.lit(1)).alias("rows")), self.keys, [F.desc(c) for c in self.order])
        self._write(rows, target)
        n = seen.get["rows"]
        if not n:
            return
        for _ in range(self.tries):
            last = self._last()
            if self._has(stream, batch_id):  # another try of this batch was quicker
                return
            base, deltas = (last["base"], last["deltas"]) if last else ([], [])
            base, deltas = (base, [*deltas, target]) if base else ([target], deltas)
            if self._commit(last["sequence"] + 1 if last else 0, stream, batch_id, n, time.time() - began, base, deltas):
                if self._bytes(deltas) > self.share * self._bytes(base):
                    self.compact()
                return
        raise Conflict(self.path)

    def _write(self, rows: DataFrame, target: str) -> None:
        dealt = rows.repartitionByRange(self.parts, *self.keys) if self.parts else rows.repartitionByRange(*self.keys)
        dealt.sortWithinPartitions(*self.keys).write.parquet(target)

    def _has(self, stream: str, batch_id: int) -> bool:
        own = (C("stream") == stream) & (C("batch") == batch_id)
        cleared, merged = self.ledger().agg(F.max(F.when(C("stream") == "clear", C("sequence"))), F.max(F.when(own, C("sequence")))).first()
        return merged is not None and (cleared is None or cleared < merged)

    def _bytes(self, folders: list[str]) -> int:
        total = 0
        for f in folders:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(f)
            total += at.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
        return total

    def compact(self) -> bool:
        """Base and deltas as a new base; deltas that came meanwhile stay.  Whether it took; another compaction, or a clearing, goes first."""
        began, entry = time.time(), self._last()
        if not entry or not entry["deltas"]:
            return False
        target = f"{self.path}/data/{uuid.uuid4().hex}"
        self._write(self._merged(entry["base"], entry["deltas"]), target)
        for _ in range(self.tries):
            last = self._last()
            if last["base"] != entry["base"]:
                return False
            later = [d for d in last["deltas"] if d not in entry["deltas"]]
            if self._commit(last["sequence"] + 1, "compact", -1, 0, time.time() - began, [target], later):
                return True
        raise Conflict(self.path)

    def vacuum(self, keep: int = 2, older_than: float = 3600.0) -> int:
        """Delete data folders that none of the last ``keep`` entries names and that are older than so many seconds (writers may be at younger ones); how many went."""
        named = {f.rsplit("/", 1)[1] for r in self.ledger().orderBy(F.desc("sequence")).limit(keep).select("base", "deltas").collect() for f in [*r["base"], *r["deltas"]]}
        store, folder = self._fs("data")
        gone = 0
        for f in store.listStatus(folder) if store.exists(folder) else []:
            if f.getPath().getName() not in named and f.getModificationTime() <= (time.time() - older_than) * 1000:
                gone += bool(store.delete(f.getPath(), True))
        return gone

    def totals(self) -> DataFrame:
        """Rows of the table after each merge: sequence, stream, batch, rows, total; counted when asked for."""
        entries = self.ledger().filter(~C("stream").isin("clear", "compact")).select("sequence", "stream", "batch", "rows", "base", "deltas").orderBy("sequence").collect()
        counted = [self._merged(e["base"], e["deltas"]).agg(F.lit(e["sequence"]).alias("sequence"), F.lit(e["stream"]).alias("stream"), F.lit(e["batch"]).alias("batch"), F.lit(e["rows"]).alias("rows"), F.count("*").alias("total")) for e in entries]
        return reduce(DataFrame.unionByName, counted) if counted else self.spark.createDataFrame([], "sequence long, stream string, batch long, rows long, total long")


class Processed:
    """The last processed period of each feed, kept in a folder, and the old rule that goes by it: up to there, rows are late.

    All batches of a run go by what was processed when the run began, so the
    order in which a run meets its files does not matter.  A batch notes its
    periods after its merge, and they count when its run has come to its end:
    a run that breaks off is taken up again under the bounds that it began with.
    A feed that was never seen has no late rows, a null feed is one of its own,
    and rows without a period never pass.
    """

    def __init__(self, spark: SparkSession, path: str, feed: str, period: str):
        self.feed, self.period = feed, period
        self.state = KeyedTable(spark, path, ["feed", "closed"], ["period"], parts=1)

    def bounds(self, closed: bool = True) -> DataFrame | None:
        """feed, period: the last one of runs that came to their end (or of batches of the one that has not)."""
        rows = self.state.read()
        return None if rows is None else rows.filter(C("closed") == closed).select("feed", "period")

    def on_time(self, batch: DataFrame) -> DataFrame:
        known = self.bounds()
        batch = batch.filter(C(self.period).isNotNull())
        if known is None:
            return batch
        known = known.select(C("feed").alias("_feed"), C("period").alias("_period"))
        late = C(self.feed).eqNullSafe(C("_feed")) & (C(self.period) <= C("_period"))
        return batch.join(known, late, "left_anti")

    def saw(self, batch: DataFrame, batch_id: int, stream: str) -> None:
        last = batch.groupBy(C(self.feed).cast("string").alias("feed")).agg(F.max(self.period).cast("string").alias("period"))
        self.state.merge(last.filter("period IS NOT NULL").withColumn("closed", F.lit(False)), batch_id, stream)

    def close(self) -> None:
        """The run has come to its end: what its batches noted counts from now on."""
        noted = self.bounds(False)
        if noted is not None:
            self.state.merge(noted.withColumn("closed", F.lit(True)), self.state.ledger().count(), "close")


def ingest(spark: SparkSession, source: str, schema, table: KeyedTable, checkpoint: str, glob: str = "*", late_after: tuple[str, str] | None = None, late: Processed | None = None, files: int | None = None) -> None:
    """Process all files that the checkpoint has not seen, then stop; a new checkpoint folder starts anew.

    Late rows count, unless ``late_after`` names a column and its last
    processed period, or ``late`` keeps that per feed.  ``files``: at most so many a batch.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    stream = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(source)
    if late_after:
        stream = drop_late(stream, *late_after)

    def merge(batch: DataFrame, k: int) -> None:
        table.merge(late.on_time(batch) if late else batch, k, checkpoint)
        if late:
            late.saw(batch, k, checkpoint)

    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if late:
        late.close()


def update(spark: SparkSession, source: str, schema, table: KeyedTable, checkpoint: str, rebuild: Callable[[DataFrame], None], force: bool = False) -> dict:
    """One run: ingest what is new, then ``rebuild`` what derives from the table, if anything was new.

    force: the table is read again from all files, and rebuilt.  The next run
    goes on from there; name the same checkpoint each time.
    """
    began = time.time()
    if force:
        table.clear()
    # each clearing starts a checkpoint of its own below the given one
    epoch = table.ledger().filter(C("stream") == "clear").count()
    before = table.ledger().filter(C("stream") != "compact").count()
    ingest(spark, source, schema, table, f"{checkpoint.rstrip('/')}/{epoch}")
    merges = table.ledger().filter(C("stream") != "compact").count() - before
    if merges or force:
        rows = table.read()
        if rows is not None:
            rebuild(rows)
    return {"merges": merges, "rebuilt": bool(merges or force), "seconds": round(time.time() - began, 1)}
