"""Streaming sinks and stateful steps: append, upsert, dedup, windows, progress reports."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from lakejobs.operators.merge import UPSERT, Matched, MergePlan, NotMatched, key_part, merge, merge_partitions
from lakejobs.operators.relational import latest_by
from lakejobs.operators.versions import VersionedTable


def append_files(df: DataFrame, target: str, checkpoint: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (),
                 name: str | None = None) -> StreamingQuery:
    """Append sink with exactly-once files; reads what is there and stops.

    Readers of the folder follow the sink's own file list, so batch jobs must not
    append to it.
    """
    writer = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    return (writer.partitionBy(*partition_by) if partition_by else writer).start(target)


def append_table(df: DataFrame, table: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append sink to a catalog table, which can itself be the source of another stream."""
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.partitionBy(*partition_by) if partition_by else writer).toTable(table)


def per_batch(df: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_batches(
    stream: DataFrame, table: VersionedTable, on: list[str], order: list[str], checkpoint: str, plan: MergePlan = UPSERT
) -> StreamingQuery:
    """Merge each micro-batch into a versioned table, newest row per key first.

    A batch that is run again after a failure is recognised by its number in the
    history, so it is applied once.
    """

    def apply(batch: DataFrame, number: int) -> None:
        done = f"STREAM MERGE {number}"
        if not table.history().where(F.col("operation") == done).isEmpty():
            return
        newest = latest_by(batch, on, order, [c for c in batch.columns if c not in on])
        table.commit(merge(table.read(), newest, on, plan, small_source=True), done)

    return per_batch(stream, apply, checkpoint)


#: Column that deals the rows of an upserted table to its partitions, and the folder that records the batches.
PART, LEDGER = "_part", "_batches"


def create_keyed(df: DataFrame, path: str, on: list[str], parts: int) -> None:
    """Write a table dealt to ``parts`` partitions by its keys, with an empty record of batches."""
    df.withColumn(PART, key_part(on, parts)).repartition(PART).write.partitionBy(PART).parquet(path)
    df.sparkSession.createDataFrame([], "batch long, partitions int").write.parquet(f"{path}/{LEDGER}")


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the table; the folder of the record is hidden from readers by its name."""
    return spark.read.parquet(path).drop(PART)


def newer_wins(order: list[str]) -> MergePlan:
    """Update where the source row is at least as new, insert what is missing.

    The same rows again change nothing, nor do older rows that come late.
    """
    source, target = (F.struct(*[F.col(f"{side}.{c}") for c in order]) for side in ("s", "t"))
    return MergePlan((Matched(condition=source >= target),), (NotMatched(),))


def upsert_partitions(
    stream: DataFrame, path: str, on: list[str], order: list[str], parts: int, checkpoint: str, plan: MergePlan | None = None
) -> StreamingQuery:
    """Merge each micro-batch, newest row per key first, into a table made by ``create_keyed``.

    Only the partitions that the keys of the batch belong to are read and written. The number of a
    batch is recorded after it; one that is repeated after that is passed over. A
    batch that died before it was recorded is merged again, so ``plan`` has to give the
    same rows when it is applied twice, as ``newer_wins`` does.
    """
    chosen = plan or newer_wins(order)

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        spark.catalog.refreshByPath(path)
        if not spark.read.parquet(f"{path}/{LEDGER}").where(F.col("batch") == number).isEmpty():
            return
        newest = latest_by(batch, on, order, [c for c in batch.columns if c not in on]).withColumn(PART, key_part(on, parts))
        written = merge_partitions(spark, path, newest, on, PART, chosen, by_key=True)
        spark.createDataFrame([(number, written)], "batch long, partitions int").write.mode("append").parquet(f"{path}/{LEDGER}")

    return per_batch(stream, apply, checkpoint)


def dedup(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """First row per key within the watermark; the state of older keys is dropped.

    Zone-less event times are cast, since a watermark needs an instant.
    """
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)
    return timed.dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, keys: list[str], event_time: str, delay: str, length: str, slide: str | None = None) -> DataFrame:
    """Counts and sums per key and event-time window, keyed by the window end; closing rows (``with_closing``) don't count."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)
    window = F.window(event_time, length, slide) if slide else F.window(event_time, length)
    real = ~F.col(CLOSING) if CLOSING in stream.columns else F.lit(True)
    return timed.groupBy(*keys, window.alias("w")).agg(
        F.count(F.when(real, 1)).alias("n"), F.sum(F.when(real, F.col("value").cast("decimal(18,2)"))).alias("total")
    ).where("n > 0").select(*keys, F.col("w.end").alias("until"), "n", "total")


#: Column that marks closing rows.
CLOSING = "_closing"


def with_closing(stream: DataFrame, folder: str, event_time: str) -> DataFrame:
    """The stream and the closing rows of ``folder`` (made here, empty at first): marked rows with nothing but an event time."""
    spark = stream.sparkSession
    kind = stream.schema[event_time].dataType.simpleString()
    spark.createDataFrame([], f"`{event_time}` {kind}").write.mode("append").parquet(folder)
    ends = spark.readStream.schema(f"`{event_time}` {kind}").parquet(folder)
    return stream.withColumn(CLOSING, F.lit(False)).unionByName(ends.withColumn(CLOSING, F.lit(True)), allowMissingColumns=True)


def close_windows(spark: SparkSession, folder: str, event_time: str, kind: str, last: DataFrame, after: str) -> None:
    """Write one closing row, ``after`` the time that ``last`` (one row, one column) holds.

    Run again from its checkpoint, the stream moves its watermark past all windows that
    are open and writes them. Rows that come later with a time before the closing row are late.
    Nothing is written for a ``last`` without a time.
    """
    at = F.col(last.columns[0]).cast("timestamp") + F.expr(f"INTERVAL {after}")
    last.where(F.col(last.columns[0]).isNotNull()).select(at.cast(kind).alias(event_time)).coalesce(1).write.mode("append").parquet(folder)


def refresh_days(
    spark: SparkSession, source: Callable[[], DataFrame], stream: DataFrame, target: str, day: str,
    aggregate: Callable[[DataFrame], DataFrame], checkpoint: str
) -> StreamingQuery:
    """Keep a stored daily aggregate fresh: recompute only the days a batch touches.

    ``source`` gives the table to recompute from, ``day`` names the date column of
    both the stream and the aggregate; dynamic partition overwrite replaces just
    the touched days.
    """

    def apply(batch: DataFrame, _: int) -> None:
        touched = batch.select(day).distinct()
        fresh = aggregate(source().join(touched, day, "left_semi"))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(target)

    return per_batch(stream, apply, checkpoint)


def observed(stream: DataFrame, name: str = "rows_out") -> DataFrame:
    """The stream with its rows counted here, for ``ProgressLog``: file sinks report no number of rows."""
    return stream.observe(name, F.count(F.lit(1)).alias(name))


PROGRESS = "query string, flow string, batch long, at string, rows_in long, rows_out long, millis long"


class ProgressLog(StreamingQueryListener):
    """Appends the progress of every micro-batch of the session's streams to a Parquet folder.

    Spark itself keeps the last 100 batches of a query in memory. Rows are written
    ``every`` so many batches and when a query ends, each write a file of its own.

    Use: ``with ProgressLog(spark, path) as log: ...; log.ended(query); log.read()``.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self.spark, self.path, self.every = spark, path, every
        self.rows: list[tuple] = []
        self.lock = threading.Lock()
        self.done: dict[str, threading.Event] = {}
        spark.createDataFrame([], PROGRESS).write.mode("append").parquet(path)

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self._write()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        counted = p.observedMetrics.get("rows_out")
        out = int(counted["rows_out"]) if counted is not None else int(p.sink.numOutputRows)
        with self.lock:
            self.rows.append((str(p.id), p.name, int(p.batchId), p.timestamp, int(p.numInputRows), out, int(p.batchDuration)))
            full = len(self.rows) >= self.every
        if full:
            self._write()

    def onQueryTerminated(self, event) -> None:
        self._write()
        self._event(str(event.runId)).set()

    def _event(self, run: str) -> threading.Event:
        with self.lock:
            return self.done.setdefault(run, threading.Event())

    def _write(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def ended(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Wait until the query has ended and all of its progress is written; events come after the query itself."""
        query.awaitTermination()
        if not self._event(str(query.runId)).wait(timeout):
            raise TimeoutError(f"no end of query {query.runId} was reported")

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def progress_report(query: StreamingQuery) -> DataFrame:
    """Rows in and out of each micro-batch, newest first, from the query's own progress (a bounded list)."""
    rows = [
        (str(p["name"]), int(p["batchId"]), str(p["timestamp"]), int(p["numInputRows"]), int((p["sink"] or {}).get("numOutputRows", -1)))
        for p in query.recentProgress
    ]
    spark = SparkSession.active()
    frame = spark.createDataFrame(rows, "flow string, batch long, at string, rows_in long, rows_out long")
    return frame.orderBy(F.desc("at"))
