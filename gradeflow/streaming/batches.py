"""Micro-batch processing: clean, log, upsert, measure."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager, nullcontext
from dataclasses import dataclass, field
from datetime import datetime, timezone
from time import monotonic

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from gradeflow.sources import folders
from gradeflow.sources.keyed import KeyedTable
from gradeflow.sources.scratch import STORED_CODEC, sliced
from gradeflow.sources.tables import empty_frame, write_parquet
from gradeflow.sources.versioned import BATCH, DIRECT, STREAM, write_commit
from gradeflow.streaming.messages import CORRUPT, bad, good, unreadable

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class BatchMetrics:
    batch_id: int
    input_rows: int
    output_rows: int
    seconds: float
    rejected_rows: int = 0
    damaged_rows: int = 0

    @property
    def rows_per_second(self) -> float:
        return self.output_rows / self.seconds if self.seconds > 0 else 0.0


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame for several uses; always let go of it."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def closing_copy(df: DataFrame, home: str) -> Iterator[DataFrame]:
    """``df`` stored under ``home`` for several uses, by a name that readers skip, and deleted."""
    spark, path = df.sparkSession, folders.waiting(home)
    try:
        df.write.parquet(path, compression=STORED_CODEC)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folders.delete(spark, path)


@dataclass
class Measured:
    """What every batch job does around its writing.

    Row counts are observed while the batch is written, without a job of their own, and
    stored under ``metrics_root``, one folder per stream and batch. Batches parsed with
    ``route`` are told apart here: unreadable messages are counted as rejected and go to
    ``rejects_root`` and ``rejects``, messages with a faulty field are counted as damaged
    and stay. A batch that has unreadable messages is parsed once more for them: kept, it would take
    as much disk as its rows.

    Of a large batch the rows are shuffled in several ``passes``; the disk holds one pass's shuffle.

    ``stream`` names this stream in all folders. Without a name it is the query's id, which
    belongs to its checkpoint, so another query or a new checkpoint does not overwrite this
    one's batches. Any failure is raised, so the engine runs the batch again; every output
    replaces its own batch.
    """

    transform: Transform
    on_metrics: Callable[[BatchMetrics], None] | None = field(default=None, kw_only=True)
    metrics_root: str | None = field(default=None, kw_only=True)
    rejects: Callable[[DataFrame], None] | None = field(default=None, kw_only=True)
    rejects_root: str | None = field(default=None, kw_only=True)
    keep: Sequence[str] = field(default=(), kw_only=True)
    stream: str | None = field(default=None, kw_only=True)
    passes: int = field(default=1, kw_only=True)

    def write(self, cleaned: DataFrame, batch_id: int, stream: str) -> None:
        raise NotImplementedError

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        started = monotonic()
        stream = self.stream or _query_id(batch)
        routed = CORRUPT in batch.columns
        two = routed and (self.rejects is not None or self.rejects_root is not None)
        taken, kept = Observation(), Observation()
        rows = good(batch.observe(taken, *counts(batch, self.keep)), self.keep) if routed else batch.observe(taken, counted())
        self.write(self.transform(rows).observe(kept, counted()), batch_id, stream)
        seen = taken.get
        if two and (seen["rejected"] or self._rejected_before(batch.sparkSession, batch_id, stream)):
            self._reject(bad(batch, self.keep), batch_id, stream)
        metrics = BatchMetrics(
            batch_id, seen["rows"], kept.get["rows"], monotonic() - started, seen.get("rejected", 0), seen.get("damaged", 0)
        )
        if self.metrics_root is not None:
            write_metrics(batch.sparkSession, self.metrics_root, stream, metrics)
        if self.on_metrics is not None:
            self.on_metrics(metrics)

    def _rejected_before(self, spark: SparkSession, batch_id: int, stream: str) -> bool:
        return self.rejects_root is not None and folders.exists(spark, batch_folder(self.rejects_root, stream, batch_id))

    def _reject(self, lost: DataFrame, batch_id: int, stream: str) -> None:
        if self.rejects_root is not None:
            write_batch(lost, self.rejects_root, stream, batch_id)
        if self.rejects is not None:
            self.rejects(lost)


@dataclass
class BatchJob(Measured):
    """Log each micro-batch and bring it into keyed tables; an instance is a ``foreachBatch`` function.

    The log is written first and replaces its own batch, then ``tables`` and ``sinks`` get
    the same rows. Sinks must be idempotent by key; tables know which batches they have.
    """

    log_root: str
    keys: Sequence[str]
    order: Sequence[str]
    partition_by: Sequence[str] = ()
    sinks: Sequence[Callable[[DataFrame], None]] = ()
    instant: Callable[[int], str] | None = None
    tables: Sequence[KeyedTable] = ()

    def _kept(self, cleaned: DataFrame) -> AbstractContextManager[DataFrame]:
        """For the log, tables and sinks: the same rows, whatever the transform; a large batch on disk, compressed."""
        return persisted(cleaned) if self.passes == 1 else closing_copy(cleaned, self.log_root)

    def write(self, cleaned: DataFrame, batch_id: int, stream: str) -> None:
        with self._kept(cleaned) if self.sinks or self.tables else nullcontext(cleaned) as cleaned:
            write_commit(
                cleaned,
                self.log_root,
                batch_id,
                (self.instant or _now)(batch_id),
                keys=self.keys,
                order=self.order,
                partition_by=self.partition_by,
                stream=stream,
                passes=self.passes,
            )
            for table in self.tables:
                table.merge(cleaned, stream, batch_id, self.passes)
            for sink in self.sinks:
                sink(cleaned)


@dataclass
class AppendJob(Measured):
    """Append each micro-batch, transformed, to ``root``; an instance is a ``foreachBatch`` function."""

    root: str
    partition_by: Sequence[str] = ()

    def write(self, cleaned: DataFrame, batch_id: int, stream: str) -> None:
        write_batch(cleaned, self.root, stream, batch_id, self.partition_by, self.passes)


def counted() -> Column:
    return F.count(F.lit(1)).alias("rows")


def counts(routed: DataFrame, keep: Sequence[str] = ()) -> list[Column]:
    """Aggregates to observe on routed messages: rows, rejected, damaged."""
    lost = unreadable(routed, keep)
    faulty = F.col(CORRUPT).isNotNull() & ~lost
    return [counted(), F.count_if(lost).alias("rejected"), F.count_if(faulty).alias("damaged")]


def batch_folder(root: str, stream: str, batch_id: int) -> str:
    return f"{root}/{STREAM}={stream}/{BATCH}={batch_id}"


def write_batch(df: DataFrame, root: str, stream: str, batch_id: int, partition_by: Sequence[str] = (), passes: int = 1) -> None:
    """Store a batch in a folder of its own; a batch that runs again replaces it."""
    whole = folders.waiting(root)
    for rows in sliced(df, (), passes if partition_by else 1, root):
        write_parquet(rows, whole, partition_by=partition_by, mode="append")
    folders.replace(df.sparkSession, whole, batch_folder(root, stream, batch_id))


def read_batches(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All batches of all streams under ``root``; none if nothing was written."""
    if not folders.matching(spark, f"{root}/{STREAM}=*"):
        return empty_frame(spark, schema)
    with_batch = T.StructType([*schema.fields, T.StructField(STREAM, T.StringType()), T.StructField(BATCH, T.LongType())])
    return spark.read.schema(with_batch).parquet(root).select(*schema.fieldNames())


METRICS = "input_rows long, output_rows long, seconds double, rejected_rows long, damaged_rows long"


def write_metrics(spark: SparkSession, root: str, stream: str, metrics: BatchMetrics) -> None:
    """Store a batch's metrics; a batch that runs again replaces its own."""
    row = (metrics.input_rows, metrics.output_rows, metrics.seconds, metrics.rejected_rows, metrics.damaged_rows)
    folder = batch_folder(root, stream, metrics.batch_id)
    spark.createDataFrame([row], METRICS).coalesce(1).write.mode("overwrite").parquet(folder)


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """The metrics of every batch of every stream under ``root``."""
    return spark.read.schema(f"{METRICS}, {STREAM} string, {BATCH} long").parquet(root)


def _query_id(batch: DataFrame) -> str:
    """The id of the streaming query that runs the batch; it is kept in its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or DIRECT


def _now(_: int) -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]


def start_batches(
    stream: DataFrame,
    job: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    every: str | None = None,
    output_mode: str = "update",
) -> StreamingQuery:
    """Run a batch job: ``every`` interval, or until the source is drained."""
    writer = stream.writeStream.foreachBatch(job).outputMode(output_mode)
    return triggered(writer.option("checkpointLocation", checkpoint), every).start()


#: Tells readable rows from unreadable messages in an appended table.
READABLE = "readable"
#: What the counts of an appended stream are called in its progress.
MESSAGES = "messages"


def start_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = (),
    every: str | None = None,
    keep: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once.

    A stream parsed with ``route`` loses nothing: unreadable messages go to a folder beside
    the readable rows, in the same pass, and their numbers are in the query's progress
    (:class:`gradeflow.streaming.progress.ProgressStore` stores it). Read it with
    :func:`read_appended` and :func:`read_rejects`. To clean rows on the way, and keep the
    unreadable ones too, start an :class:`AppendJob` with :func:`start_batches`.
    """
    if CORRUPT in stream.columns:
        partition_by = [READABLE, *partition_by]
        stream = stream.observe(MESSAGES, *counts(stream, keep)).withColumn(READABLE, ~unreadable(stream, keep))
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("compression", STORED_CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return triggered(writer.option("checkpointLocation", checkpoint), every).start()


def _appended(spark: SparkSession, path: str, schema: T.StructType, readable: bool) -> DataFrame:
    extra = [T.StructField(CORRUPT, T.StringType()), T.StructField(READABLE, T.BooleanType())]
    return spark.read.schema(T.StructType([*schema.fields, *extra])).parquet(path).where(F.col(READABLE) == readable)


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The readable rows that :func:`start_append` stored; the folder of the others is skipped."""
    return _appended(spark, path, schema, True).select(*schema.fieldNames())


def read_rejects(spark: SparkSession, path: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The messages, as text, that could not be read."""
    return _appended(spark, path, schema, False).select(*keep, CORRUPT)


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def drain(query: StreamingQuery) -> None:
    """Wait for a drained query and raise what it raised."""
    query.awaitTermination()


def progress(query: StreamingQuery) -> list[BatchMetrics]:
    """What the engine still remembers about recent batches of a query; for all of them
    store metrics (``metrics_root``).

    Rows written are known only to sinks that report them; the rest say -1.
    """
    return [
        BatchMetrics(
            batch_id=p["batchId"],
            input_rows=p["numInputRows"],
            output_rows=p["sink"].get("numOutputRows", -1),
            seconds=p["durationMs"].get("triggerExecution", 0) / 1000.0,
        )
        for p in query.recentProgress
    ]
