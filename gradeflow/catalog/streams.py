"""Streaming queries: stage messages, run until drained, read the result back."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeflow.catalog import steps as S
from gradeflow.catalog.registry import query
from gradeflow.catalog.rows import V4
from gradeflow.columns import PROCESSED_GRADES, RAW_GRADES
from gradeflow.operators import changelog as G
from gradeflow.operators.cleaning import with_processing_time
from gradeflow.operators.lookups import map_program_ids
from gradeflow.plans import fixtures as X
from gradeflow.plans.cleaning import clean_grades, clean_grades_stream
from gradeflow.sources.keyed import KeyedTable
from gradeflow.sources.scratch import STORED_CODEC, TEXT_CODEC, scratch_path, sized, stored_in_passes
from gradeflow.sources.tables import literal_frame
from gradeflow.sources.versioned import ensure_log, read_log
from gradeflow.streaming import batches as B
from gradeflow.streaming import messages as M
from gradeflow.streaming.progress import ProgressStore

SHOWN = ", ".join(S.SHOWN)
MESSAGE = T.StructType(
    [
        *RAW_GRADES.fields,
        T.StructField("row_key", T.StringType()),
        T.StructField("updated_at", T.StringType()),
    ]
)
# some records arrive a second time as a line that is not JSON
_SPOILT = "l_partkey % 97 = 0"


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Grade records as they are sent; the time travels as text."""
    return (
        X.raw_grades(spark, sf)
        .withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))
        .select(*MESSAGE.fieldNames())
    )


def send(messages: DataFrame, path: str) -> None:
    """Messages as compressed text: plain, with every field's name, they are 30 times the tables' Parquet."""
    messages.write.mode("append").text(path, compression=TEXT_CODEC)


def inbox(spark: SparkSession, path: str) -> DataFrame:
    return M.stream_source(spark, "text", {"maxFilesPerTrigger": "1000"}, path)


def spoilt(spark: SparkSession, sf: str) -> DataFrame:
    lines = X.table(spark, sf, "lineitem").where(_SPOILT)
    return lines.select(F.concat(F.lit("spoilt "), F.col("l_orderkey").cast("string")).alias("value"))


def ingested(spark: SparkSession, sf: str, store: ProgressStore | None = None) -> str:
    """Messages, spoilt ones among them, appended as they come; returns the table's path."""
    root = scratch_path(spark, "ingest")
    send(M.to_messages(records(spark, sf)).unionByName(spoilt(spark, sf)), f"{root}/in")
    routed = M.parse_json_payload(inbox(spark, f"{root}/in"), MESSAGE)
    query = B.start_append(routed, f"{root}/out", f"{root}/checkpoint")
    if store is not None:
        store.settled(query)
    B.drain(query)
    return f"{root}/out"


@query(f"SELECT {SHOWN} FROM raw_grades")
def stream_ingest(spark, sf):
    return B.read_appended(spark, ingested(spark, sf), MESSAGE).drop("updated_at")


@query(
    f"""SELECT concat('spoilt ', CAST(l_orderkey AS VARCHAR)) AS corrupt_record
        FROM lineitem WHERE {_SPOILT}"""
)
def stream_corrupt(spark, sf):
    """The unreadable messages, from the folder beside the readable rows."""
    return B.read_rejects(spark, ingested(spark, sf), MESSAGE)


@query(
    f"""SELECT CAST((SELECT count(*) FROM raw_grades) + n AS BIGINT) AS input_rows,
          CAST(n AS BIGINT) AS rejected_rows, CAST(0 AS BIGINT) AS damaged_rows
        FROM (SELECT count(*) AS n FROM lineitem WHERE {_SPOILT}) lost"""
)
def append_metrics(spark, sf):
    """Rows and losses of a plain append stream, from its stored progress."""
    root = scratch_path(spark, "progress")
    with ProgressStore(spark, root) as store:
        ingested(spark, sf, store)
    columns = ["input_rows", "rejected_rows", "damaged_rows"]
    return B.read_metrics(spark, root).agg(*(F.sum(c).alias(c) for c in columns))


def _appended(spark: SparkSession, sf: str) -> tuple[str, T.StructType]:
    """Messages, spoilt ones among them, cleaned and appended batch by batch; the folder and the rows' schema."""
    root = scratch_path(spark, "append")
    send(M.to_messages(records(spark, sf)).unionByName(spoilt(spark, sf)), f"{root}/in")
    routed = M.parse_json_payload(inbox(spark, f"{root}/in"), MESSAGE)

    def process(rows: DataFrame) -> DataFrame:
        return clean_grades_stream(rows).drop("updated_at", "processing_time")

    job = B.AppendJob(
        process, f"{root}/out", partition_by=["schoolyear"], rejects_root=f"{root}/rejects", metrics_root=f"{root}/metrics",
        passes=X.passes(spark, sf),
    )
    with sized(spark, X.source_bytes(spark, sf)):
        B.drain(B.start_batches(routed, job, f"{root}/checkpoint"))
    return root, process(literal_frame(spark, [], MESSAGE)).schema


@query(V4)
def stream_append(spark, sf):
    root, schema = _appended(spark, sf)
    return B.read_batches(spark, f"{root}/out", schema)


@query(
    f"""SELECT (SELECT CAST(count(*) AS BIGINT) FROM raw_grades) + n AS input_rows, n AS rejected_rows, n AS stored_rejects
        FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE {_SPOILT}) lost"""
)
def stream_append_losses(spark, sf):
    """What a cleaning append stream could not read: counted, and stored beside its rows."""
    root, _ = _appended(spark, sf)
    rejects = B.read_batches(spark, f"{root}/rejects", T.StructType().add(M.CORRUPT, T.StringType()))
    none = F.lit(0).cast("long")
    counted = B.read_metrics(spark, f"{root}/metrics").select("input_rows", "rejected_rows", none.alias("stored_rejects"))
    stored = rejects.select(none.alias("input_rows"), none.alias("rejected_rows"), F.lit(1).cast("long").alias("stored_rejects"))
    return counted.unionByName(stored).agg(*(F.sum(c).alias(c) for c in ("input_rows", "rejected_rows", "stored_rejects")))


def _clean(batch: DataFrame) -> DataFrame:
    return clean_grades(batch, X.AS_OF_YEAR)


def _instant(batch_id: int) -> str:
    """A fixed instant for each batch, a millisecond after the batch before."""
    when = datetime(2024, 1, 1) + timedelta(milliseconds=batch_id)
    return when.isoformat(sep=" ", timespec="milliseconds")


def _run_batches(
    spark: SparkSession, sf: str, root: str, deliver: Callable[[DataFrame], DataFrame], **more
) -> DataFrame:
    """Three deliveries to one checkpointed query, restarted for each; returns the log."""
    job = B.BatchJob(
        transform=_clean,
        log_root=f"{root}/log",
        keys=["id"],
        order=X.VERSION,
        partition_by=["schoolyear"],
        instant=_instant,
        passes=X.passes(spark, sf),
        **more,
    )
    sent = records(spark, sf)
    for _, condition in X.COMMITS.values():
        with sized(spark, X.source_bytes(spark, sf)):
            send(deliver(sent.where(condition)), f"{root}/in")
            parsed = M.parse_json_payload(inbox(spark, f"{root}/in"), MESSAGE, "route")
            B.drain(B.start_batches(parsed, job, f"{root}/checkpoint"))
    payload = _clean(literal_frame(spark, [], MESSAGE)).schema
    return read_log(spark, f"{root}/log", payload)


_UPSERTED = ", ".join(c for c in S.CLEANED if c != "updated_at")


@query(
    f"""SELECT {_UPSERTED} FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY {S.VERSION}) AS rn
          FROM cleaned) ranked WHERE rn = 1"""
)
def stream_upsert(spark, sf):
    log = _run_batches(spark, sf, scratch_path(spark, "upsert"), M.to_messages)
    newest = G.snapshot(log, order=X.VERSION).select(*(c for c in S.CLEANED if c != "updated_at"), G.KEY)
    return stored_in_passes(newest, [G.KEY], X.source_bytes(spark, sf), "upserted").drop(G.KEY)


#: These records come with a text for their units, and a second time as a line that is not JSON.
_DAMAGED = "id % 89 = 0"


def _damaged_messages(sent: DataFrame) -> DataFrame:
    units = F.when(F.expr(_DAMAGED), F.lit("many")).otherwise(F.col("units").cast("string"))
    typed = sent.where(f"NOT ({_DAMAGED})")
    wrong = sent.where(_DAMAGED)
    broken = wrong.select(F.concat(F.lit("{broken "), F.col("row_key")).alias("value"))
    return M.to_messages(typed).unionByName(M.to_messages(wrong.withColumn("units", units))).unionByName(broken)


@query(
    f"""SELECT CAST((SELECT count(*) FROM raw_grades) + n AS BIGINT) AS input_rows,
          CAST((SELECT count(*) FROM cleaned) AS BIGINT) AS output_rows,
          CAST(n AS BIGINT) AS rejected_rows, CAST(n AS BIGINT) AS damaged_rows
        FROM (SELECT count(*) AS n FROM raw_grades WHERE {_DAMAGED}) damaged"""
)
def batch_metrics(spark, sf):
    root = scratch_path(spark, "metrics")
    _run_batches(spark, sf, root, _damaged_messages, metrics_root=f"{root}/metrics")
    columns = ["input_rows", "output_rows", "rejected_rows", "damaged_rows"]
    return B.read_metrics(spark, f"{root}/metrics").agg(*(F.sum(c).alias(c) for c in columns))


# -- arrival -----------------------------------------------------------------
_ARRIVAL = ["timestamp", "partition", "offset"]


@query(
    """SELECT id, row_key, grade_final FROM (
         SELECT *, row_number() OVER (PARTITION BY id
           ORDER BY CAST(instructor_id AS INT) % 10 DESC, units DESC, row_key DESC) AS rn
         FROM raw_grades) ranked WHERE rn = 1"""
)
def stream_arrival_order(spark, sf):
    """The version of a record that arrived last, by the message's own columns."""
    root = scratch_path(spark, "arrival")
    sent = records(spark, sf)
    day = F.col("instructor_id").cast("int") % 10
    arrived = [
        F.timestamp_seconds(F.lit(1_704_067_200) + day * 86_400).alias("timestamp"),
        (F.col("id") % 3).cast("int").alias("partition"),
        F.col("units").cast("long").alias("offset"),
    ]
    messages = sent.select(F.to_json(F.struct(*sent.columns)).alias("value"), *arrived)
    messages.write.parquet(f"{root}/in", compression=STORED_CODEC)
    stream = M.stream_source(spark, "parquet", {}, f"{root}/in", messages.schema)
    parsed = M.parse_json_payload(stream, MESSAGE, "route", keep=_ARRIVAL)
    order = [*_ARRIVAL, "row_key"]
    job = B.BatchJob(
        transform=lambda batch: batch, log_root=f"{root}/log", keys=["id"], order=order, instant=_instant, keep=_ARRIVAL,
        passes=2 * X.passes(spark, sf) if X.passes(spark, sf) > 1 else 1,  # one batch holds all rows, as they came
    )
    with sized(spark, X.source_bytes(spark, sf)):
        B.drain(B.start_batches(parsed, job, f"{root}/checkpoint"))
    payload = M.good(literal_frame(spark, [], parsed.schema)).schema
    log = read_log(spark, f"{root}/log", payload)
    newest = G.snapshot(log, order=order).select("id", "row_key", "grade_final", G.KEY)
    return stored_in_passes(newest, [G.KEY], X.source_bytes(spark, sf), "arrived").drop(G.KEY)


# -- the whole job -----------------------------------------------------------
_PROCESSED = [f.name for f in PROCESSED_GRADES.fields]
_PROCESSED_AT = "2024-01-01 12:00:00"


@query(
    f"""SELECT {", ".join(c for c in _PROCESSED if c not in ("program_id", "processing_time"))},
          program_id, TIMESTAMP '{_PROCESSED_AT}' AS processing_time
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {S.VERSION}) AS rn FROM cleaned) ranked
        LEFT JOIN (SELECT program AS known, program_id FROM program_list) programs ON program = known
        WHERE rn = 1"""
)
def stream_processed(spark, sf):
    """Cleaned, with program ids and processing time, into the log and a keyed table.

    Nothing is handed from one delivery to the next: each has a job and a table object of
    its own, as after a restart.
    """
    root = scratch_path(spark, "processed")
    programs = X.programs(spark, sf)
    order = ["updated_at", "row_key"]

    def process(batch: DataFrame) -> DataFrame:
        cleaned = map_program_ids(clean_grades(batch, X.AS_OF_YEAR), programs)
        return with_processing_time(cleaned, F.lit(_PROCESSED_AT).cast("timestamp"))

    payload = process(literal_frame(spark, [], MESSAGE)).schema
    ensure_log(spark, f"{root}/log", payload)
    for _, condition in X.COMMITS.values():
        job = B.BatchJob(
            transform=process, log_root=f"{root}/log", keys=["id"], order=order, partition_by=["schoolyear"], instant=_instant,
            tables=[KeyedTable(f"{root}/current", payload, ["id"], order, buckets=16)],
            rejects_root=f"{root}/rejects", metrics_root=f"{root}/metrics", passes=X.passes(spark, sf),
        )
        with sized(spark, X.source_bytes(spark, sf)):
            send(M.to_messages(records(spark, sf).where(condition)), f"{root}/in")
            B.drain(B.start_batches(M.parse_json_payload(inbox(spark, f"{root}/in"), MESSAGE), job, f"{root}/checkpoint"))
    current = KeyedTable(f"{root}/current", payload, ["id"], order, buckets=16).read(spark)
    return current.select(*(F.col(f.name).cast(f.dataType) for f in PROCESSED_GRADES.fields))
