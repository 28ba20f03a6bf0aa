"""The change log on disk: Parquet, one folder per stream and batch, partitioned by commit.

``root/stream=S/batch_id=N/commit_time=T[/<partition columns>]``.  A batch that is
written again replaces its own folder and nothing else, so replays change nothing.
The new folder is written whole before it takes the old one's place.

``root/_bases/as_of=T`` holds the table as it stood at commit T. Reads start from the newest
base that is not too new and add the commits after it, so they do not grow with the age of
the log. A commit that is written at or before T makes the bases from T on invalid; they are
deleted before it takes its place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeflow.operators.changelog import COMMIT, KEY, commit_rows, parse_instant, snapshot, snapshot_as_of
from gradeflow.operators.students import latest_record
from gradeflow.sources import folders
from gradeflow.sources.scratch import in_pass, sliced
from gradeflow.sources.tables import empty_frame, write_parquet

STREAM, BATCH = "stream", "batch_id"
#: The stream of batches that no streaming query runs.
DIRECT = "direct"


def log_schema(payload: T.StructType) -> T.StructType:
    """The payload with the columns the log adds."""
    return T.StructType(
        [
            *payload.fields,
            T.StructField(KEY, T.StringType()),
            T.StructField(COMMIT, T.StringType()),
            T.StructField(STREAM, T.StringType()),
            T.StructField(BATCH, T.LongType()),
        ]
    )


def write_commit(
    df: DataFrame,
    root: str,
    batch_id: int,
    instant: str,
    *,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    stream: str = DIRECT,
    passes: int = 1,
    shape: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Append a batch to the log, one row per key when ``order`` is given; ``shape`` then gives the rows to write.

    In several ``passes`` the disk holds the shuffles of a part of the keys at a time.
    """
    spark, target = df.sparkSession, f"{root}/{STREAM}={stream}/{BATCH}={batch_id}"
    waiting = folders.waiting(root)
    for rows in sliced(commit_rows(df, instant, keys), [KEY], passes, root):
        newest = rows if order is None else latest_record(rows, [KEY], order)
        newest = newest if shape is None else shape(newest)
        write_parquet(newest, waiting, partition_by=[COMMIT, *partition_by], mode="append")
    drop_bases(spark, root, min([parse_instant(instant), *_commits(spark, f"{target}/{COMMIT}=*")]))
    folders.replace(spark, waiting, target)


def _commits(spark: SparkSession, pattern: str) -> list[str]:
    return sorted({path.rsplit("=", 1)[1] for path in folders.matching(spark, pattern)})


def commit_times(spark: SparkSession, root: str) -> list[str]:
    """The commits of a stored log in order, from the names of its folders; no data is read."""
    return _commits(spark, f"{root}/{STREAM}=*/{BATCH}=*/{COMMIT}=*")


def read_log(spark: SparkSession, root: str, payload: T.StructType) -> DataFrame:
    """Read the whole log; filters on commit_time and partition columns skip folders."""
    return spark.read.schema(log_schema(payload)).parquet(root)


def ensure_log(spark: SparkSession, root: str, payload: T.StructType) -> DataFrame:
    """Read the log, creating an empty one if the path does not exist.

    Any other failure to read is raised: an unreadable log is not an empty one.
    """
    try:
        return read_log(spark, root, payload)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    empty = empty_frame(spark, log_schema(payload)).drop(STREAM, BATCH)
    empty.write.mode("errorifexists").partitionBy(COMMIT).parquet(f"{root}/{STREAM}={DIRECT}/{BATCH}=-1")
    return read_log(spark, root, payload)


def base_times(spark: SparkSession, root: str) -> list[str]:
    return _commits(spark, f"{root}/_bases/as_of=*")


def drop_bases(spark: SparkSession, root: str, since: str) -> None:
    """Delete the bases at ``since`` and after it."""
    for time in base_times(spark, root):
        if time >= since:
            folders.delete(spark, f"{root}/_bases/as_of={time}")


def write_base(
    spark: SparkSession, root: str, payload: T.StructType, instant: str | None = None, *, passes: int = 1
) -> str | None:
    """Store the table as it stood at the last commit up to ``instant``; returns that commit."""
    limit = None if instant is None else parse_instant(instant)
    past = [t for t in commit_times(spark, root) if limit is None or t <= limit]
    if not past:
        return None
    waiting = folders.waiting(root)
    for number in range(passes):
        table = read_as_of(spark, root, payload, past[-1])
        write_parquet(table if passes == 1 else table.where(in_pass([KEY], number, passes)), waiting, mode="append")
    folders.replace(spark, waiting, f"{root}/_bases/as_of={past[-1]}")
    return past[-1]


def read_as_of(spark: SparkSession, root: str, payload: T.StructType, instant: str | None = None) -> DataFrame:
    """The table as it stood at ``instant``, or as it stands.

    Reads the newest base that is not after ``instant`` and the commits that follow it. The
    newest commit of a record counts, as in ``changelog.snapshot``.
    """
    log, limit = read_log(spark, root, payload), None if instant is None else parse_instant(instant)
    past = [t for t in base_times(spark, root) if limit is None or t <= limit]
    if not past:
        return snapshot(log) if limit is None else snapshot_as_of(log, limit)
    base = spark.read.schema(log.schema).parquet(f"{root}/_bases/as_of={past[-1]}")
    after = log.where(F.col(COMMIT) > past[-1])
    if limit is not None:
        after = after.where(F.col(COMMIT) <= limit)
    return snapshot(base.unionByName(after))


def compact(
    spark: SparkSession, log: DataFrame, new_root: str, *, partition_by: Sequence[str] = ()
) -> None:
    """Write a log (say, one cut down by ``retain_commits``) to a new place."""
    write_parquet(log, new_root, partition_by=[STREAM, BATCH, COMMIT, *partition_by])


def write_versioned(
    df: DataFrame, path: str, fmt: str, options: dict[str, str], mode: str = "append"
) -> None:
    """Write through a table format found on the class path, options passed as given."""
    df.write.format(fmt).options(**options).mode(mode).save(path)
