"""Scratch space that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeflow.sources import folders

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Codec of stored tables: raw grades take 70 % of the default's bytes.
STORED_CODEC = "zstd"
#: Codec of stored CSV, JSON lines and messages: some 55 % of the bytes of lz4, for more CPU time.
TEXT_CODEC = "gzip"
#: Bytes of Parquet input for which a shuffle gets one more partition.
BYTES_PER_PART = 4 * 1024 * 1024
#: Bytes of a file that one task reads where wide rows are sorted.
BYTES_PER_READ = 32 * 1024 * 1024
#: Bytes of stored input whose rows are shuffled at a time; more are taken in several passes.
BYTES_PER_PASS = 1024 * 1024 * 1024
_PARTS, _READ = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
#: Makes Spark delete a job's shuffle files when it ends, not when the driver's memory is next collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SLICE = "__slice"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for what is run inside; put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def sized(spark: SparkSession, size: int) -> Iterator[None]:
    """Tasks for jobs that sort and shuffle wide rows of ``size`` bytes of stored input.

    The number of shuffle partitions follows the input, so a task's share, and what its sorts
    hold in memory, stays the same as the input grows; it never falls below the session's.
    Shuffle files of a finished job are deleted at once, so the disk holds those of one job.
    Applies to what is run, not merely planned, inside; a stream started here keeps it.
    """
    values = {
        _PARTS: str(max(int(spark.conf.get(_PARTS)), -(-size // BYTES_PER_PART))),
        _READ: str(min(bytes_of(spark, spark.conf.get(_READ)), BYTES_PER_READ)),
        CLEANUP: "true",
    }
    with settings(spark, values):
        yield


def passes(size: int) -> int:
    """How many passes rows of ``size`` bytes of stored input are taken in."""
    return max(1, -(-size // BYTES_PER_PASS))


def in_pass(columns: Sequence[str], number: int, of: int) -> Column:
    """True for the rows of one of ``of`` passes; rows equal in ``columns`` are in the same one, NULLs included."""
    return F.pmod(F.xxhash64(*columns), F.lit(of)) == number


def sliced(df: DataFrame, columns: Sequence[str], of: int, home: str) -> Iterator[DataFrame]:
    """``df`` in ``of`` parts, for one pass each; rows equal in ``columns`` are in the same part.

    It is computed once and stored under ``home``, by a name that readers skip; a part is deleted
    when the next one is asked for. Without ``columns`` the rows of a task stay together. There is
    one part at least.
    """
    if of == 1:
        yield df
        return
    spark, path = df.sparkSession, folders.waiting(home)
    part = F.pmod(F.xxhash64(*columns), F.lit(of)) if columns else F.spark_partition_id() % of
    try:
        df.withColumn(_SLICE, part).write.partitionBy(_SLICE).parquet(path, compression=STORED_CODEC)
        stored = folders.matching(spark, f"{path}/{_SLICE}=*")
        for place in stored:
            yield spark.read.schema(df.schema).parquet(place)
            folders.delete(spark, place)
        if not stored:
            yield spark.createDataFrame([], df.schema)
    finally:
        folders.delete(spark, path)


def stored_in_passes(df: DataFrame, keys: Sequence[str], size: int, label: str) -> DataFrame:
    """``df``, whose shuffles are by ``keys``, stored in as many passes as input of ``size`` bytes takes.

    The input is read once a pass. What takes one pass is left as it is.
    """
    spark, of = df.sparkSession, passes(size)
    if of == 1:
        return df
    path = scratch_path(spark, label)
    with sized(spark, size):
        for number in range(of):
            df.where(in_pass(keys, number, of)).write.mode("append").parquet(path, compression=STORED_CODEC)
    return spark.read.schema(df.schema).parquet(path)


def bytes_of(spark: SparkSession, text: str) -> int:
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for intermediate tables.

    It lies in the shared folder that the cluster names in ``spark.checkpoint.dir``.
    Only a local session, whose tasks run on this machine, may fall back to a
    temporary folder.
    """
    name = f"gradeflow-{label}-{uuid.uuid4().hex}"
    shared = configured(spark, CHECKPOINT_DIR)
    if shared:
        return f"{shared.rstrip('/')}/{name}"
    if is_local(spark):
        return f"{tempfile.mkdtemp(prefix='gradeflow-')}/{name}"
    raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")


def stored_copy(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read again: its rows keep their files and places from then on."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=STORED_CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def configured(spark: SparkSession, key: str) -> str | None:
    return spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")
