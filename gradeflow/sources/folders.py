"""Folders of stored tables, through the file system that Spark itself uses.

Only names and times are looked at; no data file is opened.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str) -> tuple:
    """The file system of ``path``, and the path as it wants it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _opened(spark, path)
    return files.exists(where)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a glob pattern, in order; none if the folder is missing."""
    files, where = _opened(spark, pattern)
    return sorted(found.getPath().toString() for found in files.globStatus(where) or [])


def delete(spark: SparkSession, path: str) -> None:
    files, where = _opened(spark, path)
    files.delete(where, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, which says that something is done."""
    files, where = _opened(spark, path)
    files.create(where, True).close()


def waiting(root: str) -> str:
    """A new folder beside the data, with a name that readers skip."""
    return f"{root}/_waiting-{uuid.uuid4().hex}"


def replace(spark: SparkSession, new: str, path: str) -> None:
    """Move a finished folder to ``path``, in place of what is there.

    What is there is moved aside first, under a name that readers skip, and deleted last:
    a stop in between leaves both on disk, and the move can be made again.
    """
    files, target = _opened(spark, path)
    source = _opened(spark, new)[1]
    parent = target.getParent().toString()
    files.mkdirs(target.getParent())
    old = _opened(spark, f"{parent}/_replaced-{uuid.uuid4().hex}")[1]
    if not files.exists(source):
        raise FileNotFoundError(new)
    there = files.exists(target)
    if there and not files.rename(target, old):
        raise OSError(f"could not move {path} aside")
    if not files.rename(source, target):
        raise OSError(f"could not move {new} to {path}")
    if there:
        files.delete(old, True)
