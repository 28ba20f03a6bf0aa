"""A keyed, versioned table as an append-only log of commits.

The log is a DataFrame with ``commit_time`` (compact instant text, so that text
order is time order), ``record_key`` and the payload.  Reads of it are ordinary
DataFrame operators; :mod:`gradeflow.sources.versioned` stores it as Parquet
partitioned by commit, so bounds on ``commit_time`` skip whole commits.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeflow.functions import constants as K
from gradeflow.operators.students import latest_record, natural_key

COMMIT, KEY = "commit_time", "record_key"


def parse_instant(text: str) -> str:
    """Normalise an instant to 17 digits, ``yyyyMMddHHmmssSSS``.

    Accepts that form (with or without milliseconds), ``yyyy-MM-dd HH:mm:ss[.SSS]``
    and ``yyyy-MM-dd``, which means midnight.
    """
    text = text.strip()
    if re.fullmatch(r"\d{14}|\d{17}", text):
        when = datetime.strptime(text[:14], "%Y%m%d%H%M%S")
        millis = text[14:] or "000"
    elif match := re.fullmatch(r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})(?:\.(\d{1,3}))?", text):
        when = datetime.strptime(match[1], "%Y-%m-%d %H:%M:%S")
        millis = (match[2] or "").ljust(3, "0")
    elif re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        when, millis = datetime.strptime(text, "%Y-%m-%d"), "000"
    else:
        raise ValueError(f"not an instant: {text!r}")
    return when.strftime("%Y%m%d%H%M%S") + millis


def commit_rows(
    df: DataFrame, instant: str, keys: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """Shape a batch into a commit; with ``order``, one row per key (the greatest).

    A single key is its own text; several are joined without ambiguity, NULLs included.
    """
    key = F.col(keys[0]).cast("string") if len(keys) == 1 else natural_key(keys)
    rows = df.withColumns({COMMIT: F.lit(parse_instant(instant)), KEY: key})
    return rows if order is None else latest_record(rows, [KEY], order)


def snapshot(
    log: DataFrame,
    keys: Sequence[str] = (KEY,),
    order: Sequence[str] = (COMMIT,),
    *,
    scope: Sequence[str] = (),
) -> DataFrame:
    """The current version of every record.

    Keys are unique across the table; name partition columns in ``scope`` to make
    them unique per partition instead.
    """
    return latest_record(log, [*keys, *scope], order)


def snapshot_as_of(
    log: DataFrame,
    instant: str,
    keys: Sequence[str] = (KEY,),
    order: Sequence[str] = (COMMIT,),
) -> DataFrame:
    """The table as it stood at ``instant``, that commit included."""
    return snapshot(log.where(F.col(COMMIT) <= parse_instant(instant)), keys, order)


def changes_since(
    log: DataFrame,
    instant: str,
    keys: Sequence[str] = (KEY,),
    order: Sequence[str] = (COMMIT,),
) -> DataFrame:
    """The last version of every record changed after ``instant``, exclusive."""
    return snapshot(log.where(F.col(COMMIT) > parse_instant(instant)), keys, order)


def changes_since_first(
    log: DataFrame,
    keys: Sequence[str] = (KEY,),
    order: Sequence[str] = (COMMIT,),
    *,
    known: Sequence[str] | None = None,
) -> DataFrame:
    """Changes after the oldest commit.

    It is found inside the same query, or among the ``known`` commits of a stored log
    (``versioned.commit_times``), which takes no look at the rows.
    """
    first = log.agg(F.min(COMMIT)).scalar() if known is None else F.lit(min(known, default=None))
    return snapshot(log.where(F.col(COMMIT) > first), keys, order)


def upsert(
    base: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Insert or replace by key; the row that is greatest by ``order`` stays."""
    return latest_record(base.unionByName(updates), keys, order)


def with_end(log: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Adds ``valid_until``: the commit that replaced the version, NULL for current ones.

    Equal or repeated rows of one commit share their end. One shuffle and one sort serve both
    windows.
    """
    by_key = Window.partitionBy(*keys)
    next_row = F.lead(COMMIT).over(by_key.orderBy(COMMIT))  # of the last row of a commit: the next commit
    return (
        log.withColumn("__next", next_row)
        .withColumn("__next", F.max("__next").over(Window.partitionBy(*keys, COMMIT)))
        .withColumn("valid_until", F.when(F.col("__next") > F.col(COMMIT), F.col("__next")))
        .drop("__next")
    )


def retain_commits(
    log: DataFrame,
    commits: int = K.COMMITS_RETAINED,
    keys: Sequence[str] = (KEY,),
    order: Sequence[str] = (COMMIT,),
    *,
    known: Sequence[str] | None = None,
) -> DataFrame:
    """Only the versions that reads as of the last ``commits`` commits need, repeated rows included.

    Those are the rows that were not yet replaced at the oldest retained commit: everything
    after it, which is neither shuffled nor compared, and of what came before the newest
    version of each record. That is found from partial maxima and met again on record and
    version, so a record with many versions is no hot key. ``known`` are the commits of a
    stored log (``versioned.commit_times``); without it the rows are asked.
    """
    if known is None:
        times = log.select(COMMIT).distinct().orderBy(F.desc(COMMIT)).limit(commits)
        known = [r[0] for r in times.collect()]
    retained = sorted(known, reverse=True)[:commits]
    if not retained:
        return log
    old = log.where(F.col(COMMIT) <= retained[-1])
    version = F.struct(*(F.col(c) for c in order))
    last = old.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.max(version).alias("__last"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    valid = old.join(last, reduce(and_, same, version.eqNullSafe(F.col("__last"))), "left_semi")
    return log.where(F.col(COMMIT) > retained[-1]).unionByName(valid)
