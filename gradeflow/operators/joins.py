"""Joins that stay balanced when one key holds a large part of the rows.

Three cases, from cheap to dear:

* the other side is measured and small -> broadcast it (:func:`lookup`)
* the other side is large but not aggregated on exactly the join key -> a plain
  equi-join; both sides arrive in a shuffle and adaptive execution splits hot
  partitions
* the other side *is* an aggregate on the join key, so its shuffle cannot be
  split -> :func:`split_join` divides hot keys by hand
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeflow.sources.scratch import stored_copy

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_SPLIT = 5_000_000
#: Parts for rows that meet nothing.
_ANYWHERE = 4096

_SPLITS, _PART, _PLACE = "__splits", "__part", "__place"
_WIDTH, _BYTES = "__width", "__bytes"
#: The part of a generated row number that counts within a partition.
_WITHIN = (1 << 33) - 1


def measured(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame | None:
    """``df`` as rows at hand if it is small enough to broadcast, else None.

    At most ``max_rows + 1`` rows are fetched, and none beyond the one with which their text
    passes ``max_bytes``: wide rows are counted where they are, before they are fetched. The
    table is computed once: what was measured is what is then joined.
    """
    width = F.octet_length(F.to_json(F.struct("*")))
    so_far = Window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = df.limit(max_rows + 1).withColumn(_WIDTH, width).withColumn(_BYTES, F.sum(_WIDTH).over(so_far))
    rows = sized.where(F.col(_BYTES) - F.col(_WIDTH) <= max_bytes).drop(_WIDTH).toArrow()
    total = rows.column(_BYTES)[-1].as_py() if rows.num_rows else 0
    rows = rows.drop_columns([_BYTES])
    if rows.num_rows > max_rows or max(rows.nbytes, total) > max_bytes:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure ``df`` and tell whether it is small enough to broadcast."""
    return measured(df, max_rows, max_bytes) is not None


def lookup(
    df: DataFrame,
    dimension: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    *,
    max_rows: int = BROADCAST_ROWS,
    rows_per_split: int = ROWS_PER_SPLIT,
    at_rest: bool = False,
) -> DataFrame:
    """Join a dimension that holds each key once, without shuffling if it is small."""
    keys = [on] if isinstance(on, str) else list(on)
    small = measured(dimension, max_rows)
    if small is not None:
        return df.join(F.broadcast(small), keys, how)
    return split_join(df, dimension, keys, how, rows_per_split=rows_per_split, at_rest=at_rest)


def split_join(
    df: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    rows_per_split: int = ROWS_PER_SPLIT,
    at_rest: bool = False,
) -> DataFrame:
    """Equi-join (inner or left) that spreads hot keys of ``df`` over several tasks.

    A key with more than ``rows_per_split`` rows is hot.  There are at most
    rows / rows_per_split of them, which bounds the one table broadcast here: a
    trillion rows have no more than 200,000 hot keys.  Rows of a hot key are dealt
    out by their place within their partition, wherever they lie: equal rows, and rows
    that all come from one partition, are parted too.  Places must not change when a
    task runs again, so ``df`` is first written to scratch space and read from there,
    unless it is ``at_rest``, that is, plainly read from files.  The other side's row
    is repeated once per part.  Cold keys are joined as they are.  Every row is kept.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"split_join does inner and left joins, not {how!r}")
    keys = list(on)
    rows = df if at_rest else stored_copy(df, "dealt")
    hot = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") > rows_per_split)
        .select(*keys, F.ceil(F.col("__rows") / F.lit(rows_per_split)).cast("int").alias(_SPLITS))
    )
    hot = F.broadcast(hot)  # no more than rows / rows_per_split
    no_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    dealt = rows.withColumn(_PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN))).join(hot, keys, "left").withColumn(
        _PART,
        # a NULL key matches nothing, so its rows may go anywhere
        F.when(no_key, F.pmod(_PLACE, F.lit(_ANYWHERE)))
        .when(F.col(_SPLITS).isNotNull(), F.pmod(_PLACE, F.col(_SPLITS)))
        .otherwise(F.lit(0))
        .cast("int"),
    ).drop(_SPLITS, _PLACE)
    parts = F.sequence(F.lit(0), F.coalesce(F.col(_SPLITS), F.lit(1)) - 1)
    repeated = other.join(hot, keys, "left").withColumn(_PART, F.explode(parts)).drop(_SPLITS)
    return dealt.join(repeated, [*keys, _PART], how).drop(_PART)


def anti_join(df: DataFrame, known: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not among ``known``."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(known.select(*keys), keys, "left_anti")


def semi_join(df: DataFrame, members: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``members``; NULL keys go.

    With each member once, this is a lookup that keeps the rows it finds.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return lookup(df, members.select(*keys).distinct(), keys, "inner").select(*df.columns)


def new_rows(
    df: DataFrame, known: DataFrame, on: str, batch_size: int | None = None, *order: Column
) -> DataFrame:
    """The next rows to insert: keys not yet known, in key order, a batch at a time."""
    fresh = anti_join(df, known, on)
    if batch_size is None:
        return fresh
    return fresh.orderBy(F.col(on), *order).limit(batch_size)


def union_batches(*batches: DataFrame) -> DataFrame:
    """Stack batches by column name."""
    return reduce(lambda a, b: a.unionByName(b), batches)


def latest_first(*columns: str) -> list[Column]:
    """Descending order with NULLs last, for 'newest wins' windows."""
    return [F.col(c).desc_nulls_last() for c in columns]
