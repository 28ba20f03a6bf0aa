"""What several operators share: stored intermediate tables, words, rolling hashes, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeflow.sources.scratch import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read again.

    It cuts the lineage: executors lost later do not cost a second run of what came
    before, and what reads the table sees plain scans.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(name: str) -> Column:
    """A text column as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def cells(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


# -- words and rolling hashes -------------------------------------------------------

#: Odd, so it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A stable 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


class Rolling:
    """Hashes of every run of ``k`` neighbouring words, in a few array operations."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 2 * len(self.up), 4096)
            self.up, self.down = powers(BASE, size), powers(INVERSE, size)

    def sums(self, hashes: np.ndarray) -> np.ndarray:
        self.grow(len(hashes) + 1)
        total = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * self.down[: len(hashes)], out=total[1:])
        return total

    def runs(self, total: np.ndarray, k: int) -> np.ndarray:
        """One hash per start; none if there are fewer than ``k`` words."""
        n = len(total) - k
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        return mixed((total[k:] - total[:n]) * self.up[:n])


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All integers of the half-open intervals, one interval after the other."""
    lengths = np.maximum(ends - starts, 0)
    if not lengths.sum():
        return np.empty(0, dtype=np.int64)
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return first + np.arange(lengths.sum())


# -- components ---------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the graph with edges (a, b); component is its smallest node.

    Alternating large-star and small-star steps, each a grouping with map-side
    minimum and a join; the rounds grow with the logarithm of the longest path. The
    minima are stored, so that adaptive execution may split a hub's edges. Nodes
    without edges do not appear. Nothing but two numbers a round reaches the driver.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before = signature(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")
        large = (
            both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = signature(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def signature(edges: DataFrame) -> tuple[int, int]:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def per_row(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Batches of a stream of rows."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)
