"""Clustering of vectors by exact integer distances, counted on bit planes.

A vector of 64 components becomes 64 integers in two's complement, and plane p of it is the
64-bit word of their bits p. For vectors x and c

    x . c  =  sum over planes p, q of  w_p w_q popcount(x_p AND c_q)

where w_p is 2**p, negative for the topmost (sign) plane. Every product and distance is a
whole number, so results do not depend on the order of summation, on the number of tasks or
on tasks that run again. The planes are stored once and read by every round: they take a
quarter of the room of the floats. A round sends, from each task, one row per cluster; the
centroids (``k`` times 64 integers) are all that the driver holds.

Vectors that are null, of another length, or hold a null, NaN or infinite component are
dropped. Repeated rows and equal or null vec_ids are vectors like others; where starting
centroids tie on vec_id, the components decide, and vectors without vec_id start last. With
fewer vectors than centroids there are as many centroids as vectors; an empty table gives
no rows. Vectors too long for distances to fit a long raise an error. Columns other than
vec_id and embedding are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import stored

DIMENSIONS = 64
UNIT = 64
CLUSTERS = 16
ROUNDS = 3
#: Whole vectors are shorter than this, so that squared distances between them fit a long.
LONGEST = float(1 << 29)
#: Vectors handled at a time.
VECTORS = 4096


def whole(vectors: DataFrame, unit: int, *also: str) -> DataFrame:
    """vec_id, the columns ``also`` and ``v`` (array<long>): floor(unit * x) of finite vectors."""
    x = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists(x, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    large = F.aggregate(x, F.lit(0.0), lambda total, x: total + x * x) >= (LONGEST / unit) ** 2
    kept = vectors.where(F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    checked = F.when(large, F.raise_error(F.lit(f"a vector of length {LONGEST / unit:.0f} or more"))).otherwise(x)
    return kept.select("vec_id", *also, F.transform(checked, lambda x: F.floor(x * float(unit)).cast("long")).alias("v"))


def matrix(column: pa.Array, width: int, dtype=np.int64) -> np.ndarray:
    """A list column of equally long lists as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), width)


# -- bit planes -----------------------------------------------------------------------


def planes_of(v: np.ndarray) -> np.ndarray:
    """(n, planes) words of (n, 64) integers; as few planes as the largest needs, and one for the sign."""
    top = int(np.maximum(v, ~v).max(initial=0)).bit_length() + 1
    bits = (v[:, None, :] >> np.arange(top)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def weights(planes: int) -> np.ndarray:
    w = np.int64(1) << np.arange(planes, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def integers(planes: np.ndarray) -> np.ndarray:
    """The integers that ``planes`` were made of."""
    bits = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(*planes.shape, 8), axis=2, bitorder="little")
    return np.einsum("npj,p->nj", bits.astype(np.int64), weights(planes.shape[1]))


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Dot products of vectors with one other: ``c`` has its planes, or one row of planes per vector."""
    total = np.zeros(x.shape, dtype=np.int64)
    for word, weight in zip(np.atleast_2d(c).T, weights(c.shape[-1]), strict=True):
        total += weight * np.bitwise_count(x & word[:, None]).astype(np.int64)
    return total @ weights(x.shape[1])


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller of equals, and the squared distance."""
    own = products(x, x)
    words = planes_of(centroids)
    distances = np.stack([own - 2 * products(x, c) for c in words], axis=1) + (centroids**2).sum(1)
    number = distances.argmin(1)
    return number, distances[np.arange(len(x)), number]


def packed(vectors: DataFrame) -> DataFrame:
    """vec_id and planes (array<long>) of whole vectors of 64 components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, VECTORS):
                part = batch.slice(at, VECTORS)
                words = planes_of(matrix(part.column(1), DIMENSIONS)).view(np.int64)
                ends = np.arange(len(words) + 1, dtype=np.int32) * words.shape[1]
                planes = pa.ListArray.from_arrays(pa.array(ends), pa.array(words.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), planes], ["vec_id", "planes"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, planes array<long>")


def unpacked(column: pa.Array) -> np.ndarray:
    """Planes of a batch as a matrix; rows with fewer planes repeat their sign plane."""
    ends = column.offsets.to_numpy()
    lengths = np.diff(ends)
    place = np.minimum(np.arange(lengths.max()), lengths[:, None] - 1) + (ends[:-1] - ends[0])[:, None]
    return column.flatten().to_numpy().view(np.uint64)[place]


# -- rounds ---------------------------------------------------------------------------


def floor_means(sums: DataFrame, before: list[np.ndarray]) -> list[np.ndarray]:
    """Centroids of the next round, exact and rounded down.

    ``sums`` has one row per task, group and cluster: group, cluster, n, total (array). It is
    added up position by position, so what arrives here has the size of the centroids. A
    cluster without vectors keeps its centroid.
    """
    each = sums.select("group", "cluster", "n", F.posexplode("total").alias("i", "x"))
    found = each.groupBy("group", "cluster", "i").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    after = [c.copy() for c in before]
    for row in found:
        after[row.group][row.cluster, row.i] = row.x // row.n
    return after


SUMS = "group int, cluster int, n long, total array<long>"


class Totals:
    """Sums of vectors per cluster, gathered by one task."""

    def __init__(self, k: int, width: int) -> None:
        self.n, self.total = np.zeros(k, dtype=np.int64), np.zeros((k, width), dtype=np.int64)

    def add(self, number: np.ndarray, v: np.ndarray) -> None:
        self.n += np.bincount(number, minlength=len(self.n))
        for k in np.unique(number):
            self.total[k] += v[number == k].sum(0)

    def rows(self, group: int) -> list[dict]:
        return [{"group": group, "cluster": int(k), "n": int(self.n[k]), "total": self.total[k].tolist()} for k in np.flatnonzero(self.n)]


SUMS_ARROW = pa.schema([("group", pa.int32()), ("cluster", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))])


def assigned(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of every packed vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, VECTORS):
                part = batch.slice(at, VECTORS)
                number, distance = nearest(unpacked(part.column(1)), centroids)
                columns = [part.column(0), pa.array(number.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    kind = table.schema["vec_id"].dataType.simpleString()
    return table.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = Totals(*centroids.shape)
        for batch in batches:
            for at in range(0, batch.num_rows, VECTORS):
                x = unpacked(batch.slice(at, VECTORS).column(0))
                totals.add(nearest(x, centroids)[0], integers(x))
        yield pa.RecordBatch.from_pylist(totals.rows(0), schema=SUMS_ARROW)

    return floor_means(table.select("planes").mapInArrow(run, SUMS), [centroids])[0]


def starts(vectors: DataFrame, k: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``1:<vec_id>``, in that order."""
    digest = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(digest.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r.v for r in first], dtype=np.int64).reshape(len(first), DIMENSIONS)


def of_cluster(values: list, kind: str) -> Column:
    """One of ``values`` by the cluster of the row."""
    return F.element_at(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster") + 1)


def clustered(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector."""
    usable = whole(vectors.where(F.size("embedding") == DIMENSIONS), UNIT)
    centroids = starts(usable, k)
    table = stored(packed(usable), "planes")
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(table, centroids)
    found = assigned(table, centroids)
    inertia = [0] * len(centroids)
    for row in found.groupBy("cluster").agg(F.sum("distance").alias("sum")).collect():
        inertia[row.cluster] = row["sum"]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster(inertia, "long").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"),
    )
