"""Short codes of vectors from exact integer matrix products.

Vectors become integers and are cut into equal parts; each part is coded by the number of
the nearest entry of its part's codebook. Distances come from matrix products: integers
are split into limbs so narrow that a product of two limb matrices, summed over the part,
stays below 2**53, where double precision is exact. The limb products are shifted and added
as 64-bit integers, and the first smallest distance wins. No sum depends on its order, so
codes do not depend on the number of tasks or on tasks that run again.

The integers are stored once; a round sends, from each task, one row per part and entry, and
the driver holds the codebooks only.

Vectors that are null or hold a null, NaN or infinite component are dropped. So are vectors
whose length is no multiple of the number of parts or differs from that of the vector with
the smallest vec_id among those left (parts of different lengths have no distance). Repeated rows and
equal or null vec_ids are vectors like others; where the first entries tie on vec_id, the
components decide, and vectors without vec_id come last. With fewer vectors than entries
there are as many entries as vectors; an empty table gives no rows. Vectors too long
for distances to fit a long raise an error. Columns other than vec_id, embedding and label
are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.clustering import SUMS, SUMS_ARROW, VECTORS, Totals, floor_means, matrix, whole
from gradeflow.llm.common import stored

UNIT = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Bits of a double's integers.
EXACT = 53


def limbs(v: np.ndarray, bits: int) -> list[np.ndarray]:
    """``v`` as the sum of limb i times 2**(bits * i); all but the last are not negative."""
    out = []
    while v.size and np.maximum(v, ~v).max() >> bits:
        out.append((v & ((1 << bits) - 1)).astype(np.float64))
        v = v >> bits
    return [*out, v.astype(np.float64)]


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products of the rows of ``x`` with the rows of ``c``."""
    bits = (EXACT - x.shape[1].bit_length()) // 2
    total = np.zeros((len(x), len(c)), dtype=np.int64)
    for j, right in enumerate(limbs(c, bits)):
        for i, left in enumerate(limbs(x, bits)):
            total += (left @ right.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry, the first of equals, and the squared distance."""
    distances = (entries**2).sum(1) - 2 * products(x, entries)
    number = distances.argmin(1)
    return number, distances[np.arange(len(x)), number] + (x**2).sum(1)


def first_entries(vectors: DataFrame, entries: int, parts: int) -> list[np.ndarray]:
    """The codebooks at the start: the parts of the vectors with the smallest vec_ids."""
    first = [r.v for r in vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()]
    return [np.array(part, dtype=np.int64) for part in np.split(np.array(first, dtype=np.int64), parts, axis=1)] if first else []


def moved(table: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round."""
    width = sum(b.shape[1] for b in books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [Totals(*b.shape) for b in books]
        for batch in batches:
            for at in range(0, batch.num_rows, VECTORS):
                v = matrix(batch.slice(at, VECTORS).column(0), width)
                for part, book, own in zip(np.split(v, len(books), axis=1), books, totals, strict=True):
                    own.add(nearest(part, book)[0], part)
        for k, own in enumerate(totals):
            yield pa.RecordBatch.from_pylist(own.rows(k), schema=SUMS_ARROW)

    return floor_means(table.select("v").mapInArrow(run, SUMS), books)


def fitted(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """One codebook per part (entries in rows); none for an empty table."""
    books = first_entries(table, entries, parts)
    for _ in range(rounds if books else 0):
        books = moved(table, books)
    return books


def coded(table: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every vector."""
    width = sum(b.shape[1] for b in books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, VECTORS):
                part = batch.slice(at, VECTORS)
                found = [nearest(v, b) for v, b in zip(np.split(matrix(part.column(2), width), len(books), axis=1), books, strict=True)]
                numbers = np.stack([n for n, _ in found], axis=1).astype(np.uint8)
                code = pa.array([row.tobytes().hex() for row in numbers], pa.string())
                error = pa.array(np.sum([e for _, e in found], axis=0))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), code, error], ["vec_id", "label", "code", "error"])

    kinds = [f"{n} {table.schema[n].dataType.simpleString()}" for n in ("vec_id", "label")]
    return table.select("vec_id", "label", "v").mapInArrow(run, ", ".join([*kinds, "code string", "error long"]))


def usable(vectors: DataFrame, parts: int = PARTS) -> DataFrame:
    """vec_id, label and v of the vectors that can be coded, stored."""
    fit = whole(vectors.where((F.size("embedding") > 0) & (F.size("embedding") % parts == 0)), UNIT, "label")
    table = stored(fit, "integers")
    first = table.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).select(F.size("v").alias("n")).first()
    return table.where(F.size("v") == first.n) if first else table


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector.

    The errors of a label are added up from partial sums of the tasks and joined as a
    table of their own, null labels together; Spark broadcasts it if it is small and
    splits a hot label's vectors otherwise.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number has two hex digits")
    table = usable(vectors, parts)
    books = fitted(table, parts, entries, rounds)
    codes = stored(coded(table, books), "codes")
    sums = stored(codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
