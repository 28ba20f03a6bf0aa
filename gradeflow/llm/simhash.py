"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint of 64 bits is split into six blocks. Two fingerprints that differ in at
most three bits agree in at least three blocks, so each of the 20 choices of three
blocks is a join key of about 32 bits and every close pair shares one of the keys.
Pairs that share a key are verified by their Hamming distance.

Buckets stay small whatever the data: equal fingerprints are one class before anything
is joined, and a bucket of more than ``DENSE`` classes is split again. Its members
still differ in at most three of the bits outside the key; these fall into eight
smaller blocks of which five must agree, which leaves at most 13 free bits, so no group
can hold more than 8,192 classes however many rows share it.

Null and empty texts have the fingerprint zero. A row without doc_id gets its
fingerprint but no component and links nothing. Rows of one doc_id are one document
of every class that they fall in.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeflow.llm.common import components, stored, utf8

SHINGLE = 3
DISTANCE = 3
SEED = 42
BLOCKS = 6
DENSE = 256
FINE = 8


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """The bits set in over half of the shingles' hashes, as a signed integer."""
    if not words:
        return 0
    if len(words) < shingle:
        runs = [b" ".join(words)]
    else:
        runs = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(runs), 1 << 16):  # bounded memory for long texts
        part = [xxhash.xxh64_intdigest(x, SEED) for x in runs[at : at + (1 << 16)]]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(runs), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x.as_py().lower().split(), shingle) for x in texts], pa.int64())

    return of(text)


def spans(low: int, high: int, n: int) -> list[int]:
    """Masks of ``n`` blocks of nearly equal width that cover the bits from low to high."""
    edges = [low + (high - low) * i // n for i in range(n + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]


def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def coarse_masks(distance: int = DISTANCE) -> list[int]:
    """All unions of the blocks that must agree."""
    return [sum(chosen) for chosen in combinations(spans(0, 64, BLOCKS), BLOCKS - distance)]


def fine_masks(coarse: int, distance: int = DISTANCE) -> list[int]:
    """A coarse mask with each choice of smaller blocks of the other bits that must agree."""
    free = [1 << i for i in range(64) if not coarse >> i & 1]
    edges = [len(free) * i // FINE for i in range(FINE + 1)]
    parts = [sum(free[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    return [coarse | sum(chosen) for chosen in combinations(parts, FINE - distance)]


def keyed(classes: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    """A row for each class and mask: which mask, and the fingerprint under it."""
    keys = [F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("v")) for k, m in masks]
    return classes.select("fp", "rep", F.explode(F.array(*keys)).alias("key")).select("fp", "rep", "key.k", "key.v")


def close_pairs(rows: DataFrame, distance: int) -> DataFrame:
    a = rows.select("k", "v", F.col("fp").alias("fa"), F.col("rep").alias("a"))
    b = rows.select("k", "v", F.col("fp").alias("fb"), F.col("rep").alias("b"))
    near = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= distance
    return a.join(b, ["k", "v"]).where((F.col("fa") < F.col("fb")) & near).select("a", "b")


def near_edges(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b) of representatives whose fingerprints differ in at most ``distance`` bits."""
    masks = coarse_masks(distance)
    rows = keyed(classes, list(enumerate(masks)))
    sizes = rows.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(rows.join(sizes, ["k", "v"]), "buckets")
    small = close_pairs(shared.where(F.col("n") <= DENSE), distance)
    again = shared.where(F.col("n") > DENSE).select("fp", "rep", "k")
    fine = [
        (k, k * 1000 + i, signed(m)) for k, mask in enumerate(masks) for i, m in enumerate(fine_masks(mask, distance))
    ]
    table = classes.sparkSession.createDataFrame(fine, "k int, fine int, mask long")  # 1,120 rows
    dense = again.join(F.broadcast(table), "k").select(
        "fp", "rep", F.col("fine").alias("k"), F.col("fp").bitwiseAND(F.col("mask")).alias("v")
    )
    return small.unionByName(close_pairs(dense, distance)).distinct()


def grouped(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, th (a hash of the text), fp and component_id of every row of ``docs``."""
    prints = stored(
        docs.select("doc_id", F.xxhash64(utf8("text")).alias("th"), fingerprints(utf8("text"), shingle).alias("fp")), "fingerprints"
    )
    classes = stored(
        prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes"
    )
    linked = components(near_edges(classes, distance))
    named = stored(
        classes.join(linked, F.col("rep") == F.col("node"), "left").select(
            "fp", F.coalesce("component", "rep").alias("component_id")
        ),
        "components",
    )
    known = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return prints.join(named, "fp", "left").select("doc_id", "th", "fp", known)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp and component_id of every row of ``docs``."""
    return grouped(docs, shingle, distance).drop("th")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` whose doc_id names its component, one row each.

    Of different texts under one doc_id, those with different fingerprints are documents of
    their own and each keeps a row; of those with the same fingerprint the text with the
    smallest XXH64 stays. Of rows equal in doc_id and text, and of rows without doc_id that are
    equal in text, the one whose columns hash lowest stays; other rows without doc_id all stay.
    """
    heads = (
        grouped(docs, shingle, distance)
        .where("doc_id = component_id")
        .groupBy(F.col("doc_id").alias("head"), "fp")
        .agg(F.min("th").alias("text_hash"))
        .select("head", "text_hash")
    )
    row = F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row")
    keyed = docs.select(row, F.col("doc_id").alias("head"), F.xxhash64(utf8("text")).alias("text_hash"))
    one = F.row_number().over(Window.partitionBy("head", "text_hash").orderBy(F.xxhash64("row")))
    kept = keyed.where("head IS NOT NULL").join(heads, ["head", "text_hash"], "left_semi")
    return kept.unionByName(keyed.where("head IS NULL")).withColumn("one", one).where("one = 1").select("row.*")
