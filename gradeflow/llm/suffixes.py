"""Repeated passages by sparse suffix arrays.

Of every 26 neighbouring suffixes of a document, the one whose first 25 words hash
lowest is retained: its minimiser. Which suffixes are retained thus depends on the
words alone, and every passage of 50 words holds a retained suffix with 25 words to go
at the same place wherever it occurs. The retained suffixes of all documents are sorted
by range partitions (by hash, which puts equal beginnings side by side as well as any
order does, and then by place, so that a beginning shared by a third of all rows spreads
over many tasks). Neighbours that begin alike are matches; a run at the edge of a
partition counts as one, because its neighbour may lie in the next. Matches are then
extended left and right, to all windows of 50 words around them, and those are compared
by all their words.

A passage's first place stays, by doc_id, then (texts that share an id) by the text's MD5,
then by position; words are removed that lie in a window with an earlier place. Null and
empty texts have no words. Rows equal in doc_id and text are one document with the same
places: they stay alike, and their spans are reported once. Rows without doc_id come last
in the order, and are told apart by their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import Rolling, cells, stored, word_hashes
from gradeflow.llm.substrings import without
from gradeflow.llm.windows import around, buckets_for, coverage, gathered, joined, named, repeated, text_hash, with_places

WINDOW = 50


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[: len(values) - step], values[step:])
        done += step
    return values


def minimisers(runs: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the lowest of some ``width`` neighbours; ties all count."""
    if len(runs) < width:
        return np.empty(0, np.int64)
    low = lowest(runs, width)
    pad = np.zeros(width - 1, dtype=runs.dtype)
    best = ~lowest(~np.concatenate((pad, low, pad)), width)  # highest of the windows that hold a position
    return np.flatnonzero(best == runs)


def suffixes(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The retained suffixes: doc_id, th, position and the hash of their first words."""
    head = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, seen = Rolling(), set()
        for batch in batches:
            ids, ths, ats, keys = [], [], [], []
            for doc_id, th, raw in zip(*(cells(batch, c) for c in ("doc_id", "th", "text")), strict=True):
                words = raw.split()
                if len(words) < window or (doc_id, th) in seen:
                    continue
                seen.add((doc_id, th))
                runs = rolling.runs(rolling.sums(word_hashes(words)), head)
                at = minimisers(runs, window - head + 1)
                ids += [doc_id] * len(at)
                ths += [th] * len(at)
                ats.append(at)
                keys.append(runs[at].view(np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(ths, pa.int64()),
                        pa.array(np.concatenate(ats).astype(np.int32)),
                        pa.array(np.concatenate(keys)),
                    ],
                    names=["doc_id", "th", "at", "key"],
                )

    return docs.mapInArrow(run, "doc_id long, th long, at int, key long")


def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted suffixes, those whose neighbour begins alike, and the runs at both ends."""
    start, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        keys = rows["key"].to_numpy()
        start = keys[0] if start is None else start
        same = keys[1:] == keys[:-1]
        chosen = keys == start
        chosen[1:] |= same
        chosen[:-1] |= same
        if held is not None:
            chosen[0] |= marked
        marked = bool(chosen[-1])
        held = rows.slice(len(keys) - 1).to_batches()[0]
        found = rows.slice(0, len(keys) - 1).filter(pa.array(chosen[:-1]))
        yield from found.select(["doc_id", "th", "at"]).to_batches()
    if held is not None:
        yield held.select(["doc_id", "th", "at"])


def anchors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, th and ``places``: retained suffixes that begin like another one."""
    array = stored(suffixes(docs, window), "suffixes")
    ranked = array.repartitionByRange("key", "doc_id", "at").sortWithinPartitions("key", "doc_id", "at")
    found = ranked.mapInArrow(alike, "doc_id long, th long, at int")
    return found.groupBy("doc_id", "th").agg(F.collect_set("at").alias("list")).select(
        "doc_id", "th", packed_places(F.col("list")).alias("places")
    )


def packed_places(lists: Column) -> Column:
    @F.arrow_udf("binary")
    def of(values: pa.Array) -> pa.Array:
        return pa.array([np.sort(np.array(x.as_py(), dtype="<u4")).tobytes() for x in values], pa.binary())

    return of(lists)


def starts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """HITS of ``docs``: starts of the windows that occur at several places."""
    texts = named(docs)
    hit = with_places(texts, anchors(texts, window), "inner")
    return repeated(hit, around(window - window // 2, window), buckets_for(docs), ("places",), ordered=True)


def spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Maximal spans of repeated words: doc_id, start_word, n_words, n_removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, th, raw, places in zip(*(cells(batch, c) for c in ("doc_id", "th", "text", "places")), strict=True):
                n = len(raw.split())
                every, later = joined(places)
                inside = np.concatenate(([False], coverage(every, window, n), [False]))
                gone = np.concatenate(([0], np.cumsum(coverage(later, window, n))))
                edges = np.flatnonzero(inside[1:] != inside[:-1])
                out += [
                    {"doc_id": doc_id, "th": th, "start_word": a, "n_words": b - a, "n_removed": gone[b] - gone[a]}
                    for a, b in edges.reshape(-1, 2).tolist()
                ]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=SPANS)

    found = with_places(named(docs), starts(docs, window), "inner")
    every = found.mapInArrow(run, "doc_id long, th long, start_word long, n_words long, n_removed long")
    return every.distinct().drop("th")  # equal rows have equal spans


SPANS = pa.schema([(x, pa.int64()) for x in ("doc_id", "th", "start_word", "n_words", "n_removed")])


def cleaned(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the later places of repeated passages; other columns as they are.

    A column ``n_chars`` is counted again. Texts without such a passage stay byte by byte.
    """

    @F.arrow_udf("string")
    def cut(texts: pa.Array, starts: pa.Array) -> pa.Array:
        out = []
        for raw, places in zip(texts, starts, strict=True):
            raw = raw.as_py()
            later = joined(places.as_py())[1]
            if len(later):
                raw = without(raw, coverage(later, window, len(raw.split())))
            out.append(raw.decode())
        return pa.array(out, pa.string())

    found = gathered(starts(docs, window))
    row = F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row")
    keyed = docs.select(row, F.col("doc_id").cast("long").alias("d"), text_hash().alias("t"))
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("th"))
    both = keyed.join(found, same, "left")
    text = F.when(F.col("places").isNull(), F.col("row.text")).otherwise(
        cut(F.coalesce("row.text", F.lit("")).cast("binary"), F.col("places"))
    )
    new = both.select("row", text.alias("new"))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("new").alias(name))
        elif name == "n_chars":
            counted = F.when(F.col("new").isNotNull(), F.length("new").cast(docs.schema[name].dataType))
            columns.append(F.coalesce(counted, F.col(f"row.`{name}`")).alias(name))
        else:
            columns.append(F.col(f"row.`{name}`").alias(name))
    return new.select(columns)
