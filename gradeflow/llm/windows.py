"""Which runs of words occur at more than one place, over a whole table.

Both substring operators end here. ``pack`` hashes runs of words of each document,
gathers the entries of a few million words (a *load*) and deals them over buckets by
hash. What travels is packed: one binary row per load and bucket, with entries sorted
by hash and stored as byte planes, of which the upper ones compress to little.
``matched`` compares the entries of a bucket; ``resolved`` gives the hits of a load
back to its documents.

* A run that a load meets many times is sent to its bucket once; its other places are
  hits already and are spread by load. A passage that a third of all rows share thus
  reaches its bucket once per few million words.
* The number of buckets follows the size of the table, so a bucket holds a bounded
  number of words; it is an ordinary shuffle partition, cut by hash bits. A load is
  bounded too (but never cuts a document).
* 64 bits of hash tell runs apart.

Documents are named by doc_id and a hash of the text, so rows that share an id but not
a text are kept apart; a null id is a name like any other. Rows equal in both have the same
places, so one set of places per name is gathered, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import Rolling, cells, ranges, utf8, word_hashes

#: Words of a load.
LOAD = 3_000_000
#: Characters of text for each bucket.
BUCKET_CHARS = 12_000_000

#: A run's starts, their hashes, and which starts are results if the run occurs elsewhere.
Picked = tuple[np.ndarray, np.ndarray, np.ndarray]

REPORT, TWICE, PLACE = np.uint32(1 << 30), np.uint32(1 << 31), np.uint32((1 << 30) - 1)
LATER = TWICE  # in hits
NOBODY = np.iinfo(np.int64).max

ENTRIES, KNOWN, OWNERS = 0, 1, 2
PACKED = "bucket int, load long, kind int, size int, a binary, b binary, c binary, d binary"
PACKED_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("load", pa.int64()), ("kind", pa.int32()), ("size", pa.int32())]
    + [(x, pa.binary()) for x in "abcd"]
)
HITS = "doc_id long, th long, places binary"


def named(docs: DataFrame) -> DataFrame:
    """doc_id, th (a hash of the text) and the text's bytes."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("th"), utf8("text").alias("text"))


def text_hash() -> Column:
    """The first 60 bits of the text's MD5; null is empty.

    Never null, and known to be: inner and outer joins on it then share one shuffle of the texts.
    """
    return F.coalesce(F.conv(F.substring(F.md5(utf8("text")), 1, 15), 16, 10).cast("long"), F.lit(0).cast("long"))


def tag(ths: np.ndarray) -> np.ndarray:
    """The upper 32 of a text hash's 60 bits, which order the texts under one doc_id."""
    return (ths >> 28).astype("<u4")


def buckets_for(docs: DataFrame) -> int:
    """Enough buckets for the table: one number from one scan."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(32, -(-chars // BUCKET_CHARS))


def planes(values: np.ndarray) -> bytes:
    """Little-endian bytes: the first of every value, then the second, and so on."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unplaned(data: bytes, kind: str, size: int) -> np.ndarray:
    """The ``size`` values of ``planes``, of which the last planes were kept."""
    width = np.dtype(kind).itemsize
    kept = np.frombuffer(data, np.uint8).reshape(-1, size)
    wide = np.zeros((size, width), np.uint8)
    wide[:, width - len(kept) :] = kept.T
    return wide.view(kind).ravel()


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Buckets in the order of the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


class Load:
    """The entries of a few million words."""

    def __init__(self, task: int, n_buckets: int, ordered: bool, width: int) -> None:
        self.task, self.n_buckets, self.ordered, self.width, self.number = task, n_buckets, ordered, width, 0
        self.clear()

    def clear(self) -> None:
        self.names: set[tuple[int | None, int]] = set()
        self.ids: list[int | None] = []
        self.ths: list[int] = []
        self.parts: list[Picked] = []
        self.starts: list[int] = []
        self.n = 0

    def add(self, doc_id: int | None, th: int, n_words: int, picked: Picked) -> None:
        if self.ordered and (doc_id, th) in self.names:
            return  # the same places again
        if len(picked[0]):
            self.names.add((doc_id, th))
            self.ids.append(doc_id)
            self.ths.append(th)
            self.parts.append(picked)
            self.starts.append(self.n)
            self.n += n_words

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        load = self.task << 32 | self.number
        sizes = [len(p[0]) for p in self.parts]
        starts = np.array(self.starts, dtype="<u4")
        place = np.concatenate([p[0] for p in self.parts]).astype("<u4")
        at = place + np.repeat(starts, sizes)
        hashes = np.concatenate([p[1] for p in self.parts])
        report = np.concatenate([p[2] for p in self.parts])
        ids = np.array([NOBODY if x is None else x for x in self.ids], dtype="<i8")
        if self.ordered:
            own, text = np.repeat(ids, sizes), np.repeat(tag(np.array(self.ths, dtype="<i8")), sizes)
            order = np.lexsort((place, text, own, hashes))
            own, text, place = own[order], text[order], place[order]
        else:
            order = np.argsort(hashes, kind="stable")
        hashes, at, report = hashes[order], at[order], report[order]
        first = np.ones(len(at), dtype=bool)
        first[1:] = hashes[1:] != hashes[:-1]
        group = np.cumsum(first) - 1
        again = ~first
        twice = np.bincount(group, weights=again)[group] > 0
        known = again & report
        sent = first  # the first place stands for all that this load has
        entry = at | np.where(report, REPORT, np.uint32(0)) | np.where(twice, TWICE, np.uint32(0))
        spread = int(load % self.n_buckets)
        rows = [
            {
                "bucket": spread, "load": load, "kind": OWNERS, "size": len(ids),
                "a": ids.tobytes(), "b": np.array(self.ths, dtype="<i8").tobytes(), "c": starts.tobytes(),
                "d": np.array([x is None for x in self.ids], dtype=np.uint8).tobytes(),
            }
        ]
        later = LATER if self.ordered else np.uint32(0)
        if known.any():
            rows.append({"bucket": spread, "load": load, "kind": KNOWN, "size": int(known.sum()), "a": planes(at[known] | later)})
        hashes, entry = hashes[sent], entry[sent]
        if self.ordered:
            own, text, place = own[sent], text[sent], place[sent]
        cuts = np.searchsorted(bucket_of(hashes, self.n_buckets), np.arange(self.n_buckets + 1, dtype=np.uint64))
        for b in np.flatnonzero(np.diff(cuts)):
            x, y = cuts[b], cuts[b + 1]
            rows.append(
                {
                    "bucket": int(b), "load": load, "kind": ENTRIES, "size": int(y - x),
                    "a": planes(hashes[x:y])[(8 - self.width) * (y - x) :], "b": planes(entry[x:y]),
                    "c": planes(own[x:y]) if self.ordered else None,
                    "d": planes(text[x:y]) + planes(place[x:y]) if self.ordered else None,
                }
            )
        self.number += 1
        self.clear()
        for i in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(rows[i : i + 256], schema=PACKED_SCHEMA)


def pack(
    docs: DataFrame,
    pick: Callable[..., Picked],
    n_buckets: int,
    columns: tuple[str, ...] = (),
    ordered: bool = False,
    width: int = 8,
) -> DataFrame:
    """Rows of PACKED for ``docs`` (named). ``pick(hash sums, rolling, *columns)`` names the runs.

    ``ordered``: entries carry doc_id, text and position, so that a first place can be told,
    and rows equal in doc_id and text are one document; without it they are several.
    ``width``: bytes of hash an entry carries, from the highest; six will do where what is
    found is looked at again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, load = Rolling(), Load(TaskContext.get().partitionId(), n_buckets, ordered, width)
        for batch in batches:
            more = [cells(batch, c) for c in columns]
            named_rows = zip(cells(batch, "doc_id"), cells(batch, "th"), cells(batch, "text"), strict=True)
            for i, (doc_id, th, raw) in enumerate(named_rows):
                total = rolling.sums(word_hashes(raw.split()))
                load.add(doc_id, th, len(total), pick(total, rolling, *(m[i] for m in more)))
                if load.n >= LOAD:
                    yield from load.rows()
        yield from load.rows()

    return docs.mapInArrow(run, PACKED)


def matched(packed: DataFrame) -> DataFrame:
    """Per load, the reported places whose run occurs elsewhere."""

    def of(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        out = [x for x in rows if x["kind"] != ENTRIES]
        rows = [x for x in rows if x["kind"] == ENTRIES]
        if rows:
            hashes = np.concatenate([unplaned(x["a"], "<u8", x["size"]) for x in rows])
            entry = np.concatenate([unplaned(x["b"], "<u4", x["size"]) for x in rows])
            source = np.repeat(np.arange(len(rows)), [x["size"] for x in rows])
            if rows[0]["c"] is not None:
                own = np.concatenate([unplaned(x["c"], "<i8", x["size"]) for x in rows])
                text = np.concatenate([unplaned(x["d"][: 4 * x["size"]], "<u4", x["size"]) for x in rows])
                place = np.concatenate([unplaned(x["d"][4 * x["size"] :], "<u4", x["size"]) for x in rows])
                order = np.lexsort((place, text, own, hashes))
            else:
                order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            first = np.ones(len(order), dtype=bool)
            first[1:] = ranked[1:] != ranked[:-1]
            number = np.cumsum(first) - 1
            if rows[0]["c"] is not None:
                lead = order[np.flatnonzero(first)[number]]  # the same document may come from several loads
                again = (own[order] != own[lead]) | (text[order] != text[lead]) | (place[order] != place[lead])
            else:
                again = ~first
            marked = again | ((entry[order] & TWICE) > 0)
            hit = (np.bincount(number, weights=marked) > 0)[number] & ((entry[order] & REPORT) > 0)
            entry &= PLACE
            if rows[0]["c"] is not None:
                entry[order[again]] |= LATER
            chosen = order[hit]
            chosen = chosen[np.argsort(source[chosen], kind="stable")]
            cuts = np.searchsorted(source[chosen], np.arange(len(rows) + 1))
            for i in np.flatnonzero(np.diff(cuts)):
                at = entry[chosen[cuts[i] : cuts[i + 1]]]
                out.append(rows[i] | {"kind": KNOWN, "size": len(at), "a": planes(at), "b": None, "c": None, "d": None})
        return pa.Table.from_pylist(out, schema=PACKED_SCHEMA)

    return packed.groupBy("bucket").applyInArrow(of, PACKED)


def resolved(hits: DataFrame) -> DataFrame:
    """HITS: a row for each document with hits, and its positions.

    Positions are unsigned 32-bit integers; of ordered entries the highest bit says that
    the run has an earlier place.
    """

    def of(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        owners = next(x for x in rows if x["kind"] == OWNERS)
        found = [unplaned(x["a"], "<u4", x["size"]) for x in rows if x["kind"] == KNOWN]
        ids, ths = np.frombuffer(owners["a"], "<i8"), np.frombuffer(owners["b"], "<i8")
        starts, none = np.frombuffer(owners["c"], "<u4"), np.frombuffer(owners["d"], np.uint8) > 0
        at = np.concatenate(found) if found else np.empty(0, "<u4")
        at = at[np.argsort(at & PLACE, kind="stable")]
        owner = np.searchsorted(starts, at & PLACE, side="right") - 1
        used, first = np.unique(owner, return_index=True)
        ends = np.append(first, len(at))[1:]
        return pa.table(
            {
                "doc_id": pa.array(ids[used], mask=none[used], type=pa.int64()),
                "th": pa.array(ths[used], type=pa.int64()),
                "places": pa.array(
                    [(at[a:b] - starts[o]).astype("<u4").tobytes() for o, a, b in zip(used, first, ends, strict=True)],
                    pa.binary(),
                ),
            }
        )

    return hits.groupBy("load").applyInArrow(of, HITS)


def repeated(
    docs: DataFrame,
    pick: Callable[..., Picked],
    n_buckets: int,
    columns: tuple[str, ...] = (),
    ordered: bool = False,
    width: int = 8,
) -> DataFrame:
    """HITS of the runs that ``pick`` names in ``docs``."""
    return resolved(matched(pack(docs, pick, n_buckets, columns, ordered, width)))


def gathered(hits: DataFrame) -> DataFrame:
    """One row for each document with hits; of equal rows all loads say the same, so once is enough."""
    return hits.groupBy("doc_id", "th").agg(F.collect_set("places").alias("places"))


def with_places(docs: DataFrame, hits: DataFrame, how: str) -> DataFrame:
    """``docs`` (named) with ``places``: a list of binaries, null where there are none."""
    a, b = docs.alias("a"), gathered(hits).alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.th") == F.col("b.th"))
    return a.join(b, same, how).select("a.*", "b.places")


def joined(places: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """The sorted, distinct positions of one document, and those that are later places."""
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    raw = np.unique(np.frombuffer(b"".join(places), "<u4"))
    later = (raw & LATER) > 0
    at = (raw & PLACE).astype(np.int64)
    return np.unique(at), at[later]


def coverage(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a run of ``length`` words from one of the starts."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, n), -1)
    return np.cumsum(edge[:-1]) > 0


def starts_around(anchors: np.ndarray, before: int, window: int, n: int) -> np.ndarray:
    """Starts of the windows that begin at an anchor or up to ``before`` words earlier."""
    return np.unique(ranges(np.maximum(anchors - before, 0), np.minimum(anchors, n - window) + 1))


def around(before: int, window: int) -> Callable[..., Picked]:
    """Picks the windows around a document's anchors (the column ``places``)."""

    def pick(total: np.ndarray, rolling: Rolling, places: list[bytes]) -> Picked:
        starts = starts_around(joined(places)[0], before, window, len(total) - 1)
        return starts, rolling.runs(total, window)[starts], np.ones(len(starts), bool)

    return pick
