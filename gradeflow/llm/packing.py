"""Best-fit packing of documents into sequences, after dominance reduction.

Only the lengths of pieces decide a packing, and there are at most ``capacity`` of them.
So the table is tokenised once and counted by length; the packing problem is solved on
those counts, in time that does not depend on the number of documents; and the solution,
a list of patterns with multiplicities, is dealt back to the pieces by their rank among
the pieces of equal length.

On the counts, longest first, sets that dominate all alternatives are fixed for good:
a piece that nothing fits beside, a piece with a partner that fills it exactly, and a
piece that has room for one partner only together with the longest that fits. What
remains is packed best fit, longest first.

Null and empty texts are one piece: the end mark. Rows that repeat a document are packed
as often as they occur; null ids are packed like others. Other columns are dropped.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gradeflow.llm.common import cells, stored, utf8
from gradeflow.llm.tokencount import special_tokens, vocabulary as merge_order

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k.json"
#: Parts into which the pieces of one length are dealt for ranking.
RANKED_IN = 512
#: Word pieces remembered by a task.
REMEMBERED = 250_000

Pattern = tuple[int, ...]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# -- tokens -------------------------------------------------------------------------


class Encoder:
    """Token ids of texts as little-endian bytes, by the vocabulary of a tokenizers file.

    Merging follows the vocabulary's order, so the ids are those of the file's tokenizer;
    tiktoken merges several times faster. That tokenizer itself takes the chunks that
    hold a special token. It cuts before a lone space between two characters that are not
    white space, whatever else it does, so the chunks between such spaces are encoded on
    their own and remembered.
    """

    def __init__(self, path: str, ranks: dict[bytes, int], special: list[str]) -> None:
        self.path, self.special, self.whole = path, special, None
        self.merger = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        parts = text.split(" ")
        plain = [parts[0]]
        for part in parts[1:]:
            last = plain[-1]
            if part and last and not part[0].isspace() and not last[-1].isspace():
                plain.append(" " + part)
            else:
                plain[-1] = f"{last} {part}"
        return plain

    def ids(self, chunk: str) -> list[int]:
        if any(x in chunk for x in self.special):
            self.whole = self.whole or Tokenizer.from_file(self.path)
            return self.whole.encode(chunk, add_special_tokens=False).ids
        return self.merger.encode_ordinary(chunk)

    def encode(self, text: str) -> bytes:
        known, out = self.known, []
        for chunk in self.chunks(text):
            found = known.get(chunk)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = known[chunk] = array("I", self.ids(chunk)).tobytes()
            out.append(found)
        return b"".join(out)


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document; only the first may be short."""
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, ids: bool = False) -> DataFrame:
    """PIECES of every document; with ``ids`` also their token ids as bytes."""
    end = array("I", [END]).tobytes()

    path = vocabulary or public_tokenizers.path(VOCABULARY)
    ranks = {piece: n for n, piece in enumerate(merge_order(path))}  # bounded by the vocabulary
    special = special_tokens(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, ranks, special)
        for batch in batches:
            names, texts = cells(batch, "doc_id"), cells(batch, "text")
            for at in range(0, len(texts), 256):
                out = []
                for doc_id, text in zip(names[at : at + 256], texts[at : at + 256], strict=True):
                    raw, start = encoder.encode(text.decode()) + end, 0
                    for piece, length in enumerate(cut_lengths(len(raw) // 4, capacity)):
                        own = raw[4 * start : 4 * (start + length)]
                        row = {"doc_id": doc_id, "piece": piece, "start": start, "length": length, "ids_crc32": zlib.crc32(own)}
                        out.append(row | {"ids": own} if ids else row)
                        start += length
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.binary())] * ids)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    return named.mapInArrow(run, PIECES + ", ids binary" * ids)


# -- the packing of counts ------------------------------------------------------------


def reduced(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """Patterns fixed by dominance, and the counts that remain.

    A set S that holds the longest piece x dominates if any set with x that fits can be
    exchanged for S piece by piece without a loss: x alone if the shortest other piece
    does not fit beside it; x and the longest fitting y if y fills the rest exactly or
    no two other pieces fit beside x together.
    """
    left = {k: v for k, v in counts.items() if v > 0}
    fixed: list[tuple[Pattern, int]] = []
    for x in sorted(left, reverse=True):
        if not left.get(x):
            continue
        order = sorted(left)  # every change below is to the counts of x and y only
        while left.get(x):
            room = capacity - x
            if order[0] > room:
                fixed.append(((x,), left.pop(x)))
                break
            y = order[bisect_right(order, room) - 1]
            two = order[0] * 2 if left[order[0]] > 1 else order[0] + (order[1] if len(order) > 1 else capacity)
            if y == x:
                alone = left[x] == 1
                if alone or not (2 * x == capacity or two > room):
                    break
                fixed.append(((x, x), left[x] // 2))
                left[x] %= 2
                if not left[x]:
                    del left[x]
                break
            if y != room and two <= room:
                break
            n = min(left[x], left[y])
            fixed.append(((x, y), n))
            for k in (x, y):
                left[k] -= n
                if not left[k]:
                    del left[k]
                    order.remove(k)
            if not order:
                break
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit, longest first, for all pieces of a length at once.

    Open sequences are held as groups of equal pattern. A piece goes where the least
    room is left that takes it; since equal pieces follow each other, a sequence is
    filled with as many of them as it takes before the next one is chosen.
    """
    open_by_room: dict[int, list[list]] = defaultdict(list)
    rooms: list[int] = []

    def put(pattern: Pattern, n: int, room: int) -> None:
        if room not in open_by_room or not open_by_room[room]:
            insort(rooms, room)
        open_by_room[room].append([pattern, n])

    for x in sorted(counts, reverse=True):
        n = counts[x]
        while n:
            at = bisect_left(rooms, x)
            if at == len(rooms):
                per = capacity // x
                if full := n // per:
                    put((x,) * per, full, capacity - per * x)
                if rest := n % per:
                    put((x,) * rest, 1, capacity - rest * x)
                break
            room = rooms[at]
            pattern, m = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms.pop(at)
            per = min(room // x, n)
            used = min(m, n // per)
            if m > used:
                put(pattern, m - used, room)
            put(pattern + (x,) * per, used, room - per * x)
            n -= used * per
    return [(pattern, n) for groups in open_by_room.values() for pattern, n in groups]


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns of lengths, each with the number of sequences that have it."""
    fixed, left = reduced(counts, capacity)
    return fixed + best_fit(left, capacity)


def slots(patterns: list[tuple[Pattern, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, runs of ranks: first rank, first sequence, pieces a sequence, offset of the first."""
    out: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for x in dict.fromkeys(pattern):
            per = pattern.count(x)
            out[x].append((taken[x], sequence, per, offset))
            taken[x] += n * per
            offset += per * x
        sequence += n
    return {x: tuple(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) for x, rows in out.items()}


# -- dealing ------------------------------------------------------------------------


def part_of() -> Column:
    return F.pmod(F.xxhash64("row"), F.lit(RANKED_IN)).cast("int")


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank``: 0, 1, ... among the rows of equal length.

    Each length is dealt over many parts and ranked inside them, so that a length that
    a third of all pieces have is no single task's work; the sizes of the parts, one
    number each, give every part its first rank. Rows are dealt by ``row``, a number
    given when they were stored, so equal rows and those without doc_id spread alike.
    """
    dealt = rows.withColumn("part", part_of())
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("length", "part").orderBy("row"))
    both = dealt.withColumn("inside", inside).join(firsts, ["length", "part"])
    return both.withColumn("rank", F.col("first") + F.col("inside") - 1).drop("first", "inside", "part")


def packed(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """PIECES with sequence_id and offset."""
    rows = stored(pieces(docs, capacity, vocabulary).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = slots(solve(counts, capacity))  # bounded by the capacity, not by the table

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            length = columns["length"].to_numpy()
            rank = columns.pop("rank").to_numpy()
            sequence, offset = np.zeros((2, len(rank)), dtype=np.int64)
            for x in np.unique(length):
                own = np.flatnonzero(length == x)
                first, start, per, base = plan[int(x)]
                run = np.searchsorted(first, rank[own], side="right") - 1
                sequence[own] = start[run] + (rank[own] - first[run]) // per[run]
                offset[own] = base[run] + (rank[own] - first[run]) % per[run] * x
            yield pa.RecordBatch.from_pydict(columns | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    return (
        ranked(rows)
        .select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
        .mapInArrow(place, PIECES + ", sequence_id long, offset long")
    )
