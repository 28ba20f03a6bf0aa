"""Exact repeats of passages by fixed-block anchors.

The index holds each document's non-overlapping blocks of 18 words; every rolling
window of 18 words probes it. A window of 35 words always contains a whole block of
its own document, so of two equal windows each has a block that the other's document
hits with a rolling window: no repeat is missed. The blocks hit are then extended: the
windows of 35 words around them are compared with each other, and their union is the
maximal exact repeat.

Each word in a window that also starts anywhere else, in the same document too, is
removed. Null and empty texts have no words. Rows that repeat a document are other
places, so their windows are removed in both. Columns beside doc_id and text are not
read by ``repeats``; ``cleaned`` passes them on.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import Rolling
from gradeflow.llm.windows import Picked, around, buckets_for, coverage, joined, named, repeated, with_places

WINDOW = 35
WORD = re.compile(rb"[^ \t-\r]+")


def blocks(window: int):
    """Every rolling run of a block's length; the aligned ones are the index."""
    block = (window + 1) // 2

    def pick(total: np.ndarray, rolling: Rolling) -> Picked:
        runs = rolling.runs(total, block) if len(total) > window else np.empty(0, np.uint64)
        at = np.arange(len(runs))
        return at, runs, at % block == 0

    return pick


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, th, text and ``places``: starts of the windows that also start elsewhere."""
    texts = named(docs)
    n = buckets_for(docs)
    hit = with_places(texts, repeated(texts, blocks(window), n, width=6), "inner")
    starts = repeated(hit, around((window + 1) // 2 - 1, window), n, ("places",))
    return with_places(texts, starts, "left")


def kept_words(raw: bytes, places: list[bytes] | None, window: int) -> tuple[int, list[bytes]]:
    words = raw.split()
    if not places:
        return len(words), words
    gone = coverage(joined(places)[0], window, len(words))
    return len(words), [w for w, g in zip(words, gone, strict=True) if not g]


def digests(text: Column, places: Column, window: int = WINDOW) -> Column:
    """n_words, n_removed and the hash of the words that stay."""

    @F.arrow_udf("n_words long, n_removed long, kept_sha256 string")
    def of(texts: pa.Array, starts: pa.Array) -> pa.Array:
        out = []
        for raw, at in zip(texts, starts, strict=True):
            n, kept = kept_words(raw.as_py(), at.as_py(), window)
            digest = hashlib.sha256(b" ".join(kept)).hexdigest()
            out.append({"n_words": n, "n_removed": n - len(kept), "kept_sha256": digest})
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]))

    return of(text, places)


def without(raw: bytes, gone: np.ndarray) -> bytes:
    """The text without the words marked, nor the white space before each of them."""
    out, end = [], 0
    for lost, m in zip(gone, WORD.finditer(raw), strict=True):
        if not lost:
            out.append(raw[end : m.end()])
        end = m.end()
    return b"".join(out) + raw[end:]
