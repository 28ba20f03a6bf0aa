"""License texts by diagonal voting.

Templates are sequences of words: the base phrases, which must stand word for word, and
license lines and whole texts of any length, which may be changed a little. Every pair of
neighbouring words of a document is joined with the places of that pair in the templates.
A hit votes for its diagonal, the document position minus the template position: an
undisturbed copy gives all its votes to one diagonal, and an inserted or lost word moves
the rest to a neighbouring one. From every diagonal on, those that lie at most ``drift``
words further (one word in DRIFT of the template) are merged, so a span is never longer
than its template and that drift. A merged span with enough votes is verified by order:
the longest chain of words that rises in the document and in the template alike must hold
a share of COVER of the template's words. Words in another order, or strewn over a longer
stretch, are no copy.

The hash of a pair is exact: it is made of the numbers of both words in the templates'
vocabulary, and a word outside it has no number. Votes are counted per document,
template and diagonal with map-side sums, so a license line that a third of all rows
share meets in no task. The templates are a fixed list and thus safe to broadcast. A
diagonal has at most one vote for each place of its template, which bounds what is gathered.

Nulls and empty texts have no words. Repeated rows count one by one: rows are told apart
by a number given at the scan. Other columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeflow.llm.common import stored, utf8
from gradeflow.llm.license_texts import TEXTS

#: Phrases that count wherever their words follow each other.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Public license lines and the labels that they add.
LINES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "released under the mit license": "mit-release",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-grant",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
}
#: Share of a template's words that a span must hold in their order.
COVER = 0.8
#: One word more or less is allowed for so many words of a template, one at least.
DRIFT = 8
#: The drift of every template in units in which it can bound a window frame.
REACH = 1 << 20
#: More than the words of the longest template; a point is position * PLACES - place.
PLACES = 1 << 12

#: Lower case for A-Z, and white space for every other ASCII character that is no word character.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


TEMPLATES = [(words(t.encode()), label, True) for t, label in BASE.items()]
TEMPLATES += [(words(t.encode()), label, False) for t, label in LINES.items()]
TEMPLATES += [(words(t.encode()), label, False) for label, t in TEXTS.items()]
NUMBERS = {w: i + 1 for i, w in enumerate(sorted({w for t, _, _ in TEMPLATES for w in t}))}
SIZE = len(NUMBERS) + 1
assert all(2 <= len(t) < PLACES for t, _, _ in TEMPLATES)


def scale(size: int) -> int:
    """Units of REACH that one word of drift takes: two diagonals are near if at most REACH apart."""
    return REACH // max(1, size // DRIFT)


def hits(text: Column) -> Column:
    """n_words, and the places and hashes of all pairs whose words the templates know."""

    @F.arrow_udf("n_words long, pairs array<struct<at: int, pair: int>>")
    def of(texts: pa.Array) -> pa.Array:
        get = NUMBERS.get
        out = []
        for x in texts:
            found = words(x.as_py())
            numbers = np.fromiter((get(w, 0) for w in found), dtype=np.int64, count=len(found))
            at = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
            pairs = numbers[at] * SIZE + numbers[at + 1]
            out.append({"n_words": len(found), "pairs": [{"at": a, "pair": p} for a, p in zip(at.tolist(), pairs.tolist(), strict=True)]})
        kind = pa.struct([("n_words", pa.int64()), ("pairs", pa.list_(pa.struct([("at", pa.int32()), ("pair", pa.int32())])))])
        return pa.array(out, kind)

    return of(text)


def template_places(spark) -> DataFrame:
    """template, its length, scale, label and kind, and each pair with its place in it."""
    rows = [
        (k, len(t), scale(len(t)), label, base, i, NUMBERS[t[i]] * SIZE + NUMBERS[t[i + 1]])
        for k, (t, label, base) in enumerate(TEMPLATES)
        for i in range(len(t) - 1)
    ]
    return spark.createDataFrame(rows, "template int, size int, scale long, label string, base boolean, place int, pair int")


def chain(points: Column) -> Column:
    """Length of the longest chain of ``points`` (position * PLACES - place) that rises in both.

    In the order of the points, places of one position fall, so a chain takes one at most.
    Each length is kept with the lowest place that ends a chain of it.
    """
    places = F.transform(F.array_sort(F.array_distinct(points)), lambda p: F.pmod(-p, F.lit(PLACES)))

    def step(ends: Column, place: Column) -> Column:
        lower = F.filter(ends, lambda x: x < place)
        return F.concat(lower, F.array(place), F.slice(ends, F.size(lower) + 2, F.size(ends)))

    return F.size(F.aggregate(places, F.array().cast("array<bigint>"), step))


def spans(scanned: DataFrame) -> DataFrame:
    """row, label, base, start and score of every verified span; ``scanned`` has row and pairs."""
    places = F.broadcast(template_places(scanned.sparkSession))
    votes = (
        scanned.select("row", F.explode("pairs").alias("p"))
        .select("row", "p.at", "p.pair")
        .join(places, "pair")
        .groupBy("row", "template", "size", "scale", "label", "base", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.count("*").alias("votes"), F.collect_list("place").alias("places"))
    )
    whole = votes.where("base AND votes = size - 1").select(
        "row", "label", "base", F.col("diagonal").cast("long").alias("start"), F.lit(1.0).alias("score")
    )
    near = Window.partitionBy("row", "template").orderBy(F.col("diagonal") * F.col("scale")).rangeBetween(0, REACH)
    # a vote is for two words: both points of it
    points = F.flatten(
        F.transform(
            "places",
            lambda x: F.array(*[(F.col("diagonal") + x + i).cast("long") * PLACES - (x + i) for i in (0, 1)]),
        )
    )
    merged = (
        votes.where("NOT base")
        .withColumn("points", points)
        .select(
            "row", "label", "base", "size", F.col("diagonal").cast("long").alias("start"),
            F.sum("votes").over(near).alias("votes"), F.flatten(F.collect_list("points").over(near)).alias("points"),
        )
        .where(2 * F.col("votes") >= COVER * F.col("size"))  # fewer cannot hold enough words
    )
    lines = merged.select("row", "label", "base", "start", (chain(F.col("points")) / F.col("size")).alias("score"))
    return whole.unionByName(lines.where(F.col("score") >= COVER))


def license_scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", hits(utf8("text")).alias("h"))
    scanned = stored(numbered.select("row", "doc_id", "h.*"), "pairs")
    base = F.col("base")
    found = spans(scanned.select("row", "pairs")).groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
    )
    return scanned.select("row", "doc_id", "n_words").join(found, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
