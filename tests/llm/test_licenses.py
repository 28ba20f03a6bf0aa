"""Near misses of the license lines."""

import random

from gradeflow.llm import licenses
from gradeflow.llm.license_texts import TEXTS


def test_lines(spark):
    line = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    texts = {
        1: line,
        2: line.replace("hereby ", ""),  # a word less: the rest moves to the next diagonal
        3: line.replace("charge,", "charge, really"),
        4: line[:50],
        5: "to any " * 200 + "permission is not granted",
        6: "The MIT-License; apache license Apache, license!",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    assert [found[i].labels for i in range(1, 7)] == ["mit-grant", "mit-grant", "mit-grant", "", "", "apache,mit"]
    assert found[1].score == 1.0 and 0.8 <= found[2].score < 1 and found[4].score == 0
    assert (found[6].n_base, found[6].first_word, found[6].last_word, found[6].n_words) == (2, 1, 4, 6)


def labels(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.license_scan(docs).collect()}


def test_whole_texts(spark):
    assert max(len(t) for t, _, _ in licenses.TEMPLATES) > 150
    found = labels(spark, ["Copyright (c) someone\n" + t + "\nand more" for t in TEXTS.values()])
    for i, label in enumerate(TEXTS):
        assert label in found[i].labels.split(",") and found[i].score == 1.0


def test_words_out_of_order_or_strewn_are_no_copy(spark):
    line = "this source code form is subject to the terms of the mozilla public license v 2 0"
    doubled = " ".join(w + " " + w for w in line.split())
    strewn = " ".join(w + " so" * (i % 2) for i, w in enumerate(line.split()))
    mit = TEXTS["mit"].split()
    mixed = mit[:]
    random.Random(3).shuffle(mixed)
    tenth = [w for i, w in enumerate(mit) if i % 20 != 7]  # words lost on the way
    halves = mit[len(mit) // 2 :] + mit[: len(mit) // 2]
    found = labels(spark, [line, doubled, strewn, " ".join(mixed), " ".join(tenth), " ".join(halves)])
    kinds = [set(found[i].labels.split(",")) for i in range(6)]
    assert "mpl-2.0" in kinds[0] and "mpl-2.0" not in kinds[1] | kinds[2]
    assert "mit" in kinds[4] and "mit" not in kinds[3] | kinds[5]


def longest(points):
    """Plain: the longest chain that rises in both."""
    best = {}
    for at, place in sorted(set(points)):
        best[at, place] = 1 + max((n for (a, p), n in best.items() if a < at and p < place), default=0)
    return max(best.values(), default=0)


def test_chain_is_the_longest(spark):
    dice = random.Random(5)
    sets = [[(dice.randrange(30), dice.randrange(20)) for _ in range(dice.randrange(40))] for _ in range(200)]
    rows = [(i, [a * licenses.PLACES - p for a, p in points]) for i, points in enumerate(sets)]
    frame = spark.createDataFrame(rows, "i int, points array<bigint>")
    found = {r.i: r.n for r in frame.select("i", licenses.chain(frame.points).alias("n")).collect()}
    assert found == {i: longest(points) for i, points in enumerate(sets)}
