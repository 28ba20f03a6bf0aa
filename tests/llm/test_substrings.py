"""Repeats against a plain version, and what the cleaned texts keep."""

import random

from gradeflow.llm import substrings, suffixes


def plain_spans(texts, window):
    """Per document: words in a repeated window, and words in a window with an earlier place."""
    places = {}
    for doc, text in sorted(texts):
        words = text.split()
        for i in range(len(words) - window + 1):
            places.setdefault(tuple(words[i : i + window]), []).append((doc, i))
    every, later = {d: set() for d, _ in texts}, {d: set() for d, _ in texts}
    for found in places.values():
        for n, (doc, i) in enumerate(found):
            if len(found) > 1:
                every[doc] |= set(range(i, i + window))
            if n:
                later[doc] |= set(range(i, i + window))
    return every, later


def texts(seed):
    """Documents with shared passages of lengths around both windows, at odd offsets."""
    rng = random.Random(seed)
    passages = [[f"p{k}_{i}" for i in range(n)] for k, n in enumerate((34, 35, 36, 49, 50, 51, 90, 200))]
    out = []
    for doc in range(60):
        words = []
        for _ in range(rng.randrange(1, 5)):
            words += [f"r{rng.randrange(30)}" for _ in range(rng.randrange(40))]
            p = rng.choice(passages)
            a = rng.randrange(0, len(p) // 3)
            words += p[a:] if rng.random() < 0.5 else p
        out.append((doc, " ".join(words)))
    return out + [(100, "same " * 120), (101, out[0][1])]


def test_fixed_blocks(spark):
    rows = texts(1)
    every, _ = plain_spans(rows, 35)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = substrings.repeats(docs).collect()
    for r in found:
        n, kept = substrings.kept_words(r.text, r.places, 35)
        words = dict(rows)[r.doc_id].split()
        assert [w.decode() for w in kept] == [w for i, w in enumerate(words) if i not in every[r.doc_id]] and n == len(words)
    assert len(found) == len(rows)


def test_sparse_suffixes(spark):
    rows = texts(2)
    every, later = plain_spans(rows, 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    inside, gone = {d: 0 for d, _ in rows}, {d: 0 for d, _ in rows}
    for r in suffixes.spans(docs).collect():
        assert set(range(r.start_word, r.start_word + r.n_words)) <= every[r.doc_id]
        inside[r.doc_id] += r.n_words
        gone[r.doc_id] += r.n_removed
    assert inside == {d: len(x) for d, x in every.items()} and gone == {d: len(x) for d, x in later.items()}
    for r in suffixes.cleaned(docs.selectExpr("*", "0 AS n_chars", "text AS places")).collect():
        words = dict(rows)[r.doc_id].split()
        assert r.text.split() == [w for i, w in enumerate(words) if i not in later[r.doc_id]]
        assert r.n_chars == len(r.text) and r.places == dict(rows)[r.doc_id]


def test_cleaned_odd_rows(spark, rows):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(3, passage + "\n\n tail ", "a"), (2, "head\t" + passage, "b"), (2, "head\t" + passage, "b"), (None, passage, None), (4, None, "c"), (5, "", "d"), (6, "a  b\n", "e")],
        "doc_id long, text string, th string",
    )
    found = rows(suffixes.cleaned(docs))
    assert found == sorted([(3, "\n\n tail ", "a"), (2, "head\t" + passage, "b"), (2, "head\t" + passage, "b"), (None, "", None), (4, None, "c"), (5, "", "d"), (6, "a  b\n", "e")], key=repr)
    assert suffixes.cleaned(docs.where("false")).count() == 0


def test_minimisers_cover_every_window():
    import numpy as np

    runs = np.random.default_rng(5).integers(0, 40, 400).astype(np.uint64)  # many ties
    at = suffixes.minimisers(runs, 26)
    for i in range(400 - 26 + 1):
        assert any(i <= p < i + 26 and runs[p] == runs[i : i + 26].min() for p in at)
    assert set(at) == {p for i in range(375) for p in range(i, i + 26) if runs[p] == runs[i : i + 26].min()}


def test_alike_at_partition_edges():
    import pyarrow as pa

    def batch(*keys):
        n = len(keys)
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(range(n), pa.int64()), "th": pa.array([0] * n, pa.int64()), "at": pa.array(keys, pa.int32()), "key": pa.array(keys, pa.int64())})

    found = [k for b in suffixes.alike(iter([batch(1, 1, 2), batch(3, 3), batch(3, 4, 5), batch(6)])) for k in b.column("at").to_pylist()]
    assert found == [1, 1, 3, 3, 3, 6]  # the first run and the last one may go on elsewhere
