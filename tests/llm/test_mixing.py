"""Held-out accuracy of the memberships, and rates that meet their targets."""

import numpy as np
import pytest
from plain_mixing import agrees, plain_copies, plain_memberships
from pyspark.sql import functions as F

from gradeflow.llm import mixing
from gradeflow.llm.queries import QUERIES, TARGETS, domains


def tables(spark, folder="/root/testdata/sf0.1"):
    return spark.read.parquet(f"{folder}/documents.parquet"), domains(spark, folder)


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    known = labels.where("domain IS NOT NULL")
    train, test = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0), known.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    scored = mixing.memberships(docs, mixing.fit(docs, train, 3)).join(test, "doc_id").collect()
    right = [(r.domain, int(np.argmax([r.q0, r.q1, r.q2])) == r.domain) for r in scored]
    assert len(right) > 1000 and np.mean([ok for _, ok in right]) >= 0.85
    assert np.mean([ok for domain, ok in right if domain == 0]) >= 0.98  # plain documents are left alone
    assert all(r.q0 + r.q1 + r.q2 == mixing.GRID and min(r.q0, r.q1, r.q2) >= 0 for r in scored)


def test_held_out_recall_of_each_domain(spark):
    docs, labels = tables(spark)
    known = labels.where("domain IS NOT NULL")
    train, test = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0), known.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    scored = mixing.memberships(docs, mixing.fit(docs, train, 3)).join(test, "doc_id").collect()
    told = np.zeros((3, 3), int)
    for r in scored:
        told[r.domain, int(np.argmax([r.q0, r.q1, r.q2]))] += 1
    assert (np.diag(told) / told.sum(1) >= [0.98, 0.65, 0.85]).all()
    tokens = np.array([r.n_tokens for r in scored])
    labelled = tokens[[r.domain == 2 for r in scored]].sum() / tokens.sum()
    assert (tokens * [r.q2 for r in scored]).sum() / mixing.GRID / tokens.sum() >= 0.8 * labelled


def test_shape_tells_capitals_symbols_and_repetition(spark):
    plain = "some words of a plain text that goes on, as texts do, for a line or two."
    texts = [plain, plain.upper(), plain.replace(" ", " | "), "Der " * 15, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("all", mixing.words_of())
    found = {r.doc_id: [r[x] for x in mixing.SHAPE] for r in mixing.shaped(docs).collect()}
    capitals, symbols, bars, again, variety = range(5)
    assert found[1][capitals] > found[0][capitals] == 0 and found[1][symbols] == found[0][symbols]
    assert found[2][bars] > found[0][bars] == 0 and found[2][symbols] > found[0][symbols]
    assert found[3][again] > found[0][again] == 0 and found[3][variety] < found[0][variety]
    assert found[4] == [None] * 5
    assert all(0 <= x <= mixing.BINS for i in (0, 1, 2, 3, 5) for x in found[i])


def test_rates_meet_targets(spark, small_dir):
    found = QUERIES["op7_mixing"](spark, small_dir).collect()
    tokens = np.array([r.n_tokens for r in found])
    shares = np.array([[r.p_plain, r.p_toxic, r.p_poor] for r in found])
    rates = np.array([r.rate for r in found])
    assert rates.min() >= 0
    reached = (tokens[:, None] * shares * rates[:, None]).sum(0) / tokens.sum()
    assert np.abs(reached - TARGETS).max() < 1e-5
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in found)


@pytest.mark.parametrize("targets", [[0.5, 0.5], [1.0, 0.0], [0.05, 0.95]])
def test_same_as_plain_descent(spark, targets):
    rng = np.random.default_rng(1)
    q1 = rng.integers(0, 65, 200)
    tokens = rng.integers(0, 500, 200)
    scored = spark.createDataFrame([(int(64 - q), int(q), int(t)) for q, t in zip(q1, tokens, strict=True)], "q0 int, q1 int, n_tokens long")
    steps = mixing.fit_rates(scored, targets)
    found = np.array([r.rate for r in scored.withColumn("rate", mixing.rate(steps)).collect()])
    p = np.stack([64 - q1, q1], 1) / 64
    w = tokens / tokens.sum()
    scale = 1 / (w @ p)
    rate = np.ones(200)
    for _ in range(20_000):
        rate = np.maximum(0, rate - p @ (scale * ((w * rate) @ p - targets)) * 0.3)
    miss = [float((scale * ((w * x) @ p - targets) ** 2).sum()) for x in (found, rate)]
    assert miss[0] <= miss[1] + 3e-3  # two of the three targets can't be met whole
    assert found.min() >= 0


def test_nameless_documents_round_apart(spark):
    docs = spark.createDataFrame([(None, f"text {i}", 1.25) for i in range(400)], "doc_id long, text string, rate double")
    taken = [r.n for r in docs.withColumn("th", mixing.text_hash()).select(mixing.copies().alias("n")).collect()]
    assert set(taken) == {1, 2} and abs(sum(taken) - 500) < 40


def test_resampled_keeps_columns_and_odd_rows(spark, rows):
    docs = spark.createDataFrame([(1, "good words", "a"), (1, "good words", "a"), (2, None, "b"), (None, "bad words", "c"), (3, "bad words", "d")], "doc_id long, text string, rate string")
    labels = spark.createDataFrame([(1, 0), (3, 1), (9, 1), (None, 1), (2, None)], "doc_id long, domain int")
    found = mixing.resampled(docs, labels, [1.0, 1.0])
    assert found.columns == docs.columns
    copies = {(r.doc_id, r.th): r.copies for r in mixing.mixed(docs, labels, [1.0, 1.0]).collect()}
    assert found.count() == sum(copies[d, t] for d, t in docs.select("doc_id", mixing.text_hash()).collect())
    none = labels.where("false")
    assert {r.q0 for r in mixing.mixed(docs, none, [0.5, 0.5]).collect()} == {mixing.GRID // 2}
    assert mixing.resampled(docs.where("false"), labels, [0.5, 0.5]).count() == 0


ODD = [
    (None, "plain words without a name"), (None, None), (3, None), (4, ""), (5, "..."), (5, "same id, other text"), (5, "same id, other text"),
    (-7, "WORDS | in | Capitals ## ## again again again"), (-8, "long " * 20_000 + "end."), (-9, "été Übung " * 40),
]


def test_same_as_plain_memberships_and_copies(spark, small_dir, documents):
    docs = [(d, t) for d, t in documents] + ODD
    labels = [tuple(r) for r in domains(spark, small_dir).collect()] + [(5, 2), (-8, 2), (10**12, 1), (None, 1), (4, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, domain int")
    targets = [0.6, 0.25, 0.15]
    plain = dict(zip(docs, plain_memberships(docs, labels, 3), strict=True))
    texts = frame.select("doc_id", "text", mixing.text_hash().alias("th")).distinct()
    found = mixing.mixed(frame, known, targets)
    rows = found.join(texts.withColumnRenamed("doc_id", "d"), "th").where("doc_id <=> d").collect()
    assert len(rows) >= len(docs)
    kinds, reached, total = set(), np.zeros(3), 0
    for r in rows:
        n, p = plain[r.doc_id, r.text]
        assert r.n_tokens == n and agrees([r.q0, r.q1, r.q2], p), (r, p)
        assert r.copies == plain_copies(r.doc_id, r.text, r.rate) and r.rate >= 0
        kinds.add((r.q0, r.q1, r.q2, r.rate))
    for r in found.collect():  # equal rows count as often as they are there
        reached += np.array([r.q0, r.q1, r.q2]) / mixing.GRID * r.rate * r.n_tokens
        total += r.n_tokens
        assert r.miss == rows[0].miss
    assert len({k[:3] for k in kinds}) == len(kinds) > 3  # a rate depends on the memberships alone
    assert abs(np.abs(reached / total - targets).max() - rows[0].miss) < 1e-9


def test_says_how_far_off_it_is(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, domain int")
    docs = spark.createDataFrame([(i, ("good text " if i % 2 == 0 else "bad words ") * 20) for i in range(40)], "doc_id long, text string")
    near, far = ({r.miss for r in mixing.mixed(docs, labels, t).collect()} for t in ([0.7, 0.3], [0.0, 1.0]))
    assert len(near) == len(far) == 1 and near.pop() < 1e-5
    scored = spark.createDataFrame([(64, 0, 10), (32, 32, 10)], "q0 int, q1 int, n_tokens long")
    assert mixing.descent(scored, [0.0, 1.0])[1] > 0.05 and mixing.descent(scored.where("false"), [0.5, 0.5]) == ([], 0.0)


def test_bounded_vocabulary(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"common word {'left' if i % 2 else 'right'} side{i % 2}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, domain int")
    assert mixing.fit(docs, labels, 2).weights.count() == 4
    monkeypatch.setattr(mixing, "VOCABULARY", 2)
    known = mixing.fit(docs, labels, 2)
    assert known.weights.count() == 2 and known.weights.columns == ["key", "w0", "w1"]
    assert all((r.q1 > 32) == (r.doc_id % 2 == 1) for r in mixing.memberships(docs, known).collect())
