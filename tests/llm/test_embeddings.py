"""Graphs and components of vectors against brute force."""

import io
import uuid

import numpy as np
import pytest

from gradeflow.llm import embeddings
from gradeflow.llm.annindex import Graph


def clustered(n, seed, dim=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, dim))
    points = centres[rng.integers(0, len(centres), n)] + 0.02 * rng.normal(size=(n, dim))
    points[: n // 3] = centres[0] + 0.03 * rng.normal(size=(n // 3, dim))  # a third of all rows
    return points


def test_audited_search_finds_all():
    points = clustered(3000, 1)
    vectors = points / np.linalg.norm(points, axis=1, keepdims=True)
    truth = vectors @ vectors.T >= 0.98
    found = embeddings.audited(vectors, vectors, np.arange(3000), 0.98)
    assert sum(map(len, found)) >= 0.999 * truth.sum()
    assert all(truth[i, x].all() for i, x in enumerate(found))
    apart = embeddings.audited(vectors[:1500], vectors[1500:], np.full(1500, -1), 0.98)
    assert sum(map(len, apart)) >= 0.999 * truth[1500:, :1500].sum()


def test_audit_weighs_queries(monkeypatch):
    points = clustered(3000, 4)
    vectors = points / np.linalg.norm(points, axis=1, keepdims=True)
    truth = embeddings.audit(vectors, vectors, np.arange(3000), 0.98)
    assert len(truth) >= embeddings.LINKED
    everything = [np.flatnonzero(vectors @ v >= 0.98) for v in vectors]
    assert all((np.isin(t, everything[i])).all() and i not in t for i, t in truth.items())
    few = [x if len(x) > 500 else np.array([i]) for i, x in enumerate(everything)]  # all but the large group finds itself only
    whole, links = embeddings.recall(few, truth)
    assert whole < 0.9 and links > 0.9
    rare = np.vstack([np.eye(600), np.eye(600)[:1]])  # one pair among 601
    assert set(embeddings.audit(rare, rare, np.arange(601), 0.98)) == {0, 600}


def test_stored_graph_searches_alike():
    vectors = np.random.default_rng(6).normal(size=(1500, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = Graph(vectors)
    again = Graph.loaded(vectors, dict(np.load(io.BytesIO(graph.saved()))))
    queries = vectors[:100].astype(np.float32)
    assert (graph.search(queries, 32)[0] == again.search(queries, 32)[0]).all()


@pytest.mark.parametrize("gather", [1, 3])
def test_each_graph_is_built_once(spark, tmp_path, monkeypatch, gather):
    plain = embeddings.build

    def counted(group):
        (tmp_path / uuid.uuid4().hex).touch()
        return plain(group)

    monkeypatch.setattr(embeddings, "build", counted)
    monkeypatch.setattr(embeddings, "GATHER", gather)
    rows = [(i, x.tolist(), 0) for i, x in enumerate(clustered(500, 3, 8).astype(np.float32))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = embeddings.near_duplicates(frame, shard_rows=100)
    assert sorted(tuple(r) for r in found.collect()) == sorted(tuple(r) for r in embeddings.near_duplicates(frame).collect())
    assert len(list(tmp_path.iterdir())) == 5 + 1


def test_recall_of_plain_search():
    vectors = np.random.default_rng(2).normal(size=(2000, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ids, _ = Graph(vectors).search(vectors[:200].astype(np.float32), 64)
    truth = np.argsort(-(vectors[:200] @ vectors.T), axis=1)[:, :10]
    assert np.mean([len(set(a[:64]) & set(b)) / 10 for a, b in zip(ids, truth, strict=True)]) >= 0.9


@pytest.mark.parametrize("shard_rows", [100_000, 150])
def test_components(spark, shard_rows):
    points = clustered(500, 3, 8).astype(np.float32)
    rows = [(i, x.tolist(), i % 2) for i, x in enumerate(points)]
    rows += [(900 + i, points[7].tolist(), 1) for i in range(5)]
    special = [(1000, None, 0), (1001, [0.0] * 8, 0), (1002, [1.0, None] * 4, 0), (1003, [float("nan")] * 8, 0), (1004, points[7].tolist(), None), (None, points[7].tolist(), 1), (1005, points[7][:4].tolist(), 1), (1006, [float("inf")] * 8, 1), (1007, [], 1)]
    frame = spark.createDataFrame(rows + special, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS n", "'x' AS key")
    found = {r.vec_id: r for r in embeddings.near_duplicates(frame, shard_rows=shard_rows).collect()}
    ids = [r[0] for r in rows]
    wide = np.array([r[1] for r in rows], dtype=np.float64)
    wide /= np.linalg.norm(wide, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows])
    link = (wide @ wide.T >= 0.98) & (labels[:, None] == labels[None, :])
    best = list(range(len(ids)))
    for _ in range(len(ids)):
        new = [min(ids_of) for ids_of in ([best[j] for j in np.flatnonzero(link[i])] for i in range(len(ids)))]
        if new == best:
            break
        best = new
    for i, vec_id in enumerate(ids):
        r = found[vec_id]
        assert (r.n_links, r.component_id, r.kept) == (link[i].sum() - 1, ids[best[i]], vec_id == ids[best[i]])
    for vec_id, _, _ in special:
        assert found[vec_id].n_links == 0 and found[vec_id].component_id == vec_id
    assert len(found) == len(rows) + len(special)


def test_empty(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
