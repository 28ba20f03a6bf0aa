"""Clusters and codes against plain integer arithmetic."""

import hashlib
import math
import random

import numpy as np
import pytest

from gradeflow.llm import clustering, vectorcodes


def plain_rounds(vectors, centroids, rounds):
    """Assignments and centroids in Python integers."""

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for v in vectors:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)] if k in groups else c for k, c in enumerate(centroids)]
    return [nearest(v) for v in vectors], centroids


def finite(e):
    return e is not None and all(x is not None and math.isfinite(x) for x in e)


def order(row):
    return (row[0] is None, row[0] or 0)


def plain_clusters(rows):
    kept = [(i, [math.floor(64 * x) for x in e]) for i, e, _ in rows if finite(e) and len(e) == 64]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:16]
    found, centroids = plain_rounds([v for _, v in kept], [v for _, v in first], 3)
    inside = {}
    for d, k in found:
        inside[k] = inside.get(k, 0) + d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, k, d, inside[k], sum(inside.values()), digests[k]) for (i, _), (d, k) in zip(kept, found, strict=True)]


def plain_codes(rows):
    kept = [(i, [math.floor(4096 * x) for x in e], label) for i, e, label in rows if finite(e) and e and len(e) % 8 == 0]
    kept.sort(key=lambda r: (*order(r), r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    n = len(kept[0][1]) // 8
    codes, errors, books = [""] * len(kept), [0] * len(kept), []
    for p in range(8):
        parts = [v[p * n : p * n + n] for _, v, _ in kept]
        found, book = plain_rounds(parts, parts[:16], 6)
        books += [x for entry in book for x in entry]
        codes = [c + f"{k:02x}" for c, (_, k) in zip(codes, found, strict=True)]
        errors = [e + d for e, (d, _) in zip(errors, found, strict=True)]
    by_label = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    return [(i, c, e, by_label[label], digest) for (i, _, label), c, e in zip(kept, codes, errors, strict=True)]


def vectors(n, seed, scale=1.0):
    rng = random.Random(seed)
    rows = [(rng.choice([None, i, i, i, i % 7]), [rng.gauss(0, 0.3) * scale for _ in range(64)], rng.choice([None, "a", "a", "b"])) for i in range(n)]
    rows += [(1, rows[0][1], "a")] * 5  # repeated rows: ties
    rows += [(900, None, "a"), (901, [], "a"), (902, [0.0] * 64, None), (903, [None] + [1.0] * 63, "b"), (904, [float("nan")] * 64, "b")]
    rows += [(905, [float("inf")] + [0.0] * 63, "b"), (906, [1.0] * 63, "b"), (907, [1.0] * 128, "c"), (908, [-0.0] * 64, "a")]
    return rows


SCHEMA = "vec_id long, embedding array<double>, label string, cluster int, code string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize(("n", "scale"), [(90, 1.0), (3, 1.0), (60, 3000.0)])
def test_clusters(spark, rows, n, scale):
    data = vectors(n, n, scale)
    assert rows(clustering.clustered(frame(spark, data))) == sorted(plain_clusters(data), key=repr)


@pytest.mark.parametrize(("n", "scale"), [(90, 1.0), (3, 1.0), (60, 3000.0)])
def test_codes(spark, rows, n, scale):
    data = vectors(n, n + 1, scale)
    assert rows(vectorcodes.compressed(frame(spark, data))) == sorted(plain_codes(data), key=repr)


def test_empty_tables(spark):
    for rows in ([], [(1, None, None), (2, [1.0], "a")]):
        for run, width in ((clustering.clustered, 6), (vectorcodes.compressed, 5)):
            found = run(frame(spark, rows))
            assert len(found.columns) == width and found.count() == 0


def test_planes_and_limbs_are_exact():
    rng = np.random.default_rng(1)
    for bound in (1, 2, 63, 64, 65, 1 << 13, 1 << 26):
        x, c = rng.integers(-bound, bound + 1, (50, 64)), rng.integers(-bound, bound + 1, (7, 64))
        x[0], c[0] = -bound, bound
        expected = x.astype(object) @ c.astype(object).T
        words = clustering.planes_of(x)
        assert (clustering.integers(words) == x).all()
        assert (np.stack([clustering.products(words, p) for p in clustering.planes_of(c)], axis=1) == expected).all()
        assert (vectorcodes.products(x, c) == expected).all()
        for bits in (3, 11, 25):
            assert (sum(part.astype(np.int64) << (bits * i) for i, part in enumerate(vectorcodes.limbs(x, bits))) == x).all()


def test_too_long_vectors_are_refused(spark):
    data = frame(spark, [(1, [1e9] * 64, "a")])
    with pytest.raises(Exception, match="a vector of length"):
        clustering.clustered(data).collect()


def test_partitioning_changes_nothing(spark, rows):
    data = vectors(200, 8)
    assert rows(clustering.clustered(frame(spark, data, 1))) == rows(clustering.clustered(frame(spark, data, 7)))
    assert rows(vectorcodes.compressed(frame(spark, data, 1))) == rows(vectorcodes.compressed(frame(spark, data, 7)))
