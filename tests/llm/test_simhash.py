"""Fingerprints and components against a plain version that compares all pairs."""

import random

import xxhash

from gradeflow.llm import simhash
from gradeflow.llm.queries import QUERIES


def plain_fingerprint(text):
    data = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in data.translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable over pairs at distance three or less."""
    best = {i: i for i in prints}
    near = {a: [b for b in prints if (prints[a] ^ prints[b]).bit_count() <= 3] for a in prints}
    for start in sorted(prints):
        todo = [start] if best[start] == start else []
        while todo:
            for b in near[todo.pop()]:
                if best[b] > start:
                    best[b] = start
                    todo.append(b)
    return best


def test_whole_table(spark, small_dir, documents):
    prints = {i: plain_fingerprint(t) for i, t in documents}
    best = plain_components(prints)
    found = QUERIES["op6_simhash_near_dedup"](spark, small_dir).collect()
    assert {(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in found} == {(i, prints[i], best[i]) for i in prints}
    assert all(len(r.fingerprint) == 16 for r in found) and len(found) == len(documents)
    assert len(set(best.values())) < len(best)


def test_edges_in_dense_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "DENSE", 4)
    rng = random.Random(3)
    base = rng.getrandbits(64)
    prints = {base}
    while len(prints) < 300:
        prints.add(rng.choice(sorted(prints)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.getrandbits(64) if rng.random() < 0.3 else 0))
    ids = sorted(prints)
    classes = spark.createDataFrame([(simhash.signed(p), i) for i, p in enumerate(ids)], "fp long, rep long")
    found = {frozenset(r) for r in simhash.near_edges(classes).collect()}
    expected = {frozenset((i, j)) for i in range(300) for j in range(i) if (ids[i] ^ ids[j]).bit_count() <= 3}
    assert found == expected and len(expected) > 150


def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (None, "a b c d", "y"), (4, "a b c d", None), (5, "A B c D", "z"), (5, "A B c D", "z"), (6, "lone", "z")],
        "doc_id long, text string, component_id string",
    )
    found = rows(simhash.near_duplicates(docs), "doc_id", "component_id")
    assert found == sorted([(1, 1), (2, 1), (3, 1), (None, None), (4, 4), (5, 4), (5, 4), (6, 6)], key=repr)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == sorted([(1,), (4,), (6,), (None,)], key=repr)
    empty = docs.where("false")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_per_group(empty).count() == 0
