"""Piece counts against a plain greedy search."""

import random

import public_tokenizers

from gradeflow.llm import tokencount
from gradeflow.llm.queries import QUERIES


def greedy(word, pieces):
    longest, at, n = max(map(len, pieces)), 0, 0
    while at < len(word):
        end = min(len(word), at + longest)
        while word[at:end] not in pieces:
            end -= 1
        at, n = end, n + 1
    return n


def test_small_vocabulary():
    rng = random.Random(2)
    for _ in range(30):
        pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 7))) for _ in range(8)]
        known = {*pieces, *(bytes([b]) for b in range(256))}
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 20))) for _ in range(40)]
        found = tokencount.automaton(pieces).lengths(words)
        assert found.tolist() == [greedy(w, known) for w in words]


def test_whole_table(spark, small_dir, documents):
    pieces = set(tokencount.vocabulary(public_tokenizers.path(tokencount.VOCABULARY)))
    assert len(pieces) == 50256 and all(bytes([b]) in pieces for b in range(256))
    known = {}
    expected = {}
    for doc_id, text in documents:
        words = (text or "").encode().split()
        for w in words:
            if w not in known:
                known[w] = greedy(b" " + w, pieces)
        expected[doc_id] = (len(words), sum(known[w] for w in words))
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in QUERIES["op9_token_counts"](spark, small_dir).collect()} == expected


def test_odd_rows(spark, rows):
    docs = spark.createDataFrame([(1, None, 0), (2, " ", 0), (None, "the the", 0), (3, "z" * 50000, 0), (3, "z" * 50000, 0)], "doc_id long, text string, n_tokens int")
    found = rows(tokencount.token_counts(docs))
    assert [r for r in found if r[0] != 3] == sorted([(1, 0, 0), (2, 0, 0), (None, 2, 2)], key=repr)
    assert len({r for r in found if r[0] == 3}) == 1 and len(found) == 5
