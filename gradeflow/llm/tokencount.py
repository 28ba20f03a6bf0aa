"""Greedy word-piece lengths by a linear longest-match automaton.

A word with a leading space is cut from the left into the longest pieces of a
vocabulary. The automaton is the vocabulary's trie with a failure link for every node:
where to go on when no child fits, and how many pieces are popped on the way, both
worked out once. A word is read once, byte by byte, and no piece is ever built.

Words are runs of characters other than ASCII white space. Each Arrow batch remembers the
counts of the words it has met and runs the automaton over all new words at once, one
array operation per byte position; a hot word thus costs one look-up a place. Null and
empty texts have no words and no tokens. Repeated rows are counted one by one; other
columns are dropped.
"""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import utf8

VOCABULARY = "byte_bpe_50k.json"
#: Words remembered by a batch.
REMEMBERED = 500_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins for bytes in the vocabulary file: shown bytes stand for
    themselves, the others for the characters from 256 on, in order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def special_tokens(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        return [x["content"] for x in json.load(file)["added_tokens"]]


def vocabulary(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary file in the order of their ids, without special tokens."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {x["content"] for x in content["added_tokens"]}
    letters = byte_alphabet()
    pieces = sorted((n, piece) for piece, n in content["model"]["vocab"].items() if piece not in special)
    return [bytes(letters[c] for c in piece) for _, piece in pieces]


@dataclass
class Automaton:
    """edges: sorted node * 256 + byte; child: by edge; fail and pops: by node."""

    edges: np.ndarray
    child: np.ndarray
    fail: np.ndarray
    pops: np.ndarray

    def step(self, nodes: np.ndarray, letters: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Read one byte in each row; rows without a child pop pieces until they have one."""
        out = np.zeros(len(nodes), dtype=np.int64)
        todo = np.arange(len(nodes))
        while len(todo):
            wanted = nodes[todo] * 256 + letters[todo]
            at = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
            found = self.edges[at] == wanted
            out[todo[found]] = self.child[at[found]]
            todo = todo[~found]
            counts[rows[todo]] += self.pops[nodes[todo]]
            nodes[todo] = self.fail[nodes[todo]]
        return out

    def lengths(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        start = np.cumsum(size) - size
        order = np.argsort(-size, kind="stable")
        counts, nodes = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        live = len(words)
        ordered = -size[order]
        for i in range(int(size.max(initial=0))):
            live = int(np.searchsorted(ordered[:live], -i, side="left"))  # those longer than i
            rows = order[:live]
            nodes[rows] = self.step(nodes[rows], data[start[rows] + i].astype(np.int64), counts, rows)
        while (rest := np.flatnonzero(nodes)).size:
            counts[rest] += self.pops[nodes[rest]]
            nodes[rest] = self.fail[nodes[rest]]
        return counts


def automaton(pieces: list[bytes]) -> Automaton:
    """The trie of ``pieces`` with its links. Every single byte must be a piece, so no word fails."""
    children: list[dict[int, int]] = [{}]
    ends = {0: False}
    for piece in {*pieces, *(bytes([b]) for b in range(256))}:
        node = 0
        for letter in piece:
            if letter not in children[node]:
                children[node][letter] = len(children)
                children.append({})
            node = children[node][letter]
        ends[node] = True
    fail, pops = [0] * len(children), [0] * len(children)
    todo = deque(children[0].values())
    for node in todo:
        pops[node] = 1
    while todo:
        parent = todo.popleft()
        for letter, node in children[parent].items():
            if ends.get(node):
                fail[node], pops[node] = 0, 1
            else:
                back, popped = fail[parent], pops[parent]
                while letter not in children[back]:
                    back, popped = fail[back], popped + pops[back]
                fail[node], pops[node] = children[back][letter], popped
            todo.append(node)
    found = sorted((n * 256 + c, k) for n, own in enumerate(children) for c, k in own.items())
    edges, child = (np.array(x, dtype=np.int64) for x in zip(*found, strict=True))
    return Automaton(edges, child, np.array(fail), np.array(pops))


def counted(text: Column, pieces: Automaton) -> Column:
    """n_words and n_tokens of a column of UTF-8 bytes."""

    @F.arrow_udf("n_words long, n_tokens long")
    def of(texts: pa.Array) -> pa.Array:
        known: dict[bytes, int] = {}
        out = []
        for at in range(0, len(texts), 256):
            split = [x.as_py().split() for x in texts[at : at + 256]]
            if len(known) > REMEMBERED:
                known = {}
            new = list(set().union(*split) - known.keys())
            for i in range(0, len(new), 1 << 16):
                part = new[i : i + (1 << 16)]
                known.update(zip(part, pieces.lengths([b" " + w for w in part]).tolist(), strict=True))
            out += [{"n_words": len(w), "n_tokens": sum(map(known.__getitem__, w))} for w in split]
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_tokens", pa.int64())]))

    return of(text)


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_words and n_tokens of every row of ``docs``."""
    pieces = automaton(vocabulary(path or public_tokenizers.path(VOCABULARY)))
    return docs.select("doc_id", counted(utf8("text"), pieces).alias("t")).select("doc_id", "t.*")
