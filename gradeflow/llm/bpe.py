"""Exact byte-pair ids of whole texts by one table entry per prefix, and texts from ids.

Pair merging gives every string one list of pieces, and a prefix of a string has a unique
last piece. A word is therefore read once: an automaton over the vocabulary reports the
pieces that end at each place, and the one that may stand behind the last piece of the
prefix before it is stored. The stored pieces, followed back from the end, are the ids;
nothing is merged. Two pieces may stand side by side if no merge reaches over their border
before both are complete, which the halves along the border tell (:meth:`Pieces.side_by_side`).

The vocabulary file is one of the tokenizers library: byte letters, a mark on a word's last
letter, and a normalizer and pattern that cut texts into words. Letters with and without
the mark are different letters, so the words' ends need no rule of their own. Texts of
characters that have long been in Unicode are cut here; others are cut by the file's own
normalizer and pattern, since the libraries' Unicode tables differ in age.

Null and empty texts have no ids, and no ids are an empty text. Special tokens that stand
in a text become their ids. Rows are taken one by one, so repeated and nameless rows come
back as often as they occur; words of any length take time and memory in proportion.
Columns other than doc_id and text are dropped.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gradeflow.llm.common import cells, utf8
from gradeflow.llm.tokencount import byte_alphabet

VOCABULARY = "word_bpe_49k.json"
#: Words remembered by a task, and the longest of them.
REMEMBERED, LONGEST = 250_000, 64
#: Texts handled at a time.
TEXTS = 256
#: Added to a byte for the letter at the end of a word.
LAST = 256
NEVER = 1 << 62
#: Normalisation that the cutting below does; a file that asks for another is refused.
STEPS = ["NFC", "Replace", "Lowercase"]
#: Characters whose case, composition and class are the same in all Unicode tables in use.
RECENT = re.compile("[^\x00-ԯḀ-ỿ - ₠-₺、-〩ぁ-ゖァ-ヺ一-龥]")


class Pieces:
    """The pieces of a vocabulary file, the halves they are made of, and who may stand beside whom."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, normalizer = content["model"], content["normalizer"]
        split, level = content["pre_tokenizer"]["pretokenizers"]
        if [x["type"] for x in normalizer["normalizers"]] != STEPS or level["type"] != "ByteLevel":
            raise ValueError(f"{path}: texts are cut in a way that is not known here")
        self.file, self.pattern = path, split["pattern"]["Regex"]
        self.special = {x["content"]: x["id"] for x in content["added_tokens"]}
        ids: dict[str, int] = model["vocab"]
        self.shown = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for name, n in [*ids.items(), *self.special.items()]:
            self.shown[n] = name
        bytes_of, mark = byte_alphabet(), model["end_of_word_suffix"]
        self.letters: dict[int, str] = {}
        for name, n in ids.items():
            body = [bytes_of[c] for c in name.removesuffix(mark)]
            if name.endswith(mark):
                body[-1] += LAST
            self.letters[n] = "".join(map(chr, body))
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            a, b, whole = ids[left], ids[right], ids[left + right]
            if whole in self.halves or max(self.halves.get(x, (0, 0, -1))[2] for x in (a, b)) >= rank:
                raise ValueError(f"{path}: merges are not in the order in which pieces arise")
            self.rank[a, b], self.halves[whole] = rank, (a, b, rank)
        if any(len(x) > 1 and n not in self.halves for n, x in self.letters.items()):
            raise ValueError(f"{path}: pieces that no merge makes")
        self.edges: tuple[dict, dict] = {}, {}
        self.known: dict[tuple[int, int], bool] = {}

    def edge(self, piece: int, side: int) -> list[tuple[int, int]]:
        """The parts of ``piece`` that touch its left (0) or right (1) end, each with the rank that ends it."""
        found = self.edges[side].get(piece)
        if found is None:
            found, part, end = [], piece, NEVER
            while True:
                found.append((part, end))
                if part not in self.halves:
                    break
                end = self.halves[part][2]
                part = self.halves[part][side]
            self.edges[side][piece] = found
        return found

    def over_border(self, a: int, b: int) -> list[int]:
        """Ranks of the merges that reach over the border between ``a`` and ``b``.

        Ranks are worked off in order. Parts x and y that touch the border merge if their
        rank comes before that which ends x. It may equal that which ends y: of equal
        neighbours the left ones merge first.
        """
        return [
            rank
            for x, x_end in self.edge(a, 1)
            for y, y_end in self.edge(b, 0)
            if (rank := self.rank.get((x, y), NEVER)) < x_end and rank <= y_end and rank < NEVER
        ]

    def side_by_side(self, a: int, b: int) -> bool:
        found = self.known.get((a, b))
        if found is None:
            if len(self.known) >= 2 * REMEMBERED:
                self.known.clear()
            found = self.known[a, b] = not self.over_border(a, b)
        return found

    def automaton(self) -> ahocorasick.Automaton:
        """Finds the pieces that merging can arrive at; a piece can be shadowed by others."""
        found, reached = ahocorasick.Automaton(), set()
        for n in sorted(self.letters, key=lambda n: self.halves.get(n, (0, 0, -1))[2]):
            if n in self.halves:
                a, b, rank = self.halves[n]
                if not {a, b} <= reached or self.over_border(a, b) != [rank]:
                    continue
            reached.add(n)
            found.add_word(self.letters[n], (n, len(self.letters[n])))
        found.make_automaton()
        return found


class Encoder:
    """Ids of texts; remembers those of words."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces, self.automaton = pieces, pieces.automaton()
        self.words = regex.compile(pieces.pattern).findall
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(pieces.special, key=len, reverse=True))) + ")")
        self.size = {n: len(x) for n, x in pieces.letters.items()}
        self.own: Tokenizer | None = None
        self.bytes_of = byte_alphabet()
        self.known: dict[str, bytes] = {}

    def cut(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        if RECENT.search(text) is None:
            return self.words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        if self.own is None:
            self.own = Tokenizer.from_file(self.pieces.file)
        found = self.own.pre_tokenizer.pre_tokenize_str(self.own.normalizer.normalize_str(text))
        return [bytes(map(self.bytes_of.__getitem__, word)).decode() for word, _ in found]

    def merged(self, word: bytes) -> bytes:
        """Ids of one word, four bytes each, by the last piece of each of its prefixes."""
        letters = word[:-1].decode("latin-1") + chr(word[-1] + LAST)
        last, side_by_side = array("i", [-1]) * (len(letters) + 1), self.pieces.side_by_side
        for end, (piece, size) in self.automaton.iter(letters):
            if last[end + 1] < 0:
                before = end + 1 - size
                if not before or (last[before] >= 0 and side_by_side(last[before], piece)):
                    last[end + 1] = piece
        out, at = array("i"), len(letters)
        while at:
            out.append(last[at])
            at -= self.size[last[at]]
        out.reverse()
        return out.tobytes()

    def ids(self, text: str) -> bytearray:
        """Ids of a text, four bytes each."""
        out, known = bytearray(), self.known
        for part in self.special.split(text) if "<" in text or not text.isascii() else [text]:
            if part in self.pieces.special:
                out += array("i", [self.pieces.special[part]]).tobytes()
                continue
            for word in self.cut(part):
                found = known.get(word)
                if found is None:
                    found = self.merged(word.encode())
                    if len(word) <= LONGEST:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[word] = found
                out += found
        return out


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array<int>) of every row of ``docs``."""
    pieces = Pieces(path or public_tokenizers.path(VOCABULARY))  # bounded by the vocabulary
    named = docs.select("doc_id", utf8("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(pieces)
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                flat, ends = bytearray(), [0]
                for text in cells(part, "text"):
                    flat += encoder.ids(text.decode("utf-8", "replace"))
                    ends.append(len(flat) // 4)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    kind = named.schema["doc_id"].dataType.simpleString()
    return named.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decoded(ids: Column, path: str | None = None) -> Column:
    """The text of a column of ids: what the pieces are called, with blanks between them.

    That is how the library puts pieces together for a file that names no decoder. Ids that
    the vocabulary lacks are left out; null ids give null.
    """
    shown = Pieces(path or public_tokenizers.path(VOCABULARY)).shown

    @F.arrow_udf("string")
    def of(column: pa.Array) -> pa.Array:
        names, out = pa.array(shown), []
        for at in range(0, len(column), TEXTS):
            part = column.slice(at, TEXTS)
            flat = pc.fill_null(part.flatten(), -1).to_numpy()
            have = (flat >= 0) & (flat < len(shown))
            ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(part), 0).to_pylist()])
            ends = np.concatenate(([0], np.cumsum(have)))[ends]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), names.take(pa.array(flat[have])))
            out.append(pc.if_else(pc.is_valid(part), pc.binary_join(lists, " "), None))
        return pa.concat_arrays(out) if out else pa.array([], pa.string())

    return of(ids)


def ids_digest(ids: Column) -> Column:
    """Lower-case hex SHA-256 of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("string")
    def of(column: pa.Array) -> pa.Array:
        raw = (x.values.to_numpy().astype("<i4").tobytes() if x.is_valid else None for x in column)
        return pa.array([None if x is None else hashlib.sha256(x).hexdigest() for x in raw], pa.string())

    return of(ids)
