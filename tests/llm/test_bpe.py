"""Ids and decoded texts against the tokenizers library."""

import hashlib
import random
import re
from array import array

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gradeflow.llm import bpe
from gradeflow.llm.queries import QUERIES

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    made = bpe.Encoder(bpe.Pieces(PATH))
    made.list = lambda text: array("i", bytes(made.ids(text))).tolist()
    return made


def digest(data):
    return hashlib.sha256(data).hexdigest()


def test_whole_table(spark, small_dir, documents, library):
    expected = {}
    for doc_id, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        expected[doc_id] = (len(ids), digest(b"".join(i.to_bytes(4, "little") for i in ids)), digest(shown.encode()))
    found = QUERIES["op11_bpe"](spark, small_dir).collect()
    assert len(found) == len(documents)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected


POOLS = [
    "aabbxyzing ", "the'sS 'reLLd'VE ", "éÉßſẞΣσςİıǅ̧́̈", "0123456789٣४", "!?#$%&<>|", "\t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　​",
    "漢字かなカナ한국어", "😀🏽👨‍👩🇩🇪", "Ɤ\U00010d50\U0001e4ed따가ཀ", "Ͱ΀ΆЁё҃Ԥ",
]


def test_random_texts(library, encoder):
    rng = random.Random(11)
    for _ in range(6000):
        pools = [rng.choice(POOLS) for _ in range(rng.randrange(1, 4))]
        text = "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(30)))
        if rng.random() < 0.2:
            text = text[:5] + rng.choice(["<|startoftext|>", "<|endoftext|>", "<|endoftext|", "<|EndOfText|>"]) + text[5:]
        assert encoder.list(text) == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("letters", ["ab", "ha", "aeinrst", "lo", "the", "abcdefghijklmnopqrstuvwxyz"])
def test_long_words(library, encoder, letters):
    rng = random.Random(letters)
    for n in (1, 2, 3, 30, 300, 3000, 100_000):
        word = "".join(rng.choice(letters) for _ in range(n))
        assert encoder.list(word) == library.encode(word, add_special_tokens=False).ids


def test_pairs_agree_with_merging(library, encoder):
    """Two pieces may stand side by side exactly if their letters, merged, give the two."""
    pieces, rng = encoder.pieces, random.Random(5)
    names = {n: pieces.shown[n].removesuffix("</w>") for n in pieces.letters}
    plain = [n for n, name in names.items() if re.fullmatch("[a-z]+", name)]
    inner = [n for n in plain if pieces.shown[n] == names[n]]
    ends = [n for n in plain if pieces.shown[n] != names[n]]
    for _ in range(4000):
        a, b = rng.choice(inner), rng.choice(ends)
        word = names[a] + names[b]
        assert pieces.side_by_side(a, b) == (library.encode(word, add_special_tokens=False).ids == [a, b])


def test_odd_rows(spark, library):
    texts = [(1, None), (2, ""), (3, " \t\n"), (None, "Same text"), (None, "Same text"), (4, "x" * 300_000), (4, "<|endoftext|> b <|startoftext|>")]
    docs = spark.createDataFrame([(i, t, [1], "e") for i, t in texts], "doc_id long, text string, ids array<int>, encoded string")
    found = bpe.encoded(docs.repartition(3)).select("doc_id", "ids", bpe.decoded(F.col("ids")).alias("shown")).collect()
    expected = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in texts]
    expected = sorted(((i, x, library.decode(x, skip_special_tokens=False)) for i, x in expected), key=repr)
    assert sorted(((r.doc_id, r.ids, r.shown) for r in found), key=repr) == expected


def test_decoding_leaves_out_unknown_ids(spark, library):
    rows = [([320, 70000, -1, 530],), ([],), (None,), ([49406, 0],)]
    found = spark.createDataFrame(rows, "ids array<int>").select(bpe.decoded(F.col("ids")).alias("t"), bpe.ids_digest(F.col("ids")).alias("d")).collect()
    assert [r.t for r in found] == [library.decode([320, 70000, 530], skip_special_tokens=False), "", None, library.decode([49406, 0], skip_special_tokens=False)]
    assert found[1].d == digest(b"") and found[2].d is None
