"""Ids and decoded texts against the library, and tree concatenation against whole words."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from chainlytics.llm import bpe as B
from chainlytics.llm.tokens import load, plain

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return load(PATH)


def test_words_and_ids_are_those_of_the_library(library):
    coder, rng = B.coder_of(PATH), random.Random(5)
    letters = [chr(c) for c in range(0x250)] + list("中文Σςé́ñ＃😀１²") + ["<|endoftext|>", "<|start"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) if rng.random() < 0.4 else rng.choice("abcdethe'sT 1\n\t\x1c\x85\xa0") for _ in range(rng.randint(0, 14)))
        if plain(text):
            got = [i for w in B.WORD.findall(text.lower()) for i in np.frombuffer(coder.memo[w], "<u4").tolist()]
        else:
            got = [i for p in coder.split(text) for i in ([p] if isinstance(p, int) else coder.merge(p))]
        assert got == library.encode(text, add_special_tokens=False).ids


def test_halves_join_to_the_whole_word():
    coder, rng = B.coder_of(PATH), random.Random(7)
    kinds = [
        lambda: "".join(rng.choice("abcdeth") for _ in range(rng.randint(2, 400))),
        lambda: "".join(rng.choice(["theory", "ation", "un", "believ", "able", "s"]) for _ in range(rng.randint(2, 60))),
        lambda: rng.choice(["a", "ab", "ha", "the", "aaab"]) * rng.randint(2, 200),
        lambda: "!" * rng.randint(2, 90) + "¡?" * rng.randint(0, 40),
    ]
    for _ in range(300):
        word = rng.choice(kinds)().encode("utf-8").decode("latin-1").translate(coder.characters)
        pieces = B.segments(word, rng.choice([3, 7, 16, 50]))
        assert "".join(pieces) == word
        assert coder.tree([coder.merge(p, k == len(pieces) - 1) for k, p in enumerate(pieces)]) == coder.merge(word)


def digest(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode("utf-8")).hexdigest()


@pytest.mark.parametrize("long_words", [False, True])
def test_whole_texts(spark, library, long_words):
    rng = random.Random(9)
    rows = [(n, " ".join(rng.choice(["The", "Ünd", "x12", "don't", "中文", "<|endoftext|>", "…"]) for _ in range(rng.randint(0, 40)))) for n in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (None, "no id"), (103, "same"), (103, "same"), (104, "the " * 20_000)]
    if long_words:
        rows += [(200, "ab" * 30_000 + " end"), (201, "x <|endoftext|> " + "中" * 9_000 + " y " + "".join(rng.choice("thequickbrown") for _ in range(40_000)) + "!" * 9_000), (202, "É" * 10_000)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, ids int").repartition(4)
    coded = B.encode(docs, PATH)
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.round_trip(coded, PATH).collect())
    assert got == sorted((str(d), *digest(library, t)) for d, t in rows)
    texts = sorted((str(r.doc_id), r.text) for r in B.decode(coded, PATH).collect())
    assert [hashlib.sha256(t.encode("utf-8")).hexdigest() for _, t in texts] == [h for *_, h in sorted((str(d), library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False), digest(library, t)[2]) for d, t in rows)]


def test_no_character_is_longer_than_the_widest(library):
    # The byte-level part makes one character a byte, so the lengths of the pieces are bytes of normalised text.
    coder = B.coder_of(PATH)
    sizes = [sum(len(p) for p in coder.split(chr(c)) if not isinstance(p, int)) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert max(sizes) == B.WIDEST


@pytest.mark.parametrize("note, times", [(0x1D15E, 1_100), (0x1D15E, 2_000), (0x1D160, 700)])
def test_words_that_normalising_makes_long(spark, library, note, times):
    rows = [(1, "some words " * 200 + chr(note) * times + " end"), (2, "short"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.round_trip(B.encode(docs, PATH), PATH).collect())
    assert got == [(d, *digest(library, t)) for d, t in rows]


def test_an_empty_table(spark):
    assert B.round_trip(B.encode(spark.createDataFrame([], "doc_id bigint, text string"), PATH), PATH).count() == 0
