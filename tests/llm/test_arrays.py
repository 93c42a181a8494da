"""Tokens, hashes and parts of Arrow batches against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa

from chainlytics.llm import arrays as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def laid(texts):
    raw = [t.encode("utf-8") for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)


def texts(seed=1, n=80):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab Ä\t\nB\x0b\x1f\xa0") for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", " ", "x"]


def test_words_are_those_of_the_pattern():
    own = texts()
    data, bounds = laid(own)
    starts, ends, owner = A.words(data, bounds)
    got = [[] for _ in own]
    for s, e, o in zip(starts, ends, owner):
        got[o].append(data[s:e].tobytes().decode("utf-8"))
    assert got == [WORD.findall(t) for t in own]


def test_hashes_tell_words_apart_and_do_not_depend_on_place():
    own = texts(2)
    hashes, owner = A.word_hashes(*laid(own))
    words = [w.translate(LOW) for t in own for w in WORD.findall(t)]
    known = {}
    for h, w in zip(hashes.tolist(), words):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_runs_of_words():
    own = texts(3) + ["a b c d e", "a b c d e f", "b c d e f", "a b c"]
    hashes, owner = A.run_hashes(*A.word_hashes(*laid(own)), 5)
    want = []
    for t in own:
        w = WORD.findall(t.translate(LOW))
        want += [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []
    assert len(want) == len(hashes)
    known = {}
    for h, w in zip(hashes.tolist(), want):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_parts_cover_all_rows_and_read_null_as_empty():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "", "ü" * 10, "c"]), pa.array(range(5))], names=["text", "n"]).slice(1)
    seen = [(rows.column("n").to_pylist(), data.tobytes().decode(), (bounds - bounds[0]).tolist()) for rows, data, bounds in A.parts(batch, limit=5)]
    assert [n for p in seen for n in p[0]] == [1, 2, 3, 4] and "".join(p[1] for p in seen) == "ü" * 10 + "c"
    assert list(A.parts(batch.slice(0, 0))) == []


def test_ranges():
    assert A.ranges(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
