"""Repeated strings against counting all windows; the suffix array and common prefixes against sorting."""

import collections
import hashlib
import random

import numpy as np
import pytest

from chainlytics.llm import repeats as R

WORDS = ["the", "of", "and", "ention", "ther", "thing", "stan", "éeau", "Ünd", "to", "in", "zu", "ß"]


def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(2)
    for _ in range(120):
        raw = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 200))) + (b"abcabc" * 20 if rng.random() < 0.3 else b"")
        text = np.frombuffer(raw, dtype=np.uint8)
        want = sorted(range(len(raw)), key=lambda k: raw[k:])
        order = R.suffix_array(text)
        assert order.tolist() == want
        shared = []
        for a, b in zip([None, *want], want):
            n = 0
            while a is not None and a + n < len(raw) and b + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            shared.append(n)
        if raw:
            assert R.common_prefixes(text, order).tolist() == shared


def spans_of(texts, length):
    counts = collections.Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if counts[t[s : s + length]] > 1:
                mark[s : s + length] = b"\1" * length
        edges = [s for s in range(len(t)) if mark[s] and (s == 0 or not mark[s - 1])]
        out.append([(s, next((e for e in range(s, len(t)) if not mark[e]), len(t))) for s in edges])
    return out


def case():
    rng = random.Random(3)

    def prose(n):
        return " ".join(rng.choice(WORDS) for _ in range(n))

    passages = [prose(60) for _ in range(6)]
    docs = [(n, prose(rng.randint(0, 80)) + rng.choice(passages)[rng.randint(0, 40) :] + prose(rng.randint(0, 60))) for n in range(120)]
    return docs + [(500, None), (501, ""), (502, "ab" * 600), (503, "Orre " * 200), (None, passages[0]), (504, passages[1]), (504, passages[1]), (505, "x" * 199), (506, "y" * 200), (507, "y" * 200), (508, "z" * 201)]


@pytest.mark.parametrize("most, shard", [(R.MOST, R.SHARD), (8, 3_000)])
def test_all_repeated_strings_of_a_corpus(spark, most, shard):
    docs = case()
    raw = [(t or "").encode("utf-8") for _, t in docs]
    frame = spark.createDataFrame([(d, t, 7) for d, t in docs], "doc_id bigint, text string, spans int").repartition(3)
    found = R.marked(frame, 200, most, shard)
    want = spans_of(raw, 200)
    got = sorted((str(r.doc_id), (r.text or "").encode("utf-8"), [tuple(s) for s in r.spans]) for r in found.collect())
    assert got == sorted((str(d), t, s) for (d, _), t, s in zip(docs, raw, want))
    rows = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.digests(found).collect())
    plain = []
    for (d, _), t, s in zip(docs, raw, want):
        gone = {k for a, b in s for k in range(a, b)}
        plain.append((str(d), len(t), len(gone), len(s), hashlib.sha256(bytes(c for k, c in enumerate(t) if k not in gone)).hexdigest()))
    assert rows == sorted(plain)


def test_texts_stay_valid_when_cut(spark):
    shared = "é" * 150
    docs = [(1, "aé" + shared + "ü1", "s"), (2, "bü" + shared + "ä2", "t"), (3, None, "u"), (4, "short", None)]
    got = {r.doc_id: (r.text, r.source) for r in R.without_repeats(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).collect()}
    assert got[1][0].startswith("a") and got[1][0].endswith("1") and len(got[1][0]) < 6 and got[1][1] == "s"
    assert got[3] == (None, "u") and got[4] == ("short", None)


def test_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert R.marked(none).count() == 0 and R.without_repeats(none).count() == 0
