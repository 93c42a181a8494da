"""Language-model scores: counts and base scores against plain Python, normalisation, and edge rows."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from chainlytics.llm import language as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(600)] + ["The", "the", "of", "Ünd", "x" * 300]
    weights = [1 / (k + 1) for k in range(len(words))]
    out = [(n, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for n in range(200)]
    return out + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "same"), (1003, "same"), (None, "no id known of"), (1004, "the " * 20_000), (1005, "never seen before words" + str(zlib.crc32(b"x")))]


def plain(docs):
    held = {n: zlib.crc32(str(n).encode()) % 7 == 2 for n, _ in docs if n is not None}
    tokens = [(n, held.get(n, False), WORD.findall((t or "").translate(LOW)) + [None]) for n, t in docs]
    counts = collections.Counter(w for _, h, own in tokens if not h for w in own)
    total, size = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    return sorted((str(n), h, len(own), sum(counts[w] > 0 for w in own), total, round(sum(math.log10((counts[w] + 1) / size) for w in own), 5)) for n, h, own in tokens)


@pytest.mark.parametrize("partitions", [1, 4])
def test_counts_and_base_scores(spark, partitions):
    docs = spark.createDataFrame(rows(), "doc_id bigint, text string").repartition(partitions)
    got = M.score(docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == plain(rows())
    assert all(r.score < 0 for r in got)


def test_probabilities_add_up_to_one():
    texts = [t.encode("utf-8") for _, t in rows() if t][:150]
    model = M.train(texts)
    contexts = np.random.default_rng(1).integers(0, M.CLASSES + 1, (500, M.CONTEXT))
    assert np.allclose((10.0 ** model.log10(contexts)).sum(axis=1), 1, atol=1e-4)


def test_all_known_tokens_and_the_unknown_add_up_to_one(spark):
    docs = [(n, t) for n, t in rows()[:120]]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    known = sorted({w for n, t in docs if zlib.crc32(str(n).encode()) % 7 != 2 for w in WORD.findall(t.translate(LOW))})
    single = next(n for n in range(5000, 6000) if zlib.crc32(str(n).encode()) % 7 == 2)
    # One-word texts under one held-out id: the words' scores share the end's, so their ratios are those of the words.
    probes = known + [f"unknown{k}" for k in range(300)]
    both = frame.unionByName(spark.createDataFrame([(single, w) for w in probes], "doc_id bigint, text string"))
    model = M.fitted(frame.where("crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2"))
    order = np.array([M.BEFORE, M.BEFORE])
    classes = {}
    for w in probes:
        raw = np.frombuffer(w.encode(), dtype=np.uint8)
        classes[w] = int(M.sequences(model, raw, np.array([0, len(raw)]))[0][0])
    first = model.log10(order[None])[0]
    after = {c: model.log10(np.array([[c, M.BEFORE]]))[0][M.END] for c in set(classes.values())}
    # The query's own model is fitted on the same rows, so the class parts can be taken off its scores.
    got = M.score(both).where(f"doc_id = {single}").collect()
    assert len(got) == len(probes)
    inside = collections.defaultdict(float)
    by_score = sorted(r.score for r in got)
    want = []
    counts = collections.Counter(w for n, t in docs if zlib.crc32(str(n).encode()) % 7 != 2 for w in WORD.findall(t.translate(LOW)))
    size = collections.Counter()
    for w in known:
        size[classes[w]] += counts[w] + 1
    for w in probes:
        c = classes[w]
        share = 1.0 if c < M.FIRST_RARE else (counts[w] + 1) / (size[c] + 1)
        want.append(first[c] + math.log10(share) + after[c])
        if w in counts:
            inside[c] += share
    assert np.allclose(by_score, sorted(want), atol=1e-3)
    for c, total in inside.items():
        assert math.isclose(total, 1.0 if c < M.FIRST_RARE else size[c] / (size[c] + 1), rel_tol=1e-9)


def test_it_learns_what_follows_what():
    rng = random.Random(8)
    texts = [" ".join(w for _ in range(60) for w in ((f"a{rng.randint(0, 3)}", f"b{rng.randint(0, 3)}"))).encode() for _ in range(300)]
    model = M.train(texts)
    raw = np.frombuffer(b"a1 b1", dtype=np.uint8)
    a, b = M.sequences(model, raw, np.array([0, 5]))[0][:2]
    table = 10.0 ** model.log10(np.array([[a, b], [b, a]]))
    assert table[0][b] > 5 * table[1][b]


def test_the_model_is_fitted_on_all_texts_whole(spark):
    rng = random.Random(9)
    docs = [(n, " ".join(rng.choices(["p", "q", "r", f"only{n % 700}"], k=6))) for n in range(6_000)]
    docs += [(7_000, "long1 long2 " * 10_000), (7_001, None), (None, "no id"), (7_002, "")]
    want = M.train([(t or "").encode() for _, t in docs])
    got = M.fitted(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5))
    assert np.array_equal(got.top, want.top) and np.array_equal(got.order, want.order)
    assert all(np.allclose(getattr(got, k), getattr(want, k), atol=1e-5) for k in ("given", "places", "wanted", "bias"))
    raw = np.frombuffer(b"long1 long2", dtype=np.uint8)
    a, b = M.sequences(got, raw, np.array([0, len(raw)]))[0][:2]
    assert (10.0 ** got.log10(np.array([[a, b]])))[0][b] > 0.5


def test_words_sent_in_several_rounds_keep_their_counts(monkeypatch):
    texts = [t for _, t in rows()]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    monkeypatch.setattr(M, "HELD", 50)
    counts = collections.Counter()
    sent = 0
    for out in M._words(iter([batch.slice(k, 10) for k in range(0, len(texts), 10)]), 7):
        sent += 1
        for r in out.to_pylist():
            for h, n in zip(np.frombuffer(r["words"], dtype=np.uint64).tolist(), np.frombuffer(r["times"], dtype=np.int64).tolist()):
                counts[h] += n
    want = collections.Counter(w for t in texts for w in WORD.findall((t or "").translate(LOW)))
    assert sent > 1 and sorted(counts.values()) == sorted(want.values())


def test_empty_table_and_all_held_out(spark):
    assert M.score(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    own = [n for n in range(100) if zlib.crc32(str(n).encode()) % 7 == 2][:3]
    got = M.score(spark.createDataFrame([(n, "a b") for n in own], "doc_id bigint, text string")).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(3, 0, 0, 0.0)}
    clash = spark.createDataFrame([(1, "a", 3, "x")], "doc_id bigint, text string, score int, part string")
    assert M.score(clash).count() == 1
