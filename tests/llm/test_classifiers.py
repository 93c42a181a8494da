"""Toxicity and quality: held-out accuracy on the driver tables, tolerance of spelling, and edge rows."""

import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chainlytics.llm import quality as Q
from chainlytics.llm import toxicity as X

FOLDER = "/root/testdata/sf0.1"
tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not here")


def laid(raw):
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)


def rows(label, part):
    connection = duckdb.connect()
    found = connection.execute(f"SELECT doc_id, text, {label} FROM '{FOLDER}/documents.parquet' JOIN '{FOLDER}/labels.parquet' USING (doc_id) ORDER BY doc_id").fetchall()
    out = [[], []]
    for doc, text, y in found:
        out[part(zlib.crc32(str(doc).encode()))].append((text.encode("utf-8"), y))
    return out


def area(y, p):
    rank = np.empty(len(p))
    rank[np.argsort(p, kind="stable")] = np.arange(len(p))
    ones = y.sum()
    return (rank[y == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(y) - ones))


@tables
def test_quality_of_held_out_texts():
    train, test = rows("quality", lambda c: int(c % 5 == 0))
    net = Q.train([t for t, _ in train], np.array([y for _, y in train]))
    y, p = np.array([y for _, y in test]), Q.probabilities(*laid([t for t, _ in test]), net)
    assert area(y, p) > 0.98 and ((p >= Q.CUT) == (y == 1)).mean() > 0.97


@tables
def test_toxicity_of_held_out_texts_and_of_other_spellings():
    train, test = rows("toxic", lambda c: int(c % 4 == 2))
    machine = X.train([t for t, _ in train], np.array([y for _, y in train]))
    y, p = np.array([y for _, y in test]), machine.probabilities(*laid([t for t, _ in test]))
    assert area(y, p) > 0.92 and ((p >= X.CUT) == (y == 1)).mean() > 0.93

    def one(text):
        return float(machine.probabilities(*laid([text.encode("utf-8")]))[0])

    for text in ("idiot", "IDIOT!", "i d i o t", "i-d-i-o-t", "moroon"):
        assert one(text) >= X.CUT, text
    ordinary = one("the other thing is with the ention")
    assert ordinary < X.CUT and all(one(text) > 10 * ordinary for text in ("worthhless", "idxiot", "clowwn"))


def test_a_text_scores_alike_alone_and_among_others():
    rng = np.random.default_rng(1)
    raw = [bytes(rng.integers(32, 127, n, dtype=np.uint8)) for n in (0, 1, 3, 127, 128, 129, 255, 256, 700, 5000)] + ["é".encode() * 3000]
    net = Q.Network(3)
    machine = X.Machine()
    machine.weights = rng.normal(0, 1, X.CODES**3).astype(np.float32)
    machine.weights[0] = 0
    for whole, single in ((Q.probabilities(*laid(raw), net), [Q.probabilities(*laid([r]), net)[0] for r in raw]), (machine.probabilities(*laid(raw)), [machine.probabilities(*laid([r]))[0] for r in raw])):
        assert np.allclose(whole, single, atol=1e-5) and whole.min() >= 0 and whole.max() <= 1


def test_the_folded_kernel_is_the_kernel():
    words = [b"idiot", b"idxiot", b"edition", b"a", b"worthless", b"the"]
    codes, starts, ends, _ = X.units(*laid([b" ".join(words)]))
    numbers, matrix = X._landmark_matrix(codes, starts[:3], ends[:3])
    kernels = X._kernels(codes, starts, ends, numbers, matrix)

    def plain(a, b):
        def values(w):
            w = [X.START, *(w.astype(int)), X.END]
            out = {}
            for i in range(len(w)):
                for one, two, weight in X.SHAPES:
                    if i + two < len(w):
                        key = (w[i], w[i + one], w[i + two])
                        out[key] = out.get(key, 0) + weight
            return out

        x, y = values(a), values(b)
        return sum(v * y.get(k, 0) for k, v in x.items()) / float(X.norms(np.array([len(a)]))[0] * X.norms(np.array([len(b)]))[0])

    own = [codes[s:e] for s, e in zip(starts, ends)]
    assert np.allclose(kernels, [[plain(a, b) for b in own[:3]] for a in own], rtol=1e-4)
    beta = np.array([0.7, -1.2, 2.0], dtype=np.float32)
    weights = np.zeros(X.CODES**3, dtype=np.float32)
    weights[numbers] = matrix[:-1] @ beta
    assert np.allclose(X.folded(codes, starts, ends, weights), kernels @ beta, rtol=1e-3, atol=1e-5)


def test_every_window_of_a_long_word_is_read():
    codes, starts, ends, owner = X.units(*laid([b"x" * 1000 + b"idiot" + b"y" * 1000, b"", b"a b c", b"| a | b"]))
    assert (ends - starts).max() <= X.LONGEST_WORD
    assert any(bytes(codes[s:e]).find(bytes([9, 4, 9, 15, 20])) >= 0 for s, e in zip(starts, ends))
    assert owner.max() == 3 and bytes(codes[starts[owner == 2][0] : ends[owner == 2][0]]) == bytes([1, 2, 3])


@pytest.mark.parametrize("module", [Q, X])
def test_one_label_or_none(module):
    data = laid([b"abc", b""])
    model = module.train([], np.array([]))
    p = module.probabilities(*data, model) if module is Q else model.probabilities(*data)
    assert np.allclose(p, 0.5)
    model = module.train([b"abc", b"d"], np.array([1, 1]))
    p = module.probabilities(*data, model) if module is Q else model.probabilities(*data)
    assert (p > 0.5).all()


@pytest.mark.parametrize("module", [Q, X])
def test_rows_stay_as_they_are(spark, module):
    model = Q.Network(3) if module is Q else X.Machine()
    docs = spark.createDataFrame([(1, None, 5.0, "a"), (1, None, 5.0, "a"), (None, "x", None, None), (2, "word " * 50_000, 1.0, "b")], "doc_id bigint, text string, score double, held_out string")
    got = sorted((str(r["doc_id"]), r["held_out"], 0 <= r["score"] <= 1) for r in module.score(docs, model).collect())
    assert got == [("1", "a", True), ("1", "a", True), ("2", "b", True), ("None", None, True)]
    assert module.score(docs.limit(0), model).count() == 0


def test_labels_learned_from(spark):
    docs = spark.createDataFrame([(n, f"text {n}") for n in range(40)] + [(100, None), (1, "text 1 again")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(40)] + [(100, 1, 0), (3, None, None), (5, 7, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    texts, y, share = Q.labelled(docs, labels, "quality", Q.held_out, sample=1000)
    known = [n for n in range(40) if zlib.crc32(str(n).encode()) % 5]
    assert sorted(t.decode() for t in texts) == sorted([f"text {n}" for n in known] + (["text 1 again"] if 1 in known else []))
    assert all(int(t.split()[1]) % 2 == v for t, v in zip(texts, y)) and 0.3 < share < 0.7
    few, *_ = Q.labelled(docs, labels, "quality", Q.held_out, sample=3)
    assert 6 <= len(few) <= 7


def test_rejected_rows_go_with_all_their_columns(spark):
    net = Q.train([b"good words here " * 20, b"bad!! bad!! " * 30] * 10, np.array([1, 0] * 10))
    docs = spark.createDataFrame([(1, "good words here " * 30, "s"), (2, "bad!! bad!! " * 30, "t")], "doc_id bigint, text string, score string")
    assert [tuple(r) for r in Q.accepted(docs, net).collect()] == [(1, "good words here " * 30, "s")]


def plain_probability(raw, net):
    """The forward pass of the quality network, byte by byte."""
    blocks = [raw[k : k + Q.BLOCK] for k in range(0, max(1, len(raw)), Q.BLOCK)]
    features = []
    for n, block in enumerate(blocks):
        first, row = n * Q.BLOCK, [0.0] * (Q.FILTERS + Q.LAGS)
        for i in range(first, first + len(block)):
            for f in range(Q.FILTERS):
                response = float(net.bias[f])
                for k in range(Q.WIDTH):
                    if i + k < len(raw):
                        response += sum(float(net.byte[raw[i + k], d]) * float(net.filters[k, d, f]) for d in range(Q.DEPTH))
                row[f] = max(row[f], response)
        for lag in range(1, Q.LAGS + 1):
            same = sum(i >= lag and raw[i] == raw[i - lag] for i in range(first, first + len(block)))
            row[Q.FILTERS + lag - 1] = same / max(1, len(block))
        features.append(row)
    chunks = [[max(a, b) for a, b in zip(x, y)] for x, y in zip(features, features[1:])] or features
    logits = []
    for chunk in chunks:
        hidden = [max(0.0, sum(c * float(net.hidden[j, h]) for j, c in enumerate(chunk)) + float(net.hidden_bias[h])) for h in range(Q.HIDDEN)]
        logits.append(sum(a * float(o) for a, o in zip(hidden, net.out)) + float(net.out_bias[0]))
    return 1 / (1 + np.exp(-(net.scale * sum(logits) / len(logits) + net.shift)))


@pytest.mark.parametrize("raw", [b"", b"a", b"abcabcabc " * 9, bytes(range(256)) * 2, b"x" * 128, b"y" * 129, "long text é ".encode() * 40])
def test_quality_forward_pass_as_plain_python(raw):
    net = Q.Network(3)
    net.scale, net.shift = 0.7, -0.1
    found = Q.probabilities(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]), net)[0]
    assert abs(found - plain_probability(raw, net)) < 1e-4


def test_every_chunk_has_its_turn_in_training(monkeypatch):
    seen = []
    real = Q._pieces
    monkeypatch.setattr(Q, "_pieces", lambda data, first, starts, last: seen.extend(starts.tolist()) or real(data, first, starts, last))
    texts = [b"good words " * 700, b"bad!", b"", b"more " * 90]
    Q.train(texts, np.array([1, 0, 0, 1]))
    _, _, starts, _ = Q._windows(texts)
    assert set(seen) == set(starts.tolist())


def test_long_texts_are_learned_from(spark):
    long = "word " * 60_000
    docs = spark.createDataFrame([(1, long), (2, "b"), (2, "c"), (2, None), (3, "d")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0)], "doc_id bigint, quality int")
    texts, y, _ = Q.labelled(docs, labels, "quality", lambda c: F.lit(False), sample=5)
    assert sorted(texts) == sorted([long.encode(), b"b", b"b", b"c", b"c", b"d"]) and sorted(y.tolist()) == [0, 0, 0, 1, 1, 1]
