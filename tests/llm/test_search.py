"""Top-k search against brute force."""

import math
import random

from chainlytics.llm import search as S


def brute(rows, k):
    whole = [
        (n, key, [math.floor(64 * x) for x in v])
        for n, (key, v, *_) in enumerate(rows)
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, q, a in whole:
        if q % 20:
            continue
        best = sorted((-sum(x * y for x, y in zip(a, b)), c) for m, c, b in whole if m != n)[:k]
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return sorted(out)


def found(spark, rows, k=20, schema="vec_id bigint, embedding array<double>", **more):
    return sorted(tuple(r) for r in S.nearest(spark.createDataFrame(rows, schema), k, **more).collect())


def test_as_brute_force_over_several_shards(spark):
    rng = random.Random(4)
    rows = [(n, [rng.gauss(0, 1) for _ in range(6)]) for n in range(700)]
    rows += [(1000 + n, [1.0] * 6) for n in range(200)]  # one vector many times: ties go to the smaller id
    assert found(spark, rows, 7, shard_rows=120) == brute(rows, 7)


def test_rows_that_take_no_part_and_repeated_ids(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, None), (40, [None, 1.0]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (None, [9.0, 9.0]), (3, [-0.01, 0.5]), (3, [5.0, 5.0]), (5, [1.0]), (7, [])]
    got = found(spark, rows)
    assert got == brute(rows, 20) and len(got) == 10 and (0, 2, 0, 20_480) in got


def test_few_or_no_rows(spark):
    assert found(spark, []) == [] and found(spark, [(0, [1.0])]) == []
    assert found(spark, [(0, [1.0]), (20, [2.0])]) == [(0, 1, 20, 8192), (20, 1, 0, 8192)]


def test_large_numbers_are_exact(spark):
    rows = [(0, [3e7, 1.0]), (1, [3e7, 1.0]), (2, [3e7, 1.015625])]
    assert found(spark, rows, 2) == brute(rows, 2)


def test_ties_over_shards_with_repeated_ids(spark, monkeypatch):
    """Every row stays a point of its own, whichever shard it falls to; root boxes in several blocks."""
    monkeypatch.setattr(S, "BOXES", 3)
    monkeypatch.setattr(S, "TOGETHER", 2)
    rng = random.Random(8)
    rows = [(rng.choice([0, 20, 20, 40, rng.randint(1, 60)]), [float(rng.randint(-1, 1)) for _ in range(3)]) for _ in range(120)]
    assert found(spark, rows, 6, shard_rows=15) == brute(rows, 6)


def test_shards_that_cannot_reach_the_kth_score_are_not_asked():
    lows, highs = S.np.array([[0, 0], [5, 5], [-9, -9]]), S.np.array([[1, 1], [6, 7], [-8, -8]])
    assert S.reach(S.np.array([[2, 1], [-1, 0]]), lows, highs).tolist() == [[3, 19, -24], [0, -5, 9]]


def test_long_vectors_and_clashing_columns(spark):
    rng = random.Random(9)
    rows = [(n, [rng.random() for _ in range(3_000)], n, 1, "x", 2) for n in range(0, 200, 5)]
    schema = "vec_id bigint, embedding array<double>, row bigint, shard int, vector string, rank int"
    assert found(spark, rows, 3, schema, shard_rows=15) == brute(rows, 3)
