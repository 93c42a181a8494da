from datetime import datetime

import pytest

from chainlytics.operators import audit
from chainlytics.operators.asof import asof, audit_history, audited_blocks
from conftest import rows

PAIR = "block int, txid string"


@pytest.fixture
def sides(spark):
    actual = [(1, "a"), (1, "a"), (1, "b"), (1, None), (2, "x"), (2, "y")]
    predicted = [(1, "a"), (1, "c"), (1, None), (3, "p"), (2, "x"), (2, "x")]
    return spark.createDataFrame(actual, PAIR), spark.createDataFrame(predicted, PAIR)


def test_sets(sides):
    assert rows(audit.matches(*sides)) == [(1, "a"), (1, None), (2, "x")]
    assert rows(audit.added(*sides)) == [(1, "b"), (2, "y")]
    assert rows(audit.missing(*sides)) == [(1, "c"), (3, "p")]


def test_summary_counts_repeats_in_the_denominator(sides):
    found = {r["block"]: tuple(r)[1:] for r in audit.audit_summary(*sides).collect()}
    assert found[1] == (2, 1, 1, 2 / 4)
    assert found[2] == (1, 1, 0, 1 / 2)
    assert found[3] == (0, 0, 1, 0.0)  # nothing mined: accuracy 0


def test_summary_adds_up(sides):
    actual, predicted = sides
    for r in audit.audit_summary(actual, predicted).collect():
        block = f"block = {r['block']}"
        assert r["matches"] + r["added"] == actual.where(block).distinct().count()
        assert r["matches"] + r["missing"] == predicted.where(block).distinct().count()


@pytest.mark.parametrize("digits", [audit.SHARD_DIGITS, 3])
def test_lists_are_whole_over_their_shards(spark, sides, digits):
    actual = spark.createDataFrame([(1, f"t{i}") for i in range(500)], PAIR)
    predicted = spark.createDataFrame([(1, f"t{i}") for i in range(250, 600)], PAIR)
    lists = audit.audit_lists(actual, predicted, shard_digits=digits).collect()
    for status, want in [("added", range(250)), ("matches", range(250, 500)), ("missing", range(500, 600))]:
        shards = [r["txids"] for r in lists if r["status"] == status]
        assert all(s == sorted(s) for s in shards)
        assert sorted(t for s in shards for t in s) == sorted(f"t{i}" for i in want)


def at(minute):
    return datetime(2024, 1, 1, minute // 60, minute % 60)


@pytest.mark.parametrize("seed", range(4))
def test_asof_against_brute_force(spark, seed):
    import random

    random.seed(seed)
    left = [(i, at(random.randint(0, 200))) for i in range(150)] + [(1000 + i, at(77)) for i in range(100)]
    right = [(at(random.randint(20, 180)), i) for i in range([0, 1, 40, 300][seed])]
    found = asof(
        spark.createDataFrame(left, "id int, t timestamp"),
        "t",
        spark.createDataFrame(right, "made timestamp, v int"),
        "made",
        "v",
    )
    want = []
    for i, t in left:
        before = [r for r in right if r[0] <= t]
        want.append((i, t, max(before)[1] if before else None))
    assert rows(found) == sorted(want, key=repr)


def test_blocks_between_two_predictions_are_audited_once(spark):
    mined = spark.createDataFrame([(10, at(0)), (11, at(15)), (12, at(16)), (13, at(40))], "block int, mined_at timestamp")
    made = spark.createDataFrame([(at(10),), (at(10),), (at(20),), (at(50),)], "prediction_time timestamp")
    assert rows(audited_blocks(mined, made)) == [(at(10), 12), (at(20), 13)]


def test_history(spark):
    mined = spark.createDataFrame([(1, at(15)), (2, at(30))], "block int, mined_at timestamp")
    predicted = spark.createDataFrame(
        [(at(10), "a"), (at(10), "b"), (at(20), "a")], "prediction_time timestamp, txid string"
    )
    actual = spark.createDataFrame([(1, "a"), (1, "z")], PAIR)  # block 2 could not be read
    found = rows(audit_history(mined, actual, predicted))
    assert found == [(1, at(10), 1, 1, 1, 0.5), (2, at(20), 0, 0, 1, 0.0)]
