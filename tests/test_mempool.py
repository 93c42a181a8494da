import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chainlytics.operators import mempool
from chainlytics.operators.changes import lookup
from conftest import physical, rows

STATE = "txid string, fee long, weight long, sigops int"


def greedy(txs, weight_limit, sigops_limit):
    """The sequential rule: best rate first, stop at the first that does not fit."""
    block, weight, sigops = [], 0, 0
    for tx in sorted(txs, key=lambda t: (-t[1] / t[2], t[0])):
        if weight + tx[2] > weight_limit or sigops + (tx[3] or 0) > sigops_limit:
            break
        block.append(tx[0])
        weight, sigops = weight + tx[2], sigops + (tx[3] or 0)
    return block


def predicted(spark, txs, weight_limit, sigops_limit):
    block = mempool.predict_block(spark.createDataFrame(txs, STATE), weight_limit, sigops_limit)
    found = sorted(block.select("position", "txid").collect())
    assert [r[0] for r in found] == list(range(len(found)))
    return [r[1] for r in found]


@pytest.mark.parametrize(
    "txs, weight, sigops",
    [
        ([("a", 10, 1000, 1)], 999, 10),  # the first is too heavy: empty block
        ([("a", 30, 10, 1), ("b", 20, 10, 1), ("c", 1, 1, 0)], 15, 10),  # c would fit, but comes after the stop
        ([("b", 10, 10, 1), ("a", 10, 10, 1), ("c", 10, 10, 1)], 20, 10),  # equal rates go by id
        ([("a", 30, 10, 9), ("b", 20, 10, 9), ("c", 10, 10, 0)], 1000, 10),  # sigops run out first
        ([("a", 0, 10, 1), ("b", 0, 20, 1)], 25, 10),  # no fees at all
        ([("a", 5, 10, None), ("b", 4, 10, None)], 100, 0),  # missing sigops count as none
        ([("a", 5, 10, 1), ("b", 4, 10, 1)], 20, 2),  # both limits met exactly
        ([], 10, 10),
    ],
)
def test_edges(spark, txs, weight, sigops):
    assert predicted(spark, txs, weight, sigops) == greedy(txs, weight, sigops)


@pytest.mark.parametrize("seed", range(6))
def test_equals_the_sequential_rule(spark, seed):
    random.seed(seed)
    rates = [random.choice([1, 2, 2, 2, 5]) if seed % 2 else random.random() * 50 for _ in range(400)]
    txs = []
    for i, rate in enumerate(rates):
        weight = random.randint(1, 40)
        txs.append((f"t{i:04d}", int(rate * weight), weight, random.randint(0, 5)))
    for weight, sigops in [(500, 80), (5000, 100), (10**9, 10**9), (3000, 700)]:
        assert predicted(spark, txs, weight, sigops) == greedy(txs, weight, sigops)


@pytest.mark.parametrize("width", [1, 4, 100])
def test_hot_rate_is_split_and_stays_exact(spark, width):
    """Most rows share the one rate the budget runs out in."""
    txs = [(f"t{i:05d}", 400, 100, 1) for i in range(3000)] + [(f"h{i}", 900, 100, 1) for i in range(5)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    try:
        assert predicted(spark, txs, 20_000, 10**6) == greedy(txs, 20_000, 10**6)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_misfit_in_one_part_stops_the_others(spark):
    txs = [("a", 5_000_000, 5_000_000, 1), ("b", 1_000, 1_000, 1)]
    state = spark.createDataFrame(txs, STATE).repartition(2)
    assert mempool.predict_block(state).isEmpty() and greedy(txs, 4_000_000, 80_000) == []


@pytest.mark.parametrize("seed", range(56))
def test_equal_rates_and_mixed_weights_over_many_parts(spark, seed):
    """Weight-bound and sigops-bound, one block and one per group, over 2 to 100 parts."""
    rng = random.Random(seed)
    parts = rng.choice([2, 3, 7, 30, 100])
    groups = ["x", "y"] if seed % 3 == 0 else ["x"]
    txs = []
    for i in range(120):
        weight = rng.choice([1, 3, 10, 40, 150])
        txs.append((rng.choice(groups), f"t{i:03d}", weight * rng.choice([1, 1, 1, 2]), weight, rng.choice([0, 1, 5, 30])))
    weight, sigops = (rng.randint(1, 900), 10**6) if seed % 2 else (10**6, rng.randint(1, 200))
    df = spark.createDataFrame(txs, "round string, " + STATE).repartition(parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(parts, 9)))
    try:
        by = ["round"] if len(groups) > 1 else []
        found = mempool.predict_block(df, weight, sigops, by=by).orderBy("position").collect()
        for group in groups:
            own = [r["txid"] for r in found if not by or r["round"] == group]
            assert own == greedy([t[1:] for t in txs if t[0] == group], weight, sigops)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_block_per_group_with_missing_group(spark):
    random.seed(9)
    data = [
        (random.choice(["x", "x", "x", "y", None]), f"t{i:03d}", random.randint(0, 99), random.randint(1, 9), 1)
        for i in range(300)
    ]
    df = spark.createDataFrame(data, "round string, " + STATE)
    found = mempool.predict_block(df, 60, 100, by=["round"]).orderBy("position").collect()
    for group in ("x", "y", None):
        want = greedy([r[1:] for r in data if r[0] == group], 60, 100)
        assert [r["txid"] for r in found if r["round"] == group] == want


def test_no_task_gets_the_whole_state(spark):
    df = spark.createDataFrame([("a", 1, 1, 1)], STATE)
    plan = physical(mempool.predict_block(df))
    # From the result down: brought together only after the parts were cut, and those only after
    # every task had cut its own rows.
    steps = ["SinglePartition", ", Final", "hashpartitioning(_part", ", Partial", "Scan ExistingRDD"]
    at = [plan.index(step) for step in steps]
    assert at == sorted(at)
    # The only other gathering is that of the written band sums.
    assert plan.count("SinglePartition") == 2
    assert "ReadSchema: struct<_band:int,_w:bigint,_s:bigint>" in plan[plan.rindex("SinglePartition") :]


def test_negative_sigops_are_an_error(spark):
    df = spark.createDataFrame([("a", 1, 1, -1)], STATE)
    with pytest.raises(Exception, match="sigops"):
        mempool.predict_block(df).collect()


def snapshots(spark):
    t = [datetime(2024, 1, 1, h) for h in range(4)]
    data = [
        ("a", 10, 100, 1, t[0], 1, t[0]),
        ("b", 20, 100, 1, t[0], 2, t[0]),
        ("a", 30, 100, 1, t[1], 3, t[1]),
        ("c", 30, 100, 1, t[1], 4, t[1]),
    ]
    return spark.createDataFrame(data, STATE + ", first_seen timestamp, seq long, snapshot timestamp")


def test_state_keeps_the_latest_version_and_the_first_place(spark):
    state = mempool.mempool_state(snapshots(spark))
    a = lookup(state, txid="a").first()
    assert (a["fee"], a["first_seen"], a["place"]) == (30, datetime(2024, 1, 1, 1), 1)
    assert a["first_ever_seen"] == datetime(2024, 1, 1, 0)
    assert lookup(state, txid="nope").isEmpty()
    # a and c have one rate; a was there first
    block = mempool.predict_block(state, ties=["place"]).orderBy("position").collect()
    assert [r["txid"] for r in block] == ["a", "c", "b"]


def test_pruning(spark):
    assert {r["txid"] for r in mempool.in_last_snapshot(snapshots(spark)).collect()} == {"a", "c"}
    state = mempool.mempool_state(snapshots(spark))
    mined = spark.createDataFrame([("a",), ("a",), ("z",)], "txid string")
    assert {r["txid"] for r in mempool.without_mined(state, mined).collect()} == {"b", "c"}


def test_ranking(spark):
    df = spark.createDataFrame([("a", 1, 2, 0), ("b", 3, 2, 0), ("c", 1, 2, 0)], STATE)
    assert rows(mempool.ranked_by_rate(df).select("txid", "fee_rate"), "as is") == [("b", 1.5), ("a", 0.5), ("c", 0.5)]
    assert mempool.ranked_by_rate(df.where(F.lit(False))).isEmpty()
    many = spark.createDataFrame([(f"t{i:03d}", i % 7, 2, 0) for i in range(200)], STATE).repartition(5)
    want = sorted(((-(i % 7) / 2, f"t{i:03d}") for i in range(200)))
    assert [(r["rank"], r["txid"]) for r in mempool.with_rank(many).orderBy("rank").collect()] == [(n + 1, t) for n, (_, t) in enumerate(want)]
    assert mempool.with_rank(df.where(F.lit(False))).isEmpty()
