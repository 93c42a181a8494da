from datetime import datetime, timedelta

import pytest

from chainlytics.plans import rollup_store, tables
from chainlytics.plans.rollup_store import Policy, Rollup
from conftest import physical, rows

DAY0 = datetime(2024, 1, 1)


@pytest.fixture
def volume(spark, root):
    base = tables.create(spark, tables.block_table(f"{root}/blocks"))
    return Rollup("volume", base, "timestamp", "1 day", {"transactions": "sum(nTx)", "height": "max(height)"}, f"{root}/volume")


def put(spark, rollup, days, n=1):
    """One block per day and half day, nTx = n."""
    data = [
        (f"{d}-{half}", DAY0 + timedelta(days=d, hours=12 * half), n, 1, 2 * d + half, 0)
        for d in days
        for half in (0, 1)
    ]
    df = spark.createDataFrame(data, "hash string, timestamp timestamp, nTx int, difficulty long, height int, seq long")
    tables.upsert(rollup.base, df)


def live(spark, rollup):
    return rows(rollup.of(tables.read(spark, rollup.base)))


def test_never_refreshed_reads_live(spark, volume):
    put(spark, volume, range(3))
    assert rows(rollup_store.read(spark, volume)) == live(spark, volume)
    assert rollup_store.mark(spark, volume) is None


def test_first_refresh_starts_at_the_oldest_block(spark, volume):
    put(spark, volume, range(40))
    start, end = rollup_store.refresh(spark, volume, DAY0 + timedelta(days=30, hours=5))
    assert (start, end) == (None, DAY0 + timedelta(days=30))
    assert rollup_store.read_stored(spark, volume).count() == 30
    assert rows(rollup_store.read(spark, volume)) == live(spark, volume)


def test_window_bounds_are_whole_buckets(spark, volume):
    put(spark, volume, range(3))
    rollup_store.refresh(spark, volume, DAY0 + timedelta(days=10))
    start, end = rollup_store.refresh(spark, volume, DAY0 + timedelta(days=20, minutes=30), "1 week", "1 hour")
    assert start == DAY0 + timedelta(days=14)  # the first bucket wholly inside
    assert end == DAY0 + timedelta(days=19)  # 23:30 the day before: that day is not over


def test_new_blocks_show_at_once(spark, volume):
    put(spark, volume, range(10))
    rollup_store.refresh(spark, volume, DAY0 + timedelta(days=8))
    put(spark, volume, range(8, 15), n=5)
    assert rows(rollup_store.read(spark, volume)) == live(spark, volume)


def test_late_changes_follow_inside_the_window_only(spark, volume):
    now = DAY0 + timedelta(days=40)
    put(spark, volume, range(40))
    rollup_store.refresh(spark, volume, now)
    put(spark, volume, [2, 36], n=100)
    before = rows(rollup_store.read(spark, volume))
    assert before != live(spark, volume)  # nothing was refreshed yet
    rollup_store.refresh(spark, volume, now)
    after = {r["time"]: r["transactions"] for r in rollup_store.read(spark, volume).collect()}
    assert after[DAY0 + timedelta(days=36)] == 200
    assert after[DAY0 + timedelta(days=2)] == 2  # stale: older than the window
    rollup_store.refresh(spark, volume, now, full=True)
    assert rows(rollup_store.read(spark, volume)) == live(spark, volume)


def test_refresh_is_repeatable_and_the_mark_never_falls(spark, volume):
    put(spark, volume, range(35))
    policy = Policy("volume", "1 week", "1 hour", "5 minutes")
    now = DAY0 + timedelta(days=33)
    for moment in (now, now, now - timedelta(days=10)):
        rollup_store.run_policy(spark, volume, policy, moment)
    assert rollup_store.mark(spark, volume) == now - timedelta(days=1)
    assert rows(rollup_store.read(spark, volume)) == live(spark, volume)


def test_window_across_months_keeps_other_days(spark, volume):
    put(spark, volume, range(45))
    rollup_store.refresh(spark, volume, DAY0 + timedelta(days=28))
    rollup_store.refresh(spark, volume, DAY0 + timedelta(days=34))
    assert rollup_store.read_stored(spark, volume).count() == 33
    assert rows(rollup_store.read(spark, volume)) == live(spark, volume)


def test_reading_prunes_both_sides(spark, volume):
    put(spark, volume, range(5))
    rollup_store.refresh(spark, volume, DAY0 + timedelta(days=4))
    plan = physical(rollup_store.read(spark, volume))
    scans = plan.split("FileScan")[1:]
    assert any("LessThan(time" in s for s in scans)
    assert any("day" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


def test_drop(spark, volume):
    put(spark, volume, range(3))
    rollup_store.refresh(spark, volume, DAY0 + timedelta(days=3))
    rollup_store.drop(spark, volume)
    assert rollup_store.mark(spark, volume) is None
    assert rows(rollup_store.read(spark, volume)) == live(spark, volume)
