import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from chainlytics import storage
from chainlytics.operators import latest
from chainlytics.plans import catalog, cycle, panels, rollup_store, tables
from chainlytics.sources.database import jdbc_options, query, read_table
from conftest import physical, rows

START = datetime(2024, 3, 1)


@pytest.fixture
def loaded(spark, root):
    found = catalog.apply(spark, root)
    data = [
        (f"h{i}", START + timedelta(hours=i), i % 7, 100 + i, i, 0) for i in range(24 * 5)
    ]
    df = spark.createDataFrame(data, "hash string, timestamp timestamp, nTx int, difficulty long, height int, seq long")
    tables.upsert(found.tables["l0_btc_blocks"], df)
    now = START + timedelta(days=4)
    for name, policy in found.policies.items():
        rollup_store.run_policy(spark, found.rollups[name], policy, now)
    catalog.register_views(spark, found)
    return found, data


def test_definitions(spark, root):
    found = catalog.build(root)
    assert list(found.tables) == ["l0_btc_blocks"]
    assert found.tables["l0_btc_blocks"].keys == ("timestamp", "hash")
    assert found.tables["l0_btc_blocks"].columns["difficulty"].dataType == T.LongType()
    assert {n: (p.start_offset, p.end_offset, p.schedule) for n, p in found.policies.items()} == {
        "l1_btc_transactions_volume_daily": ("1 week", "1 hour", "5 minutes"),
        "l1_btc_block_height_daily": ("1 week", "1 hour", "1 hour"),
        "l1_btc_block_difficulty_daily": ("1 week", "1 hour", "1 hour"),
    }


def test_unknown_rollup_in_a_policy(spark, root):
    defs = catalog.definitions()
    defs["policies"][0]["rollup"] = "nope"
    with pytest.raises(ValueError):
        catalog.apply(spark, root, defs)


def test_apply_twice_keeps_rows(spark, root, loaded):
    again = catalog.apply(spark, root)
    assert tables.read(spark, again.tables["l0_btc_blocks"]).count() == 120


def test_panels(spark, loaded):
    _, data = loaded
    sums = {}
    for row in data:
        sums[row[1].date()] = sums.get(row[1].date(), 0) + row[2]
    daily = panels.panel(spark, "transactions_daily").collect()
    assert [(r["time"].date(), r["transactions"]) for r in daily] == sorted(sums.items())
    assert panels.panel(spark, "block_height").first()["height"] == 119
    assert panels.panel(spark, "block_difficulty").first()["difficulty"] == 219
    heights = panels.panel(spark, "block_height_daily", as_of=(START + timedelta(days=3)).date()).collect()
    assert [r["height"] for r in heights] == [119, 95, 71, 47, 23]
    assert [r["difficulty"] for r in panels.panel(spark, "block_difficulty_daily").collect()] == [123, 147, 171, 195, 219]
    hourly = panels.panel(spark, "transactions_sigma_hourly", start=START, end=START + timedelta(days=1))
    assert sum(r["hours_in_range"] for r in hourly.collect()) == 25  # both ends belong to the range
    assert sum(r["days_in_range"] for r in panels.panel(spark, "transactions_sigma_daily").collect()) == 5


def test_ranges_include_both_ends(spark, loaded):
    found = panels.panel(spark, "transactions_daily", start=START + timedelta(days=1), end=START + timedelta(days=2))
    assert found.count() == 2


def test_stat(spark, loaded):
    assert panels.stat(panels.panel(spark, "block_height"), "height").first()["height"] == 119
    daily = panels.panel(spark, "block_difficulty_daily")
    assert panels.stat(daily, "difficulty", "time").first()["difficulty"] == 219


def test_views_by_every_name(spark, loaded):
    for name in ("l1_btc_transactions_volume_daily", "btc_transactions_volume_daily"):
        assert read_table(spark, name).count() == 5
    found = query(spark, "SELECT max(ntx) AS m FROM l0_btc_blocks WHERE height < :top", top=3)
    assert found.first()["m"] == 2


def test_drop_takes_the_rollups_along(spark, loaded):
    found, _ = loaded
    path = found.rollups["l1_btc_block_height_daily"].path
    catalog.drop_table(spark, found, "l0_btc_blocks")
    assert not found.rollups and not found.policies and not found.aliases
    assert not storage.exists(spark, path)
    with pytest.raises(AnalysisException):
        spark.table("btc_transactions_volume_daily")


def test_jdbc_options():
    options = jdbc_options("jdbc:postgresql://db/x", "t", "u", "p", "height", (0, 900000), 16)
    assert options["partitionColumn"] == "height" and options["numPartitions"] == "16"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", split_by="height")


def test_prediction_cycle(spark, root):
    state = spark.createDataFrame(
        [("a", 30, 10, 1), ("b", 20, 10, 1), ("c", 10, 10, 1)], "txid string, fee long, weight long, sigops int"
    )
    from chainlytics.operators.mempool import predict_block

    for minute, limit in ((0, 10), (5, 20)):
        cycle.save_prediction(predict_block(state, limit), f"{root}/predicted", datetime(2024, 1, 1, 0, minute))
    saved = cycle.predictions(spark, f"{root}/predicted")
    assert rows(saved.select("txid", "position")) == [("a", 0), ("a", 0), ("b", 1)]
    actual = spark.createDataFrame([("a",), ("z",), ("z",)], "txid string")
    cycle.save_audits(cycle.audit_next(actual, saved, 7), f"{root}/audits", datetime(2024, 1, 1, 0, 9))
    assert rows(cycle.audits(spark, f"{root}/audits")) == [(7, datetime(2024, 1, 1, 0, 9), 1, 1, 1, 1 / 3)]
    # an empty prediction counts as the newest, and an empty block has its row
    cycle.save_prediction(predict_block(state, 1), f"{root}/predicted", datetime(2024, 1, 1, 0, 10))
    saved, rounds = cycle.predictions(spark, f"{root}/predicted"), cycle.rounds(spark, f"{root}/predicted")
    assert rounds.count() == 3
    assert rows(cycle.audit_next(actual, saved, 8, rounds)) == [(8, 0, 2, 0, 0.0)]
    assert rows(cycle.audit_next(actual.limit(0), saved, 9, rounds)) == [(9, 0, 0, 0, 0.0)]


def scans(df):
    return physical(df).split("FileScan")[1:]


def test_panels_open_only_the_days_they_show(spark, loaded):
    day = START + timedelta(days=1)
    hourly = panels.panel(spark, "transactions_sigma_hourly", start=day, end=day + timedelta(hours=5))
    assert all("day" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans(hourly))
    series = panels.panel(spark, "block_height_daily", as_of=(START + timedelta(days=4)).date())
    filters = [s.split("PartitionFilters: [")[1].split("]")[0] for s in scans(series)]
    assert len(filters) >= 2 and all("day" in f or "month" in f for f in filters)


def test_the_latest_row_opens_the_newest_day_only(spark, loaded):
    newest = latest.newest_slice(spark.table("l0_btc_blocks"))
    assert {r["day"].isoformat() for r in newest.select("day").distinct().collect()} == {"2024-03-05"}
    assert {m for m in (re.search("day=([^/]+)", f)[1] for f in newest.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])} == {"2024-03-05"}
    found = latest.latest_in_slices(spark.table("l0_btc_blocks"), "height", 30, ("timestamp", "hash"))
    assert [r["height"] for r in found.collect()] == list(range(119, 89, -1))
    last = scans(found)[-1].split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-03-04" in last and "2024-03-05" in last and "2024-03-03" not in last


def test_a_panel_without_a_range_shows_all_rows(spark, root):
    found = catalog.apply(spark, root)
    late = datetime(2031, 5, 5)
    df = spark.createDataFrame([("x", late, 3, 1, 1, 0)], "hash string, timestamp timestamp, nTx int, difficulty long, height int, seq long")
    tables.upsert(found.tables["l0_btc_blocks"], df)
    catalog.register_views(spark, found)
    assert panels.panel(spark, "transactions_daily").first()["transactions"] == 3
    assert panels.panel(spark, "transactions_daily", end=panels.DEFAULT_TO).isEmpty()


def test_mempool_saved_and_loaded(spark, root):
    table = tables.mempool_table(f"{root}/state", 4)
    state = spark.createDataFrame(
        [("a", 1, 2, 3, START), ("b", 1, 2, 3, START)],
        "txid string, fee long, weight long, sigops int, first_seen timestamp",
    )
    cycle.save_mempool(state, table)
    cycle.save_mempool(state.where("txid = 'a'").selectExpr("txid", "9L AS fee", "weight", "sigops", "first_seen"), table)
    assert rows(cycle.load_mempool(spark, table).select("txid", "fee")) == [("a", 9), ("b", 1)]


def test_the_highest_block_comes_from_footers(spark, loaded):
    found, _ = loaded
    plan = panels.panel(spark, "block_height", blocks=found.tables["l0_btc_blocks"])
    assert plan.first()["height"] == 119
    assert "PushedAggregation: [MAX(height)]" in physical(plan)
    newest = panels.panel(spark, "block_difficulty", blocks=found.tables["l0_btc_blocks"])
    assert newest.first()["difficulty"] == 219 == panels.panel(spark, "block_difficulty").first()["difficulty"]
    (file,) = newest.inputFiles()
    assert "day=2024-03-05" in file


def test_rollups_are_built_after_their_bases_and_dropped_with_the_table(spark, root):
    found = catalog.apply(spark, root, catalog.definitions("cascade"))
    names = list(found.rollups)
    assert names.index("l1_transactions_hourly") < names.index("l2_transactions_daily") < names.index("l2_transactions_weekly")
    weekly = found.rollups["l2_transactions_weekly"]
    assert weekly.table is found.tables["l0_btc_blocks"]
    data = [(f"h{i}", START + timedelta(hours=i), i % 7, 1, i, 0) for i in range(24 * 20)]
    schema = "hash string, timestamp timestamp, nTx int, difficulty long, height int, seq long"
    tables.upsert(found.tables["l0_btc_blocks"], spark.createDataFrame(data, schema))

    def weeks():
        return {r["time"].date().isoformat(): r["transactions"] for r in rollup_store.read(spark, weekly).collect()}

    want = {}
    for row in data:
        day = (row[1] - timedelta(days=row[1].weekday())).date().isoformat()
        want[day] = want.get(day, 0) + row[2]
    assert weeks() == want  # nothing is stored: all live, through three rollups
    catalog.refresh(spark, found, START + timedelta(days=12))
    assert [rollup_store.mark(spark, found.rollups[n]) for n in names[-3:]] == [datetime(2024, 3, 12, 23), datetime(2024, 3, 12), datetime(2024, 3, 11)]
    assert weeks() == want
    part = rollup_store.read(spark, weekly, datetime(2024, 3, 4), datetime(2024, 3, 18))
    assert {r["time"].day: r["transactions"] for r in part.collect()} == {4: want["2024-03-04"], 11: want["2024-03-11"]}
    catalog.drop_table(spark, found, "l0_btc_blocks")
    assert not found.rollups and not found.policies and not storage.exists(spark, weekly.path) and not storage.exists(spark, weekly.mark_path)


def test_a_rollup_on_nothing_known_or_on_parts_of_buckets_is_refused(root):
    defs = catalog.definitions("cascade")
    defs["rollups"] = [r for r in defs["rollups"] if r["name"] != "l1_transactions_hourly"]
    with pytest.raises(ValueError, match="l2_transactions_daily"):
        catalog.build(root, defs)
    defs = catalog.definitions("cascade")
    next(r for r in defs["rollups"] if r["name"] == "l2_transactions_daily")["width"] = "90 minutes"
    with pytest.raises(ValueError, match="whole buckets"):
        catalog.build(root, defs)
