import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chainlytics import storage
from chainlytics.operators import changes
from chainlytics.plans import tables
from conftest import physical, rows

SCHEMA = "hash string, timestamp timestamp, nTx int, difficulty long, height int, seq long, kind string"
T1, T2 = datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10)


def given():
    return {"nTx": F.col("kind") != "header"}


def batch(spark, *records):
    return spark.createDataFrame(list(records), SCHEMA)


def stored(spark, table):
    return rows(tables.read(spark, table).select("hash", "timestamp", "nTx", "difficulty", "height"))


@pytest.fixture
def table(spark, root):
    return tables.create(spark, tables.block_table(f"{root}/blocks"))


HEADER = ("a", T1, None, 5, 1, 1, "header")
BLOCK = ("a", T1, 7, 6, 1, 2, "block")


@pytest.mark.parametrize("order", [[HEADER, BLOCK], [BLOCK, HEADER]])
@pytest.mark.parametrize("batches", [1, 2])
def test_a_header_never_clears_the_count(spark, table, order, batches):
    order = [(*r[:5], i, r[6]) for i, r in enumerate(order)]
    groups = [order] if batches == 1 else [[r] for r in order]
    for group in groups:
        tables.upsert(table, batch(spark, *group), given=given())
    assert stored(spark, table) == [("a", T1, 7, order[-1][3], 1)]


def test_a_header_alone_has_no_count(spark, table):
    tables.upsert(table, batch(spark, HEADER), given=given())
    assert stored(spark, table) == [("a", T1, None, 5, 1)]


def test_a_given_null_overwrites(spark, table):
    tables.upsert(table, batch(spark, BLOCK), given=given())
    tables.upsert(table, batch(spark, ("a", T1, None, None, 1, 3, "block")), given=given())
    assert stored(spark, table) == [("a", T1, None, None, 1)]


def test_replay_changes_nothing(spark, table):
    one = batch(spark, BLOCK, ("b", T2, 1, 1, 2, 1, "block"))
    tables.upsert(table, one, given=given())
    before = stored(spark, table)
    tables.upsert(table, one, given=given())
    assert stored(spark, table) == before
    assert changes.unique_violations(tables.read(spark, table), table.keys).isEmpty()


def test_key_twice_in_one_batch(spark, table):
    tables.upsert(table, batch(spark, ("a", T1, 1, 1, 1, 1, "block"), ("a", T1, 2, 2, 1, 2, "block")))
    assert stored(spark, table) == [("a", T1, 2, 2, 1)]


def test_forks_keep_both_hashes(spark, table):
    tables.upsert(table, batch(spark, ("a", T1, 1, 1, 9, 1, "block"), ("b", T1, 2, 1, 9, 1, "block")))
    assert len(stored(spark, table)) == 2


def test_only_touched_days_are_rewritten(spark, table):
    tables.upsert(table, batch(spark, BLOCK, ("b", T2, 1, 1, 2, 1, "block")))
    day = table.path + "/day=2024-01-01"
    before = {f.path: f.modificationTime for f in files(spark, day)}
    tables.upsert(table, batch(spark, ("c", T2, 1, 1, 3, 1, "block")))
    assert {f.path: f.modificationTime for f in files(spark, day)} == before


def files(spark, path):
    return spark.read.format("binaryFile").load(path).select("path", "modificationTime").collect()


def test_a_batch_with_a_known_and_a_new_day(spark, table):
    tables.upsert(table, batch(spark, BLOCK))
    tables.upsert(table, batch(spark, ("a", T1, 8, 6, 1, 3, "block"), ("b", T2, 1, 1, 2, 1, "block")))
    assert stored(spark, table) == [("a", T1, 8, 6, 1), ("b", T2, 1, 1, 2)]


def test_hour_slices(spark, root):
    from chainlytics.schemas import BLOCKS

    table = tables.KeyedTable.by_time(f"{root}/hours", BLOCKS, ("timestamp", "hash"), "timestamp", tables.HOUR)
    tables.create(spark, table)
    later = datetime(2024, 1, 1, 11, 30)
    tables.upsert(table, batch(spark, BLOCK, ("b", later, 1, 1, 2, 1, "block")))
    tables.upsert(table, batch(spark, ("b", later, 4, 1, 2, 1, "block")))
    assert stored(spark, table) == [("a", T1, 7, 6, 1), ("b", later, 4, 1, 2)]
    found = tables.read_range(spark, table, "timestamp", datetime(2024, 1, 1, 11), later)
    assert [r["hash"] for r in found.collect()] == ["b"]
    assert storage.exists(spark, f"{table.path}/hour=2024-01-01-11")


def test_null_keys_are_refused(spark, table):
    with pytest.raises(ValueError):
        tables.upsert(table, batch(spark, ("a", None, 1, 1, 1, 1, "block")))


class Killed(RuntimeError):
    pass


def crashing(monkeypatch, at):
    """Let the ``at``-th file-system change from now on fail; returns how many there were."""
    done = [0]
    for name in ("drop", "move", "write_text"):
        real = getattr(storage, name)

        def step(*args, real=real):
            done[0] += 1
            if done[0] == at:
                raise Killed
            return real(*args)

        monkeypatch.setattr(storage, name, step)
    return done


@pytest.mark.parametrize("at", range(1, 9))
def test_an_upsert_survives_a_crash_at_every_step(spark, table, monkeypatch, at):
    tables.upsert(table, batch(spark, BLOCK, ("z", T2, 1, 1, 1, 1, "block")))
    before = stored(spark, table)
    change = batch(spark, ("b", T1, 3, 3, 2, 5, "block"), ("z", T2, 9, 9, 9, 5, "block"))
    after = sorted([("a", T1, 7, 6, 1), ("b", T1, 3, 3, 2), ("z", T2, 9, 9, 9)], key=repr)
    with monkeypatch.context() as patch:
        crashing(patch, at)
        try:
            tables.upsert(table, change)
        except Killed:
            pass
    assert stored(spark, table) in (before, after)  # a read sees all of the change or nothing
    tables.upsert(table, change)
    assert stored(spark, table) == after


@pytest.mark.parametrize("at", range(1, 8))
def test_a_deleted_row_stays_away_after_a_crash(spark, table, monkeypatch, at):
    tables.upsert(table, batch(spark, BLOCK, ("z", T2, 1, 1, 1, 1, "block")))
    before = stored(spark, table)
    with monkeypatch.context() as patch:
        crashing(patch, at)
        try:
            tables.delete(table, batch(spark, BLOCK))  # its day runs empty
        except Killed:
            pass
    seen = stored(spark, table)
    assert seen in (before, [("z", T2, 1, 1, 1)])
    tables.upsert(table, batch(spark, ("y", T2, 2, 2, 2, 2, "block")))
    want = seen + [("y", T2, 2, 2, 2)]
    assert stored(spark, table) == sorted(want, key=repr)


def test_success_markers_may_be_off(spark, table):
    setting = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(setting, "false")
    try:
        tables.upsert(table, batch(spark, BLOCK))
        tables.upsert(table, batch(spark, ("a", T1, 8, 8, 8, 9, "block")))
    finally:
        conf.unset(setting)
    assert stored(spark, table) == [("a", T1, 8, 8, 8)]


def test_files_have_bounds_of_time_and_are_sorted_by_it(spark, table):
    from glob import glob

    from pyarrow import parquet

    tables.upsert(table, batch(spark, *[(f"h{i}", T1.replace(minute=i), 1, 1, i, 1, "block") for i in range(50, 0, -1)]))
    (path,) = glob(f"{table.path}/day=2024-01-01/*.parquet")
    column = next(c for c in (parquet.ParquetFile(path).metadata.row_group(0).column(k) for k in range(5)) if c.path_in_schema == "timestamp")
    assert column.statistics.has_min_max and column.statistics.min.minute == 1
    times = parquet.read_table(path)["timestamp"].to_pylist()
    assert times == sorted(times)


@pytest.mark.parametrize("seed", range(2))
def test_many_batches_equal_one(spark, root, seed):
    random.seed(seed)
    records = [
        (
            random.choice("abcdef"),
            random.choice([T1, T2]),
            random.choice([None, 1, 2, 3]),
            random.randint(1, 9),
            i,
            i,
            random.choice(["header", "block"]),
        )
        for i in range(60)
    ]
    whole, parts = (tables.create(spark, tables.block_table(f"{root}/{n}")) for n in ("whole", "parts"))
    tables.upsert(whole, batch(spark, *records), given=given())
    for start in range(0, 60, 20):
        tables.upsert(parts, batch(spark, *records[start : start + 20]), given=given())
    assert stored(spark, whole) == stored(spark, parts)


def test_delete(spark, root):
    table = tables.create(spark, tables.mempool_table(f"{root}/mempool", 4))
    df = spark.createDataFrame(
        [(f"t{i}", i, 1, 0, T1, 0) for i in range(20)],
        "txid string, fee long, weight long, sigops int, first_seen timestamp, seq long",
    )
    tables.upsert(table, df)
    tables.delete(table, df.where("fee % 2 = 0"))
    assert {r["txid"] for r in tables.read(spark, table).collect()} == {f"t{i}" for i in range(1, 20, 2)}
    tables.delete(table, df)  # shards run empty, and unknown keys are ignored
    assert tables.read(spark, table).isEmpty()


def test_reduction_is_a_hash_aggregate(spark):
    df = changes.latest_by_key(batch(spark, BLOCK), ["timestamp", "hash"], ["nTx", "difficulty", "height"], given=given())
    plan = physical(df)
    assert "SortAggregate" not in plan and "partial_max_by" in plan


def test_merging_is_one_aggregate_over_one_read_of_the_stored_rows(spark, table):
    tables.upsert(table, batch(spark, *[(f"h{i}", T1, 1, 1, i, 1, "block") for i in range(50)]))
    latest = changes.registered(batch(spark, BLOCK), table.keys, table.values, table.partial, given=given())
    latest = spark.createDataFrame(latest.collect(), latest.schema)
    merged = changes.merge(spark.read.schema(table.stored).parquet(table.path), latest, table.keys, table.values, table.partial)
    plan = physical(merged)
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan and "SortAggregate" not in plan


def test_an_older_change_that_comes_later_loses(spark, table):
    for seq, n in ((2, 20), (1, 10), (2, 20)):
        tables.upsert(table, batch(spark, ("a", T1, n, n, n, seq, "block")))
    assert stored(spark, table) == [("a", T1, 20, 20, 20)]
    tables.upsert(table, batch(spark, ("a", T1, 21, 21, 21, 2, "block")))  # of equal ones the arriving one
    assert stored(spark, table) == [("a", T1, 21, 21, 21)]


def test_columns_win_on_their_own(spark, table):
    """The newest header and the newest block each bring what they have, also when the block comes last."""
    tables.upsert(table, batch(spark, ("a", T1, None, 50, 5, 5, "header")), given=given())
    tables.upsert(table, batch(spark, ("a", T1, 3, 30, 3, 3, "block")), given=given())
    assert stored(spark, table) == [("a", T1, 3, 50, 5)]
    tables.upsert(table, batch(spark, ("a", T1, 2, 20, 2, 2, "block")), given=given())
    assert stored(spark, table) == [("a", T1, 3, 50, 5)]


@pytest.mark.parametrize("seed", range(6))
def test_any_order_and_any_number_of_times(spark, root, seed):
    """Batches shuffled, cut anew, some repeated: always what one batch gives. Full and partial columns, NULLs, negative seqs."""
    rng = random.Random(seed)
    records = [
        (rng.choice("abcdef"), rng.choice([T1, T2]), rng.choice([None, 1, 2, 3]), rng.choice([None, 4, 5]), i, s, rng.choice(["header", "block"]))
        for i, s in enumerate(rng.sample(range(-50, 50), 60))
    ]
    whole, parts = (tables.create(spark, tables.block_table(f"{root}/{n}")) for n in ("whole", "parts"))
    tables.upsert(whole, batch(spark, *records), given=given())
    rng.shuffle(records)
    cuts = sorted(rng.sample(range(1, 60), 3))
    groups = [records[a:b] for a, b in zip([0, *cuts], [*cuts, 60])]
    groups += [rng.choice(groups), rng.sample(records, 15)]
    rng.shuffle(groups)
    seen = {r for g in groups for r in g}
    assert seen == set(records)
    for group in groups:
        tables.upsert(parts, batch(spark, *group), given=given())
    assert stored(spark, whole) == stored(spark, parts)


def test_only_real_changes_are_handed_on(spark, table):
    seen = []

    def note(rows):
        seen.append(sorted((r["hash"], r["nTx"], r["_change"]) for r in rows.collect()))

    for rows in ((BLOCK, ("b", T2, 1, 1, 2, 1, "block")), (BLOCK,), (("a", T1, 1, 1, 1, 1, "block"),), (("a", T1, 8, 6, 1, 3, "block"), ("c", T1, 1, 1, 1, 1, "block")), (("a", T1, 8, 6, 1, 4, "block"),)):
        tables.upsert(table, batch(spark, *rows), given=given(), then=note)
    insert, update = "insert", "update"
    assert seen == [[("a", 7, insert), ("b", 1, insert)], [], [], [("a", 8, update), ("c", 1, insert)], []]


def test_replacing_goes_without_registers(spark, root, table):
    tables.upsert(table, batch(spark, BLOCK, ("b", T1, 1, 1, 2, 1, "block")))
    tables.replace(table, batch(spark, ("a", T1, 0, 0, 0, 0, "block")))
    assert stored(spark, table) == [("a", T1, 0, 0, 0), ("b", T1, 1, 1, 2)]
    tables.upsert(table, batch(spark, ("a", T1, 9, 9, 9, -5, "block")))
    assert stored(spark, table) == [("a", T1, 9, 9, 9), ("b", T1, 1, 1, 2)]


def test_only_columns_with_a_register_may_be_left_out(spark, table):
    with pytest.raises(ValueError, match="register"):
        tables.upsert(table, batch(spark, BLOCK), given={"height": F.lit(False)})


def test_range_read_skips_slices(spark, table):
    tables.upsert(table, batch(spark, BLOCK, ("b", T2, 1, 1, 2, 1, "block")))
    found = tables.read_range(spark, table, "timestamp", T2, datetime(2024, 1, 3))
    assert [r["hash"] for r in found.collect()] == ["b"]
    plan = physical(found)
    scan = plan[plan.rindex("FileScan") :]
    assert "day" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(timestamp" in scan


def staged(monkeypatch):
    """Names of the workspace tables that the store writes from now on."""
    names, real = [], tables.written

    def noted(df, path):
        names.append(path.rpartition("/")[2])
        return real(df, path)

    monkeypatch.setattr(tables, "written", noted)
    return names


def test_the_first_rows_of_a_table_are_written_once(spark, table, monkeypatch):
    names = staged(monkeypatch)
    tables.upsert(table, batch(spark, BLOCK, ("b", T2, 1, 1, 2, 1, "block")), given=given())
    assert names == []
    tables.upsert(table, batch(spark, ("a", T1, 8, 6, 1, 3, "block")), given=given())
    assert names == ["incoming", "merged"]  # stored rows are at stake: they stay in the workspace until the slices are replaced
    assert stored(spark, table) == [("a", T1, 8, 6, 1), ("b", T2, 1, 1, 2)]


def test_a_merge_that_tells_no_changes_does_not_look_for_them(spark, table, monkeypatch):
    tables.upsert(table, batch(spark, BLOCK))
    plans, real = {}, tables.written
    monkeypatch.setattr(tables, "written", lambda rows, path: plans.update({path.rpartition("/")[2]: physical(rows)}) or real(rows, path))
    tables.upsert(table, batch(spark, ("a", T1, 8, 6, 1, 3, "block")))
    assert "_was_" not in plans["merged"]
    tables.upsert(table, batch(spark, ("a", T1, 9, 6, 1, 4, "block")), then=lambda rows: None)
    assert "_was_" in plans["merged"]


def test_keys_to_delete_are_shuffled_once(spark, root, monkeypatch):
    table = tables.create(spark, tables.mempool_table(f"{root}/mempool", 4))
    df = spark.range(50).selectExpr("'t' || id AS txid", "id AS fee", "id AS weight", "1 AS sigops", "timestamp'2024-01-01' AS first_seen", "id AS seq")
    tables.upsert(table, df)
    plans, real = [], tables.written
    monkeypatch.setattr(tables, "written", lambda rows, path: plans.append(physical(rows)) or real(rows, path))
    removed = df.where("fee < 30").unionAll(df.where("fee < 20"))
    tables.delete(table, removed)
    assert "Exchange" not in plans[0]
    assert {r["txid"] for r in tables.read(spark, table).collect()} == {f"t{i}" for i in range(30, 50)}


def test_the_first_rows_go_in_all_or_none(spark, table):
    with pytest.raises(ValueError, match="must not be NULL"):
        tables.upsert(table, batch(spark, BLOCK, ("b", None, 1, 1, 1, 1, "block")), given=given())
    assert tables.read(spark, table).isEmpty()
    with pytest.raises(ValueError, match="must not be NULL"):
        tables.replace(table, batch(spark, BLOCK, ("b", None, 1, 1, 1, 1, "block")))
    tables.upsert(table, batch(spark))
    assert tables.read(spark, table).isEmpty()
    tables.upsert(table, batch(spark, BLOCK, BLOCK, HEADER), given=given())
    assert stored(spark, table) == [("a", T1, 7, 6, 1)]
