import json
import os
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlytics.operators.mempool import predict_block
from chainlytics.operators.rollups import daily_transactions
from chainlytics.plans import cycle, rollup_store, tables
from chainlytics.plans.rollup_store import Policy, Rollup
from chainlytics.schemas import BLOCKS
from chainlytics.sources.topics import landed_stream
from chainlytics.streaming import feed, ingest, late, mempool_state, rounds
from conftest import rows

START = 1704067200  # 2024-01-01


def land(folder, name, records, at):
    folder = Path(folder)
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
    os.utime(path, (at, at))


def record(i, n=1, **more):
    return {"hash": f"h{i}", "time": START + 3600 * i, "difficulty": 1.0, "height": i, "nTx": n} | more


def test_headers_then_blocks_in_small_batches(spark, root):
    table = tables.block_table(f"{root}/blocks")
    for k in range(3):  # six headers ahead of their blocks
        land(f"{root}/headers", f"{k}.json", [{"hash": f"h{i}", "time": START + 3600 * i, "difficulty": 1.0, "height": i} for i in (2 * k, 2 * k + 1)], 1000 + k)
    ingest.header_stream(spark, f"{root}/headers", table, f"{root}/c1", "header", 1).awaitTermination()
    assert [r["nTx"] for r in tables.read(spark, table).collect()] == [None] * 6
    land(f"{root}/blocks_in", "0.json", [record(0), record(1, 5), "{broken"], 2000)
    land(f"{root}/blocks_in", "1.json", [record(1, 5), record(2)], 2001)  # the boundary block again
    query = ingest.header_stream(spark, f"{root}/blocks_in", table, f"{root}/c2", "block", 1)
    query.awaitTermination()
    seen = [p["observedMetrics"]["headers"] for p in query.recentProgress if "headers" in p["observedMetrics"]]
    assert [(m["rows"], m["malformed"]) for m in seen] == [(3, 1), (2, 0)]  # counted in the one read of each batch
    found = {r["height"]: r["nTx"] for r in tables.read(spark, table).collect()}
    assert found == {0: 1, 1: 5, 2: 1, 3: None, 4: None, 5: None}
    assert [r["value"] for r in spark.read.text(ingest.malformed_path(table)).collect()] == ["{broken"]
    # late headers change nothing that a block brought, and a restart goes on where it stopped
    land(f"{root}/headers", "9.json", [{"hash": "h1", "time": START + 3600, "difficulty": 3.0, "height": 1}], 3000)
    ingest.header_stream(spark, f"{root}/headers", table, f"{root}/c1", "header", 1).awaitTermination()
    assert tables.read(spark, table).where("height = 1").first()["nTx"] == 5


def test_the_last_line_of_a_file_counts(spark, root):
    table = tables.block_table(f"{root}/blocks")
    land(f"{root}/in", "0.json", [record(0, 1), record(1, 2), record(0, 3), record(0, 9)], 1000)
    land(f"{root}/in", "1.json", [record(1, 7)], 1000)  # the same time: the later name counts
    ingest.header_stream(spark, f"{root}/in", table, f"{root}/c").awaitTermination()
    assert {r["height"]: r["nTx"] for r in tables.read(spark, table).collect()} == {0: 9, 1: 7}


@pytest.fixture
def arriving(spark, root):
    """Blocks over twelve days in four files, days mixed."""
    data = [(f"h{i}", datetime(2024, 1, 1) + timedelta(hours=7 * i), i % 5, 1, i) for i in range(40)]
    for k in range(4):
        part = spark.createDataFrame(data[k::4], BLOCKS)
        part.coalesce(1).write.mode("append").parquet(f"{root}/arriving")
    return spark.createDataFrame(data, BLOCKS)


def stream(spark, root):
    return landed_stream(spark, f"{root}/arriving", BLOCKS, "parquet", 1)


def test_streamed_rollup_equals_batch(spark, root, arriving):
    base = tables.block_table(f"{root}/blocks")
    volume = Rollup("volume", base, "timestamp", "1 day", {"transactions": "sum(nTx)"}, f"{root}/volume")
    ingest.rollup_stream(stream(spark, root), volume, f"{root}/c").awaitTermination()
    assert rows(rollup_store.read(spark, volume)) == rows(daily_transactions(arriving))
    assert rollup_store.mark(spark, volume) == datetime(2024, 1, 12)  # the newest day stays live
    assert rollup_store.read_stored(spark, volume).count() == 11


def test_blocks_read_twice_count_once_and_late_ones_count(spark, root, arriving):
    base = tables.block_table(f"{root}/blocks")
    volume = Rollup("volume", base, "timestamp", "1 day", {"transactions": "sum(nTx)"}, f"{root}/volume")
    for again in (arriving, arriving.where("height % 3 = 0"), arriving.where("height < 5").withColumn("nTx", F.lit(50))):
        again.coalesce(1).write.mode("append").parquet(f"{root}/arriving")
        ingest.rollup_stream(stream(spark, root), volume, f"{root}/c").awaitTermination()
    assert rows(rollup_store.read(spark, volume)) == rows(daily_transactions(tables.read(spark, base)))
    assert tables.read(spark, base).count() == 40


def test_streamed_upsert_equals_batch(spark, root, arriving):
    table = tables.block_table(f"{root}/blocks")
    ingest.upsert_stream(stream(spark, root), table, f"{root}/c").awaitTermination()
    assert rows(tables.read(spark, table)) == rows(arriving)


def test_policy_runs_with_arriving_blocks(spark, root, arriving):
    table = tables.block_table(f"{root}/blocks")
    ingest.upsert_stream(stream(spark, root), table, f"{root}/c").awaitTermination()
    volume = Rollup("volume", table, "timestamp", "1 day", {"transactions": "sum(nTx)"}, f"{root}/volume")
    policy = Policy("volume", "1 week", "1 hour", "5 minutes")
    query = ingest.policy_stream(
        stream(spark, root), volume, policy, f"{root}/c2", ingest.DRAIN, lambda: datetime(2024, 1, 9)
    )
    query.awaitTermination()
    assert rollup_store.mark(spark, volume) == datetime(2024, 1, 8)
    assert rows(rollup_store.read(spark, volume)) == rows(daily_transactions(arriving))


SIGHTING = "txid string, fee long, weight long, sigops int, first_seen timestamp, pos int"
SEEN = [datetime(2024, 1, 1), datetime(2024, 1, 2)]


def sight(spark, root, data, schema=SIGHTING, folder="in"):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{root}/{folder}")
    return landed_stream(spark, f"{root}/{folder}", T.StructType.fromDDL(schema), "parquet", 1)


def state_of(spark, root, batch=None):
    found = mempool_state.load(spark, f"{root}/c", batch).collect()
    return sorted((r.txid, r.fee, r.first_seen, r.first_ever_seen, r.pos) for r in found)


def test_streamed_mempool_keeps_places(spark, root):
    query = mempool_state.mempool_stream(sight(spark, root, [("b", 7, 4, 0, SEEN[0], 0), ("a", 1, 4, 0, SEEN[0], 1)]), f"{root}/c")
    query.awaitTermination()
    assert "rocksdbPutCount" in query.lastProgress["stateOperators"][0]["customMetrics"]
    # a restart goes on from the checkpoint
    mempool_state.mempool_stream(sight(spark, root, [("c", 2, 4, 0, SEEN[1], 0), ("a", 2, 4, 0, SEEN[1], 1)]), f"{root}/c").awaitTermination()
    # what left the snapshots stays in the state; a replaced entry keeps its place
    assert state_of(spark, root) == [("a", 2, SEEN[1], SEEN[0], 1), ("b", 7, SEEN[0], SEEN[0], 0), ("c", 2, SEEN[1], SEEN[1], 0)]
    assert state_of(spark, root, 0) == [("a", 1, SEEN[0], SEEN[0], 1), ("b", 7, SEEN[0], SEEN[0], 0)]
    block = predict_block(mempool_state.load(spark, f"{root}/c"), ties=["place", "pos"]).orderBy("position").collect()
    assert [r.txid for r in block] == ["b", "a", "c"]
    assert all(spark.conf.get(key, "unset") != value for key, value in mempool_state.SETTINGS.items())


def test_mined_transactions_stay_away_after_a_crash(spark, root):
    first = [("b", 7, 4, 0, SEEN[0], 0), ("a", 1, 4, 0, SEEN[0], 1), ("c", 1, 4, 0, SEEN[0], 2)]

    def run(seen):
        mined = landed_stream(spark, f"{root}/mined", T.StructType.fromDDL("txid string"), "parquet", 1)
        mempool_state.mempool_stream(seen, f"{root}/c", mined).awaitTermination()

    seen = sight(spark, root, first)
    sight(spark, root, [("z",)], "txid string", "mined")
    run(seen)
    sight(spark, root, [("a",), ("a",), ("never seen",)], "txid string", "mined")
    run(seen)
    want = [("b", 7, SEEN[0], SEEN[0], 0), ("c", 1, SEEN[0], SEEN[0], 2)]
    assert state_of(spark, root) == want
    # the batch was cut off before it was noted as complete: it runs again, from the version before it
    for name in max(Path(f"{root}/c/commits").glob("[0-9]*"), key=lambda p: int(p.name)), :
        name.unlink()
        (name.parent / f".{name.name}.crc").unlink(missing_ok=True)
    run(sight(spark, root, first))  # and all is sighted once more, later
    assert [r[0] for r in state_of(spark, root)] == ["b", "c"]


def test_sightings_in_any_order(spark, root):
    schema = SIGHTING + ", seq long"
    data = [("a", s, 4, 0, SEEN[0] + timedelta(hours=s), s + 10, s) for s in (3, 1, 2)]
    for row in data:
        rows_in = sight(spark, root, [row], schema).drop("seq")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    mempool_state.mempool_stream(stream, f"{root}/c").awaitTermination()
    assert rows_in.isStreaming and state_of(spark, root) == [("a", 3, data[0][4], data[1][4], 11)]


def test_a_policy_runs_without_rows_arriving(spark, root, arriving):
    import time

    table = tables.create(spark, tables.block_table(f"{root}/blocks"))
    tables.upsert(table, arriving.withColumn("seq", F.lit(0).cast("bigint")))
    volume = Rollup("volume", table, "timestamp", "1 day", {"transactions": "sum(nTx)"}, f"{root}/volume")
    policy = Policy("volume", "1 week", "1 hour", "1 second")
    query = ingest.policy_stream(ingest.clock(spark), volume, policy, f"{root}/c2", None, lambda: datetime(2024, 1, 9))
    try:
        for _ in range(120):
            if rollup_store.mark(spark, volume) is not None:
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert rollup_store.mark(spark, volume) == datetime(2024, 1, 8)


def test_feed_messages(spark, root, arriving):
    feed.feed_stream(stream(spark, root).drop("seq"), "new_block", f"{root}/c", f"{root}/out").awaitTermination()
    messages = [json.loads(r["value"]) for r in spark.read.text(f"{root}/out").collect()]
    assert {m["event"] for m in messages} == {"blocks_new_row"}
    assert sorted(json.loads(m["data"])["height"] for m in messages) == list(range(40))
    first = next(json.loads(m["data"]) for m in messages if '"height":0' in m["data"])
    assert first == {"hash": "h0", "timestamp": "2024-01-01T00:00:00.000000Z", "nTx": 0, "difficulty": 1, "height": 0}


def test_events_of_every_channel(spark):
    df = spark.createDataFrame([(1,)], "x int")
    for channel, event in feed.CHANNELS.items():
        message = json.loads(feed.envelopes(df, event).first()["value"])
        assert message == {"event": event, "data": '{"x":1}'}
    assert set(feed.CHANNELS) == {"new_block", "new_transactions", "new_ticker_price"}


def test_snapshot_answers_requests(spark, arriving):
    ticker = arriving.select("timestamp", F.col("height").cast("double").alias("price"))
    daily = daily_transactions(arriving)
    asked = spark.createDataFrame(
        [('{"event": "initial_data", "payload": null}',), ('{"event": "other"}',), ("junk",)], "value string"
    )
    answers = feed.respond(asked, arriving, daily, ticker).collect()
    assert sorted(r["event"] for r in answers) == [
        "blocks_initial_data",
        "ticker_price_initial_data",
        "transactions_daily_initial_data",
    ]
    blocks = next(json.loads(r["value"]) for r in answers if r["event"] == "blocks_initial_data")
    assert [b["height"] for b in json.loads(blocks["data"])] == list(range(39, 29, -1))


def test_appended_rows_are_committed_once(spark, root, arriving):
    for _ in range(2):  # the second run finds nothing new
        ingest.append_stream(stream(spark, root), f"{root}/log", f"{root}/c").awaitTermination()
    assert spark.read.parquet(f"{root}/log").count() == 40


def test_triggers():
    assert ingest.every(ingest.BLOCK_POLL) == {"processingTime": "2 seconds"}
    assert ingest.every(ingest.HEIGHT_POLL) == {"processingTime": "10 seconds"}


def test_an_old_block_reads_and_writes_old_slices_only(spark, root, arriving, monkeypatch):
    base = tables.block_table(f"{root}/blocks")
    volume = Rollup("volume", base, "timestamp", "1 day", {"transactions": "sum(nTx)"}, f"{root}/volume")
    ingest.rollup_stream(stream(spark, root), volume, f"{root}/c").awaitTermination()
    opened = []
    real = tables._folders
    monkeypatch.setattr(tables, "_folders", lambda *args: opened.append(args[3]) or real(*args))
    arriving.where("height = 2").withColumn("nTx", F.lit(50)).coalesce(1).write.mode("append").parquet(f"{root}/arriving")
    ingest.rollup_stream(stream(spark, root), volume, f"{root}/c").awaitTermination()
    assert {name for names in opened for name in names} == {"day=2024-01-01", "month=2024-01-01"}
    assert rows(rollup_store.read(spark, volume)) == rows(daily_transactions(tables.read(spark, base)))


def test_rows_behind_the_mark_go_to_the_side(spark, root):
    schema = T.StructType.fromDDL("at timestamp, n int, name string")
    table, day = late.bucket_table(f"{root}/days"), datetime(2024, 1, 1)

    def run(*data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        rows_in = landed_stream(spark, f"{root}/in", schema, "parquet", 1).drop("seq")
        late.late_stream(rows_in, table, f"{root}/c", "at", "n", "1 day", "1 day").awaitTermination()

    run((day, 1, "a"), (day, None, "b"), (None, 9, "no time"), (day + timedelta(days=1, hours=5), 2, "c"))
    run((day + timedelta(hours=1), 4, "not behind yet"))  # the mark is at 05:00 of the day
    run((day + timedelta(days=3), 8, "d"))
    run((day + timedelta(hours=2), 16, "late"), (day + timedelta(days=1), 32, "late too"), (day + timedelta(days=2), None, "in time"))
    found = {r["time"].day: (r["total"], r["rows"]) for r in late.buckets(spark, table).collect()}
    assert found == {1: (5, 3), 2: (2, 1), 3: (0, 1), 4: (8, 1)}
    behind = late.late_rows(spark, table, schema)
    assert {tuple(r) for r in behind.collect()} == {(day + timedelta(days=1), 32, "late too"), (day + timedelta(hours=2), 16, "late")}
    assert late.late_rows(spark, late.bucket_table(f"{root}/none"), schema).isEmpty()


def test_each_round_audits_the_highest_block_it_sees(spark, root):
    t = [datetime(2024, 1, 1, h) for h in range(10)]
    path, audits = f"{root}/predictions", rounds.audit_table(f"{root}/audits")
    pick = "txid string, position int, fee long, weight long"
    heights = T.StructType.fromDDL("block int, mined_at timestamp")
    bodies = spark.createDataFrame([(1, "x"), (2, "x"), (3, "a"), (3, "z"), (5, "c")], "block int, txid string")
    again = []

    def run(*mined):
        spark.createDataFrame(list(mined), heights).coalesce(1).write.mode("append").parquet(f"{root}/heights")
        new = landed_stream(spark, f"{root}/heights", heights, "parquet", 1)
        rounds.cycle_stream(new, bodies, path, audits, f"{root}/c", lambda: again.append(1) or spark.createDataFrame([], pick), ingest.DRAIN).awaitTermination()
        return sorted((r["prediction_time"].hour, r["block_height"], r["matches"], r["added"], r["missing"], r["accuracy"]) for r in tables.read(spark, audits).where("prediction_time < '2024-01-02'").collect())

    assert run((1, t[0])) == [] and len(again) == 1  # no prediction before the block, one after it
    for at, names in ((t[1], "ab"), (t[5], "")):
        cycle.save_prediction(spark.createDataFrame([(n, 0, 1, 4) for n in names], pick), path, at)
    assert run((3, t[3])) == [(1, 3, 1, 1, 1, 0.5)]
    assert run((2, t[2]), (2, t[2])) == [(1, 3, 1, 1, 1, 0.5)]  # a lower one that comes later is passed over
    assert run((5, t[6]), (4, t[5])) == [(1, 3, 1, 1, 1, 0.5), (5, 5, 0, 1, 0, 0.0)]
    assert len(again) == 4


def test_a_block_that_is_read_twice_is_told_once(spark, root, arriving):
    table = tables.block_table(f"{root}/blocks")

    def run():
        feed.change_stream(stream(spark, root), table, "new_block", f"{root}/c", f"{root}/out").awaitTermination()
        return sorted(json.loads(json.loads(r["value"])["data"])["height"] for r in spark.read.text(f"{root}/out").collect())

    assert run() == list(range(40))
    arriving.where("height < 9").coalesce(1).write.mode("append").parquet(f"{root}/arriving")
    assert run() == list(range(40))
    arriving.where("height = 4").withColumn("nTx", F.lit(99)).coalesce(1).write.mode("append").parquet(f"{root}/arriving")
    assert run() == sorted([*range(40), 4])
    last = max(Path(f"{root}/c/commits").glob("[0-9]*"), key=lambda p: int(p.name))  # cut off before it was complete
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert run() == sorted([*range(40), 4])


def test_a_landed_file_is_read_by_several_tasks(spark, root):
    """A micro-batch is one file; with one row group it would be one task's work."""
    from glob import glob

    from pyarrow import parquet

    from chainlytics.plans import queries

    events = spark.range(900_000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "hash(id) % 1000L AS user_id",
        "'view' AS event_type", "rand(1) AS value", "'{\"k\": ' || id % 100 || '}' AS props",
    )
    events.write.parquet(f"{root}/tables/events.parquet")
    queries._event_stream(spark, f"{root}/tables", root)
    files = [parquet.ParquetFile(path).metadata for path in glob(f"{root}/events/*.parquet")]
    assert len(files) == 3 and sum(f.num_rows for f in files) == 900_000
    assert min(f.num_row_groups for f in files) > 1
