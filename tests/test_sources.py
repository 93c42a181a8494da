import json

import pytest

from chainlytics.operators.mempool import mempool_state, predict_block
from chainlytics.sources import records, topics
from conftest import rows


def land(root, name, text):
    from pathlib import Path

    folder = Path(root) / name
    folder.mkdir(exist_ok=True)
    (folder / f"{len(list(folder.iterdir())):03d}.json").write_text(text)
    return str(folder)


def header(i, **more):
    return json.dumps({"hash": f"h{i}", "time": 1700000000 + i, "difficulty": i + 0.5, "height": i, "nTx": 2 * i} | more)


def test_headers(spark, root):
    path = land(root, "headers", "\n".join([header(0), header(1, previousblockhash="h0"), "{broken", header(2)]))
    found = records.read_headers(spark, path).orderBy("height").collect()
    assert [(r["hash"], r["difficulty"], r["nTx"], r["previousblockhash"]) for r in found] == [
        ("h0", 1, 0, None),
        ("h1", 2, 2, "h0"),
        ("h2", 3, 4, None),
    ]
    assert records.read_headers(spark, path, 1, 1).count() == 1
    raw = records.read_records(spark, path, records.HEADER_RECORD).cache()
    assert records.malformed(raw).count() == 1


def test_tips_keep_their_order(spark, root):
    tips = [{"hash": "b", "height": 2, "status": "headers-only"}, {"hash": "a", "height": 1, "status": "active"}]
    path = land(root, "tips", json.dumps(tips, indent=1))
    assert [t["hash"] for t in records.read_tips(spark, path).first()["tips"]] == ["b", "a"]


def test_the_newest_reply_of_the_node_counts(spark, root):
    import os
    from pathlib import Path

    from chainlytics.operators.chain import candidate_tip

    folder = land(root, "replies", json.dumps([{"hash": "old", "height": 1, "status": "valid-headers"}]))
    land(root, "replies", json.dumps([{"hash": "new", "height": 2, "status": "active"}]))
    first, second = sorted(Path(folder).iterdir())
    os.utime(first, (1000, 1000))
    os.utime(second, (2000, 2000))
    assert candidate_tip(records.read_tips(spark, folder)).isEmpty()
    os.utime(first, (3000, 3000))
    assert candidate_tip(records.read_tips(spark, folder)).first()["hash"] == "old"


def info(spark, root, **values):
    name = f"info{sum(map(int, values.values()))}"
    return records.read_chain_info(spark, land(root, name, json.dumps(values | {"chain": "main"}, indent=1)))


def test_blocks_ahead(spark, root):
    blocks = spark.createDataFrame([(i,) for i in range(10)], "height int")
    here = info(spark, root, blocks=7, headers=9, initialblockdownload=False)
    assert rows(records.blocks_ahead(blocks, here, 5)) == [(5,), (6,), (7,)]  # the boundary is read again
    assert records.blocks_ahead(blocks, here, 7).isEmpty()


@pytest.mark.parametrize(
    "headers, downloading, start_block, start_header, want",
    [(9, False, 7, 3, [(7,)]), (9, False, 3, 5, [(5,)]), (9, True, 7, 3, []), (7, False, 7, 3, []), (9, False, 3, 9, [])],
)
def test_headers_start(spark, root, headers, downloading, start_block, start_header, want):
    here = info(spark, root, blocks=7, headers=headers, initialblockdownload=downloading)
    assert rows(records.headers_start(here, start_block, start_header)) == want


def test_block_bodies(spark, root):
    path = land(root, "bodies", json.dumps({"height": 5, "hash": "x", "tx": ["a", "b", "a"]}))
    assert rows(records.read_block_bodies(spark, path)) == [(5, "a"), (5, "a"), (5, "b")]


def test_mempool_snapshots(spark, root):
    snapshot = {"z": {"fee": 0.29, "weight": 400, "sigops": 4}, "a": {"fee": 0.29, "weight": 400}}
    path = land(root, "mempool", json.dumps(snapshot, indent=1))
    found = records.read_mempool(spark, path)
    assert rows(found.select("txid", "fee", "weight", "sigops", "pos")) == [
        ("a", 28999999, 400, 0, 1),
        ("z", 28999999, 400, 4, 0),
    ]
    assert records.read_mempool(spark, path, exact=True).first()["fee"] == 29000000
    # equal rates: the entry listed first comes first
    block = predict_block(mempool_state(found), ties=["place", "pos"]).orderBy("position").collect()
    assert [r["txid"] for r in block] == ["z", "a"]


def test_mempool_lines(spark, root):
    path = land(root, "lines", '{"txid":"a","fee":1.5,"weight":4}\n{"txid":"b","fee":1,"weight":8,"sigops":2}')
    found = records.read_mempool_lines(spark, path)
    assert rows(found.select("txid", "fee", "weight", "sigops")) == [("a", 150000000, 4, 0), ("b", 100000000, 8, 2)]


def test_topics(spark, root):
    assert set(topics.TOPICS) == {
        "raw-btc-blocks",
        "raw-btc-transactions",
        "raw-btc-transactions-backfill",
        "raw-price-btcusd-binance",
        "raw-ticker-btcusd-binance",
    }
    options = topics.broker_options("raw-btc-blocks", "host:9092", per_trigger=100)
    assert options["subscribe"] == "raw-btc-blocks" and options["maxOffsetsPerTrigger"] == "100"
    path = land(root, "topic", header(1))
    stream = topics.topic_stream(spark, topics.RAW_BLOCKS, folder=path)
    assert stream.isStreaming and stream.columns[-1] == "seq"
