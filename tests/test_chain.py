import pytest

from chainlytics.operators import chain
from chainlytics.schemas import CHAIN_TIP
from pyspark.sql import types as T

SCHEMA = "hash string, previousblockhash string, timestamp timestamp, difficulty long, height int"


def headers(spark, links):
    """links: hash -> (parent, height)"""
    return spark.createDataFrame([(h, p, None, 1, n) for h, (p, n) in links.items()], SCHEMA)


def line(n):
    return {f"m{i}": (f"m{i - 1}" if i else None, i) for i in range(n)}


def tips(spark, *found):
    schema = T.StructType([T.StructField("tips", T.ArrayType(CHAIN_TIP))])
    return spark.createDataFrame([(list(found),)], schema)


def names(df):
    return {r["hash"] for r in df.collect()}


@pytest.mark.parametrize("length, start", [(1, 0), (2, 0), (3, 1), (17, 0), (64, 5), (65, 0)])
def test_walk_lengths(spark, length, start):
    df = headers(spark, line(length))
    found = names(chain.walk(df, f"m{length - 1}", length - 1, start))
    assert found == {f"m{i}" for i in range(start, length)}


def test_forks_stay_out(spark):
    links = line(30)
    links |= {f"f{i}": (f"m{i - 1}", i) for i in range(5, 25)}  # dead ends
    links |= {"g8": ("f7", 8), "g9": ("g8", 9)}  # a longer branch
    df = headers(spark, links)
    assert names(chain.walk(df, "m29", 29)) == set(line(30))
    assert names(chain.walk(df, "g9", 9, 4)) == {"g9", "g8", "f7", "m6", "m5", "m4"}


def test_walk_ends_where_a_header_is_missing(spark):
    links = line(20)
    del links["m7"]
    assert names(chain.walk(headers(spark, links), "m19", 19)) == {f"m{i}" for i in range(8, 20)}


def test_nothing_above_the_tip(spark):
    df = headers(spark, line(4))
    assert chain.walk(df, "m3", 3, 4).isEmpty()


def test_active_tip_gives_no_headers(spark):
    df = headers(spark, line(5))
    assert chain.process_headers(df, tips(spark, ("m4", 4, "active"), ("m3", 3, "valid-fork")), 0).isEmpty()
    found = chain.process_headers(df, tips(spark, ("m4", 4, "headers-only"), ("m3", 3, "active")), 2)
    assert names(found) == {"m2", "m3", "m4"}
    assert found.columns == ["hash", "timestamp", "difficulty", "height"]
    assert chain.process_headers(df, tips(spark), 0).isEmpty()


def test_canonical_blocks(spark):
    links = line(6) | {"f3": ("m2", 3)}
    blocks = spark.createDataFrame([(h, 1) for h in links], "hash string, nTx int")
    assert names(chain.canonical_only(blocks, headers(spark, links), "m5", 5)) == set(line(6))
