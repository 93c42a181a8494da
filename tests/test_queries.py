"""Every registered query against its SQL twin, on the smallest driver tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from chainlytics.plans.oracles import ORACLES
from chainlytics.plans.queries import QUERIES
from conftest import physical

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    found = driver.entry(spark)
    assert found.columns == ["stddev_range", "days_in_range"] and found.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = driver.queries()[name](spark, FOLDER)
    want = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in want.description]
    columns = sorted(got.columns)
    assert columns == sorted(names)
    found = sorted(tuple(normal(r[c]) for c in columns) for r in got.collect())
    at = [names.index(c) for c in columns]
    assert found == sorted(tuple(normal(r[i]) for i in at) for r in want.fetchall())


def test_bucket_totals_are_shuffled_once_for_statistics_and_bands(spark):
    found = driver.queries()["sigma_hourly"](spark, FOLDER)
    found.collect()
    final = physical(found).split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("FileScan") == 1


def test_latest_rows_are_a_top_k(spark):
    assert "TakeOrderedAndProject" in physical(driver.queries()["latest_blocks"](spark, FOLDER))


def test_scans_read_only_what_a_query_needs(spark):
    plan = physical(driver.queries()["daily_height"](spark, FOLDER))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_range_filters_reach_the_scan(spark):
    plan = physical(driver.queries()["sigma_hourly_range"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan


def test_audit_is_one_shuffle_on_block_and_transaction(spark):
    plan = physical(driver.queries()["audit_status"](spark, FOLDER))
    assert plan.count("Exchange") == 1 and "Join" not in plan
