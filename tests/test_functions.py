from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chainlytics import functions as fn
from chainlytics.schemas import MEMPOOL_SNAPSHOT


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, width, start",
    [
        ("2024-01-20 13:47:11.5", "1 day", datetime(2024, 1, 20)),
        ("2024-01-20 13:47:11.5", "1 hour", datetime(2024, 1, 20, 13)),
        ("2024-01-20 13:47:11.5", "5 minutes", datetime(2024, 1, 20, 13, 45)),
        ("2024-01-20 13:47:11.5", "1 week", datetime(2024, 1, 15)),
        ("2024-01-15 00:00:00", "1 week", datetime(2024, 1, 15)),
        ("1969-12-31 23:59:59", "1 day", datetime(1969, 12, 31)),
    ],
)
def test_time_bucket(spark, text, width, start):
    df = spark.createDataFrame([(text,)], "t string")
    for kind in ("timestamp", "timestamp_ntz"):
        found = df.select(F.col("t").cast(kind).alias("t")).select(fn.time_bucket("t", width).alias("b"))
        assert found.dtypes == [("b", kind)]
        assert found.select(F.col("b").cast("string")).first()[0] == str(start)


@pytest.mark.parametrize("width", ["1 day", "1 hour", "5 minutes", "1 week", "2 weeks", "7 hours"])
def test_sql_buckets_are_the_same(spark, width):
    fn.register_sql(spark)
    df = spark.sql("SELECT timestamp_micros(id * 12345678901234 - 99999999999999) AS t FROM range(300)")
    df.createOrReplaceTempView("moments")
    found = spark.sql(f"SELECT t, time_bucket('{width}', t) AS b FROM moments")
    assert sorted(found.collect()) == sorted(df.select("t", fn.time_bucket("t", width).alias("b")).collect())
    assert "_bucket" not in found._jdf.queryExecution().optimizedPlan().toString()  # put in, not called


def test_literals_are_utc_on_any_machine(spark, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        assert one(spark, fn.moment(datetime(2024, 1, 1, 5)).cast("string")) == "2024-01-01 05:00:00"
    finally:
        monkeypatch.undo()
        time.tzset()


def test_months_are_no_buckets():
    with pytest.raises(ValueError):
        fn.time_bucket("t", "1 month")


def test_bucket_bounds_of_literals():
    moment = datetime(2024, 1, 20, 13, 47)
    assert fn.bucket_floor(moment, "1 day") == datetime(2024, 1, 20)
    assert fn.bucket_ceil(moment, "1 day") == datetime(2024, 1, 21)
    assert fn.bucket_ceil(datetime(2024, 1, 20), "1 day") == datetime(2024, 1, 20)
    assert fn.bucket_floor(datetime(2024, 1, 21), "1 week") == datetime(2024, 1, 15)


def test_coins_are_cut_by_default_and_exact_on_request(spark):
    df = spark.createDataFrame([(0.29,), (0.00001,), (1.5,)], "fee double")
    cut = [r[0] for r in df.select(fn.to_smallest_unit("fee")).collect()]
    exact = [r[0] for r in df.select(fn.to_smallest_unit("fee", exact=True)).collect()]
    assert cut == [int(0.29 * 100000000), int(0.00001 * 100000000), 150000000]
    assert cut[0] == 28999999
    assert exact == [29000000, 1000, 150000000]


def test_difficulty_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (92671576265161.06,), (0.49,)], "d double")
    assert [r[0] for r in df.select(fn.as_bigint("d")).collect()] == [3, -3, 92671576265161, 0]


def test_epoch_is_utc(spark):
    assert one(spark, fn.epoch_to_time(F.lit(1726749724)).cast("string")) == "2024-09-19 12:42:04"


def test_number_strips_raw_output(spark):
    assert one(spark, fn.number(F.lit(" 861970\n"))) == 861970


def test_weight_must_be_positive(spark):
    df = spark.createDataFrame([(5, 0)], "fee long, weight long")
    with pytest.raises(Exception, match="weight must be positive"):
        df.select(fn.fee_rate()).collect()


def test_rate_bands_rise_with_rates(spark):
    rates = [0.0, 5e-324, 1e-9, 0.5, 0.999999, 1.0, 1.0001, 1.003, 7.0, 1e12]
    df = spark.createDataFrame([(r,) for r in rates], "rate double")
    bands = [r[0] for r in df.select(fn.rate_band("rate")).collect()]
    assert bands == sorted(bands)
    assert bands[0] < bands[1]


def test_two_decimals(spark):
    df = spark.createDataFrame([(0.125,), (2.0,), (1234567.891,)], "x double")
    assert [r[0] for r in df.select(fn.two_decimals(F.col("x"))).collect()] == ["0.13", "2.00", "1234567.89"]


def test_json_keeps_microseconds_and_nulls(spark):
    df = spark.sql("SELECT timestamp '2024-01-01 00:00:00.123456' AS t, CAST(NULL AS int) AS n")
    text = df.select(fn.encode(F.struct("*")).alias("j")).first()["j"]
    assert text == '{"t":"2024-01-01T00:00:00.123456Z","n":null}'
    back = df.select(fn.decode(F.lit(text), df.schema).alias("r")).select("r.*")
    assert back.collect() == df.collect()


def test_broken_json_is_null(spark):
    assert one(spark, fn.decode(F.lit("{no"), MEMPOOL_SNAPSHOT)) is None
