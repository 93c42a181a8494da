"""Time-bucket aggregates. All are partial/final hash aggregates: a hot bucket is summed
map-side before anything is shuffled, and the shuffled rows are buckets, not blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlytics.functions import time_bucket


def rollup(df: DataFrame, time: str, width: str, alias: str = "time", **measures: Column) -> DataFrame:
    """One row per non-empty bucket; empty buckets give no row."""
    return df.groupBy(time_bucket(time, width).alias(alias)).agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )


def transactions_per(blocks: DataFrame, width: str, alias: str = "time") -> DataFrame:
    return rollup(blocks, "timestamp", width, alias, transactions=F.sum("nTx"))


def daily_transactions(blocks: DataFrame) -> DataFrame:
    return transactions_per(blocks, "1 day")


def hourly_transactions(blocks: DataFrame) -> DataFrame:
    return transactions_per(blocks, "1 hour")


def five_minute_transactions(blocks: DataFrame) -> DataFrame:
    return transactions_per(blocks, "5 minutes", alias="bucket")


def daily_height(blocks: DataFrame) -> DataFrame:
    return rollup(blocks, "timestamp", "1 day", height=F.max("height"))


def daily_difficulty(blocks: DataFrame) -> DataFrame:
    return rollup(blocks, "timestamp", "1 day", difficulty=F.max("difficulty"))


def rebucket(stored: DataFrame, width: str, value: str, time: str = "time", alias: str = "time") -> DataFrame:
    """Sum of sums: a rollup read again at the same or a wider bucket."""
    return rollup(stored, time, width, alias, **{value: F.sum(value)})


def bucket_stats(totals: DataFrame, value: str = "transactions") -> DataFrame:
    """Mean and sample standard deviation of bucket totals; one bucket has no deviation (NULL)."""
    return totals.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("stddev"))


def last_not_null(df: DataFrame, value: str, time: str) -> DataFrame:
    """Value of the latest row that has one: the reducer of single-number panels."""
    return df.agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(time))).alias(value))
