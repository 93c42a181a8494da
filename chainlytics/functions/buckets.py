"""Fixed-width time buckets, for columns and for literals."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

UNIT_MICROS = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
    "month": 30 * 86_400_000_000,  # only as a policy offset, where a month counts as 30 days
}

# Buckets are counted from a Monday, so week buckets start on Mondays.
ORIGIN = datetime(2000, 1, 3)
EPOCH = datetime(1970, 1, 1)


def width_micros(width: str) -> int:
    """``'5 minutes'`` -> microseconds."""
    count, unit = width.split()
    return int(count) * UNIT_MICROS[unit.rstrip("s")]


def _micros(at: datetime) -> int:
    return (at - EPOCH) // timedelta(microseconds=1)


def moment(value: date | datetime | Column) -> Column:
    """A literal in UTC, whatever time zone the driver's machine is in. Columns pass through."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime) and value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.lit(value)


def time_bucket(column: str | Column, width: str) -> Column:
    """Start of the bucket holding ``column``; TIMESTAMP and TIMESTAMP_NTZ keep their type."""
    if "month" in width:
        raise ValueError("buckets have a fixed length; months do not")
    size = width_micros(width)
    offset = _micros(ORIGIN) % size
    return F.window(
        column, f"{size} microseconds", startTime=f"{offset} microseconds"
    ).getField("start")


def register_sql(spark: SparkSession) -> None:
    """Give SQL text the function ``time_bucket('1 hour', ts)``. It is a SQL function, so Spark puts its
    body into the query and folds the width into one constant."""
    sizes = " ".join(f"WHEN '{unit}' THEN {size}" for unit, size in UNIT_MICROS.items() if unit != "month")
    size = f"(bigint(split(width, ' ')[0]) * CASE rtrim('s', split(width, ' ')[1]) {sizes} END)"
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION time_bucket(width STRING, ts TIMESTAMP) RETURNS TIMESTAMP
        RETURN timestamp_micros(unix_micros(ts) - pmod(unix_micros(ts) - {_micros(ORIGIN)}, {size}))"""
    )


def bucket_floor(at: datetime, width: str) -> datetime:
    """Start of the bucket a literal (UTC, naive) lies in."""
    size = width_micros(width)
    return at - timedelta(microseconds=(_micros(at) - _micros(ORIGIN)) % size)


def bucket_ceil(at: datetime, width: str) -> datetime:
    """First bucket start that is not before the literal."""
    floor = bucket_floor(at, width)
    return floor if floor == at else floor + timedelta(microseconds=width_micros(width))
