"""The seven dashboard panels as named, parameterized queries over the catalog's views."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlytics.functions import moment, register_sql
from chainlytics.operators.latest import height_series, in_range, latest_difficulty, max_height, newest_slice
from chainlytics.operators.rollups import last_not_null, rebucket, transactions_per
from chainlytics.operators.sigma import sigma_histogram
from chainlytics.plans import tables
from chainlytics.plans.tables import KeyedTable

# Names of the views, macros of the range, and the range a dashboard shows at first. A
# panel without a range shows all rows; pass these two to see what the dashboard starts with.
BLOCKS = "l0_btc_blocks"
VOLUME = "l1_btc_transactions_volume_daily"
HEIGHT = "l1_btc_block_height_daily"
DIFFICULTY = "l1_btc_block_difficulty_daily"
MACROS = {"$__timeFrom()": "time_from", "$__timeTo()": "time_to"}
DEFAULT_FROM = datetime(2023, 1, 1)
DEFAULT_TO = datetime(2024, 12, 31)


def _series(view: str, value: str) -> Callable[..., DataFrame]:
    def run(spark: SparkSession, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        rows = in_range(spark.table(view), "time", start, end)
        return rows.select("time", value).orderBy(F.asc_nulls_last("time"))

    return run


def _sigma_hourly(spark: SparkSession, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    rows = in_range(spark.table(BLOCKS), "timestamp", start, end)
    return sigma_histogram(transactions_per(rows, "1 hour"), "transactions", "hours_in_range")


def _sigma_daily(spark: SparkSession, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    rows = in_range(spark.table(VOLUME), "time", start, end)
    return sigma_histogram(rebucket(rows, "1 day", "transactions"), "transactions", "days_in_range")


def _height_series(spark: SparkSession, as_of: date | None = None) -> DataFrame:
    return height_series(spark.table(HEIGHT), spark.table(BLOCKS), as_of)


def _height(spark: SparkSession, blocks: KeyedTable | None = None) -> DataFrame:
    return max_height(spark.table(BLOCKS) if blocks is None else tables.read_footers(spark, blocks))


def _difficulty(spark: SparkSession, blocks: KeyedTable | None = None) -> DataFrame:
    return latest_difficulty(newest_slice(spark.table(BLOCKS)) if blocks is None else tables.newest(spark, blocks))


PANELS: dict[str, Callable[..., DataFrame]] = {
    "transactions_daily": _series(VOLUME, "transactions"),
    "transactions_sigma_hourly": _sigma_hourly,
    "transactions_sigma_daily": _sigma_daily,
    "block_height": _height,
    "block_height_daily": _height_series,
    "block_difficulty": _difficulty,
    "block_difficulty_daily": _series(DIFFICULTY, "difficulty"),
}


def panel(spark: SparkSession, name: str, **params) -> DataFrame:
    """Run one panel, e.g. ``panel(spark, "transactions_daily", start=..., end=...)``. Either end may be
    left out: the range is then open there. The single numbers of the block table are polled; given the table as
    ``blocks`` they come from file footers and from its newest folder."""
    return PANELS[name](spark, **params)


def panel_sql(
    spark: SparkSession, text: str, start: datetime = DEFAULT_FROM, end: datetime = DEFAULT_TO, **args
) -> DataFrame:
    """A panel given as SQL text: it may use ``time_bucket``, the range macros and named parameters."""
    register_sql(spark)
    for macro, name in MACROS.items():
        text = text.replace(macro, f":{name}")
    bounds = {"time_from": moment(start), "time_to": moment(end)}
    return spark.sql(text.rstrip().rstrip(";"), args=bounds | args)


def stat(rows: DataFrame, value: str, time: str | None = None) -> DataFrame:
    """Reduce a panel's rows to the one number it shows: the last that is not NULL."""
    if time is None:  # a single row already
        return rows.where(F.col(value).isNotNull()).select(value).limit(1)
    return last_not_null(rows, value, time)
