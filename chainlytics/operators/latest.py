"""Latest-N reads, range reads and the history-plus-live series."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlytics.functions import moment
from chainlytics.operators.rollups import daily_height

SLICE = "day"  # the column that block tables are sliced by
SNAPSHOT_ROWS = 10  # fixed value: rows a snapshot carries


def in_range(
    df: DataFrame, time: str, start: datetime | Column | None = None, end: datetime | Column | None = None
) -> DataFrame:
    """Both ends included; an end that is not given is open. Literals are in UTC. On a table sliced by
    the day of its ``timestamp`` the matching filter on the slices is added."""
    sliced = SLICE in df.columns and time == "timestamp"
    if start is not None:
        df = df.where(F.col(time) >= moment(start))
        df = df.where(F.col(SLICE) >= moment(start).cast("date")) if sliced else df
    if end is not None:
        df = df.where(F.col(time) <= moment(end))
        df = df.where(F.col(SLICE) <= moment(end).cast("date")) if sliced else df
    return df


def latest(df: DataFrame, by: str, rows: int = SNAPSHOT_ROWS, ties: tuple[str, ...] = ()) -> DataFrame:
    """First rows in falling order, NULLs first; planned as a per-task top-k, never a full sort."""
    return df.orderBy(F.desc_nulls_first(by), *[F.desc_nulls_first(t) for t in ties]).limit(rows)


def latest_in_slices(df: DataFrame, by: str, rows: int = SNAPSHOT_ROWS, ties: tuple[str, ...] = (), slices: str = SLICE) -> DataFrame:
    """:func:`latest` of a sliced table: the order columns tell which slices hold the rows, and only
    those are then read with all columns."""
    ahead = latest(df.select(by, *[t for t in ties if t != by], slices), by, rows, ties)
    names = [r[0] for r in ahead.select(slices).distinct().collect()]
    return latest(df.where(F.col(slices).isin(names)), by, rows, ties)


def newest_slice(df: DataFrame, slices: str = SLICE) -> DataFrame:
    """Rows of the newest slice of a sliced table. Which one that is comes from the slice column alone, as a subquery that
    prunes the scan; where the table itself is at hand, :func:`chainlytics.plans.tables.newest` lists folders instead."""
    return df.where(F.col(slices) == df.agg(F.max(slices)).scalar())


def latest_difficulty(blocks: DataFrame) -> DataFrame:
    """Difficulty of the newest row, also when that row came from a header only."""
    return latest(blocks, "timestamp", 1, ("height", "hash")).select("difficulty")


def max_height(blocks: DataFrame) -> DataFrame:
    return blocks.agg(F.max("height").alias("height"))


def height_series(
    stored: DataFrame, blocks: DataFrame, as_of: date | datetime | Column | None = None
) -> DataFrame:
    """Stored daily heights before ``as_of`` (default: today) joined with live ones from it on,
    newest first. Both sides hold one row per day, so the join has no hot key."""
    day = F.current_date() if as_of is None else moment(as_of)
    history = stored.where(F.col("time") < day).select("time", F.col("height").alias("stored"))
    recent = blocks.where(F.col("timestamp") >= day)
    if SLICE in blocks.columns:
        recent = recent.where(F.col(SLICE) >= day.cast("date"))
    live = daily_height(recent).select("time", F.col("height").alias("live"))
    return (
        history.join(live, "time", "full_outer")
        .select(
            "time",
            F.greatest(F.coalesce("stored", F.lit(0)), F.coalesce("live", F.lit(0))).alias("height"),
        )
        .orderBy(F.desc_nulls_first("time"))
    )
