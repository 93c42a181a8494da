"""Stored rollups that stay current: windowed refreshes plus a live tail.

A rollup keeps its buckets in a Parquet table and, next to it, a high-water mark. Reading gives the
stored buckets below the mark and a live aggregate of the base rows from the mark on, so new blocks
show at once. A refresh recomputes whole buckets inside a window that trails the present; changes
older than the window stay invisible until a full refresh, as the policy never looks there again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlytics import storage
from chainlytics.functions import bucket_ceil, bucket_floor, moment, width_micros
from chainlytics.operators.rollups import rollup as aggregate
from chainlytics.plans import tables
from chainlytics.plans.tables import MONTH, KeyedTable


@dataclass(frozen=True)
class Rollup:
    """Buckets of a base table, or of another rollup: its buckets are then the rows, with their ``time``."""

    name: str
    base: KeyedTable | Rollup
    time: str
    width: str
    measures: dict[str, str]
    path: str

    def __post_init__(self):
        if isinstance(self.base, Rollup) and (self.time != "time" or width_micros(self.width) % width_micros(self.base.width)):
            raise ValueError(f"{self.name}: buckets must be made of whole buckets of {self.base.name}, by their time")

    @property
    def mark_path(self) -> str:
        return f"{self.path}__mark"

    @property
    def table(self) -> KeyedTable:
        """The table at the bottom of all rollups below."""
        return self.base.table if isinstance(self.base, Rollup) else self.base

    def of(self, rows: DataFrame) -> DataFrame:
        """The rollup of any rows shaped like the base."""
        return aggregate(rows, self.time, self.width, **{n: F.expr(e) for n, e in self.measures.items()})

    def store(self, spark: SparkSession) -> KeyedTable:
        base = self.base.store(spark) if isinstance(self.base, Rollup) else self.base
        schema = self.of(spark.createDataFrame([], base.columns)).schema
        return KeyedTable.by_time(self.path, schema, ("time",), "time", MONTH, versioned=False)


@dataclass(frozen=True)
class Policy:
    """Refresh from ``start_offset`` ago to ``end_offset`` ago, every ``schedule``."""

    rollup: str
    start_offset: str
    end_offset: str
    schedule: str


def mark(spark: SparkSession, rollup: Rollup) -> datetime | None:
    """The high-water mark (UTC), or None where the rollup was never refreshed."""
    text = storage.read_text(spark, rollup.mark_path)
    return None if text is None else datetime.fromisoformat(text)


def _set_mark(spark: SparkSession, rollup: Rollup, at: datetime) -> None:
    # Lost between delete and write, the mark reads as None: everything is then computed live.
    storage.write_text(spark, rollup.mark_path, at.isoformat())


def read(spark: SparkSession, rollup: Rollup, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Stored buckets below the mark, live ones from it on; only those from ``start`` to before ``end`` (bucket starts), if
    given. The bounds are literals in the plan, so they prune stored slices on one side and base slices on the other."""
    reached = mark(spark, rollup)
    if reached is None:
        return rollup.of(_base_rows(spark, rollup, start, end))
    store = rollup.store(spark)
    upto = reached if end is None else min(reached, end)
    stored = tables.read_slices(spark, store).where(F.col(store.slice_column) <= store.unit.of(upto)).where(F.col("time") < moment(upto))
    if start is not None:
        stored = stored.where(F.col(store.slice_column) >= store.unit.of(start)).where(F.col("time") >= moment(start))
    live = _base_rows(spark, rollup, reached if start is None else max(reached, start), end)
    return stored.select(*store.columns.names).unionByName(rollup.of(live))


def read_stored(spark: SparkSession, rollup: Rollup) -> DataFrame:
    """Only what refreshes have stored."""
    return tables.read(spark, tables.create(spark, rollup.store(spark)))


def refresh(
    spark: SparkSession,
    rollup: Rollup,
    now: datetime,
    start_offset: str = "1 week",
    end_offset: str = "1 hour",
    full: bool = False,
) -> tuple[datetime | None, datetime]:
    """Recompute the buckets lying wholly inside the window and raise the mark.

    The first refresh, and one with ``full``, starts at the oldest block. Returns the window."""
    reached = mark(spark, rollup)
    end = bucket_floor(now - _offset(end_offset), rollup.width)
    full = full or reached is None
    start = None if full else bucket_ceil(now - _offset(start_offset), rollup.width)
    if full and reached is not None:
        end = max(end, reached)
    if start is None or start < end:
        _replace(spark, rollup, start, end)
        _set_mark(spark, rollup, end if reached is None else max(end, reached))
    return start, end


def follow(spark: SparkSession, rollup: Rollup, store: KeyedTable, touched: list[datetime]) -> None:
    """Bring the stored buckets up to a change of the base: those of ``touched`` (bucket starts) and all from the mark to
    before the newest of them, which stays live. Of the base the slices of touched buckets are read and those from the mark on,
    so one old block costs one old slice. Buckets are put in place of stored ones: doing it again gives the same."""
    reached, newest = mark(spark, rollup), max(touched)
    if reached is None:
        _replace(spark, rollup, None, newest)
        _set_mark(spark, rollup, newest)
        return
    old, end = [t for t in touched if t < reached], max(reached, newest)
    changed = []
    if old:
        width = _offset(rollup.width)
        if isinstance(rollup.base, Rollup):
            spans = read(spark, rollup.base, min(old), max(old) + width)
        else:
            spans = tables.read_spans(spark, rollup.base, old, width)
        wanted = spark.createDataFrame([(t.replace(tzinfo=timezone.utc),) for t in old], "time timestamp")
        changed.append(rollup.of(spans).join(wanted, "time", "left_semi"))
    if end > reached:
        changed.append(rollup.of(_base_rows(spark, rollup, reached, end)))
    if changed:
        tables.replace(store, reduce(DataFrame.unionByName, changed))
    if end > reached:
        _set_mark(spark, rollup, end)


def run_policy(spark: SparkSession, rollup: Rollup, policy: Policy, now: datetime) -> None:
    refresh(spark, rollup, now, policy.start_offset, policy.end_offset)


def drop(spark: SparkSession, rollup: Rollup) -> None:
    """Remove the stored buckets and the mark; the base table stays."""
    for path in (rollup.path, rollup.mark_path):
        storage.drop(spark, path)


def _replace(spark: SparkSession, rollup: Rollup, start: datetime | None, end: datetime) -> None:
    store = tables.create(spark, rollup.store(spark))
    fresh = rollup.of(_base_rows(spark, rollup, start, end))
    if start is None:
        kept = tables.read(spark, store).where(F.col("time") >= moment(end))
        months = [name.partition("=")[2] for name in storage.children(spark, store.path) if "=" in name]
    else:
        months = _months(start, end)
        kept = (
            tables.read_slices(spark, store)
            .where(F.col("month").isin(months))
            .where((F.col("time") < moment(start)) | (F.col("time") >= moment(end)))
            .select(*store.columns.names)
        )
    rows = tables.with_slice(kept.unionByName(fresh), store)
    tables.publish(rows.select(*store.stored.names), store, months)


def _base_rows(spark: SparkSession, rollup: Rollup, start: datetime | None, end: datetime | None) -> DataFrame:
    """Base rows with ``start <= time < end``, by slices where the base is sliced by time. The base of a rollup on a rollup
    is what reading that one gives, stored and live."""
    if isinstance(rollup.base, Rollup):
        return read(spark, rollup.base, start, end)
    rows = (
        tables.read(spark, rollup.base)
        if start is None
        else tables.read_range(spark, rollup.base, rollup.time, start)
    )
    return rows if end is None else rows.where(F.col(rollup.time) < moment(end))


def _months(start: datetime, end: datetime) -> list[date]:
    months, month = [], start.date().replace(day=1)
    while month < end.date() or not months:
        months.append(month)
        month = (month + timedelta(days=32)).replace(day=1)
    return months


def _offset(text: str) -> timedelta:
    return timedelta(microseconds=width_micros(text))

