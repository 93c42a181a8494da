"""Keyed Parquet tables in slices: create, read, upsert, replace, delete.

A change is merged in the workspace and written from there with Spark's dynamic partition overwrite, which replaces the slices it
covers and no other. Upserts keep the winning ``seq`` beside the values (hidden columns), so the table is the same whatever
the order the changes arrive in, and however often: one that was cut off is simply made again."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlytics import storage
from chainlytics.functions import moment
from chainlytics.operators.changes import CHANGE, REGISTER, merge, register_of, registered
from chainlytics.schemas import BLOCKS, MEMPOOL_STATE
from chainlytics.session import workspace, written


@dataclass(frozen=True)
class Unit:
    """How rows are cut into slices: column name, its value from the time column, and the same value
    for a literal."""

    name: str
    rule: str
    kind: T.DataType
    of: Callable[[datetime], object]
    step: timedelta = timedelta.max


# A step is no longer than any slice.
MONTH = Unit("month", "cast(date_trunc('MONTH', {}) as date)", T.DateType(), lambda m: m.date().replace(day=1), timedelta(days=28))
DAY = Unit("day", "cast({} as date)", T.DateType(), lambda m: m.date(), timedelta(days=1))
HOUR = Unit("hour", "date_format({}, 'yyyy-MM-dd-HH')", T.StringType(), lambda m: m.strftime("%Y-%m-%d-%H"), timedelta(hours=1))


@dataclass(frozen=True)
class KeyedTable:
    """A table unique on ``keys`` and stored in slices: partitions derived from a key column, the
    unit that an upsert rewrites and a range read skips. Choose it by the size of one slice: days
    as a rule, hours where a day is too much to rewrite.

    ``partial`` names the columns that a change may leave out: each has a register of its own. A table that is not
    ``versioned`` has no registers; it can be replaced, not upserted."""

    path: str
    columns: T.StructType
    keys: tuple[str, ...]
    unit: Unit
    source: str
    partial: tuple[str, ...] = ()
    versioned: bool = True

    @classmethod
    def by_time(
        cls,
        path: str,
        columns: T.StructType,
        keys: Sequence[str],
        time: str,
        unit: Unit = DAY,
        partial: Sequence[str] = (),
        versioned: bool = True,
    ) -> KeyedTable:
        return cls(path, columns, tuple(keys), unit, time, tuple(partial), versioned)

    @classmethod
    def by_hash(cls, path: str, columns: T.StructType, keys: Sequence[str], slices: int = 64) -> KeyedTable:
        rule = f"cast(pmod(xxhash64({{}}), {slices}) as int)"
        return cls(path, columns, tuple(keys), Unit("shard", rule, T.IntegerType(), int), ", ".join(keys))

    @property
    def slice_column(self) -> str:
        return self.unit.name

    @property
    def values(self) -> list[str]:
        return [c for c in self.columns.names if c not in self.keys]

    @property
    def registers(self) -> list[str]:
        return [REGISTER, *[register_of(c, self.partial) for c in self.partial]] if self.versioned else []

    @property
    def stored(self) -> T.StructType:
        hidden = [T.StructField(r, T.LongType()) for r in self.registers]
        return T.StructType([*self.columns.fields, *hidden, T.StructField(self.slice_column, self.unit.kind)])

    @property
    def order(self) -> list[str]:
        """How rows lie within a file: by slice, then by what slices are derived from."""
        return [self.slice_column, *self.source.split(", ")]

    def folder(self, value: object) -> str:
        return f"{self.slice_column}={value}"


def create(spark: SparkSession, table: KeyedTable) -> KeyedTable:
    """Make an empty table; an existing one is left as it is."""
    if not storage.exists(spark, table.path):
        spark.createDataFrame([], table.stored).write.partitionBy(table.slice_column).parquet(table.path)
    return table


def read_slices(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """All columns and the slice column."""
    return spark.read.schema(table.stored).parquet(table.path).select(*table.columns.names, table.slice_column)


def _folders(spark: SparkSession, table: KeyedTable, root: str, names: Sequence[str]) -> DataFrame:
    """Some slices, by their folders: no other folder is listed, and no list of slices is in the plan."""
    if not names:
        return spark.createDataFrame([], table.stored)
    return spark.read.schema(table.stored).option("basePath", root).parquet(*[f"{root}/{name}" for name in names])


def read_named(spark: SparkSession, table: KeyedTable, names: Sequence[str]) -> DataFrame:
    """Rows of some slices, by the names of their folders."""
    return _folders(spark, table, table.path, names).select(*table.columns.names)


def read(spark: SparkSession, table: KeyedTable) -> DataFrame:
    return read_slices(spark, table).select(*table.columns.names)


def read_range(
    spark: SparkSession, table: KeyedTable, time: str, start: datetime, end: datetime | None = None
) -> DataFrame:
    """Rows with ``start <= time <= end`` of a table sliced by ``time``. A filter on the time alone
    reads every slice, so the matching filter on the slice column is added."""
    rows = read_slices(spark, table).where(F.col(time) >= moment(start))
    rows = rows.where(F.col(table.slice_column) >= table.unit.of(start))
    if end is not None:
        rows = rows.where(F.col(time) <= moment(end)).where(F.col(table.slice_column) <= table.unit.of(end))
    return rows.select(*table.columns.names)


def read_spans(spark: SparkSession, table: KeyedTable, starts: Sequence[datetime], width: timedelta) -> DataFrame:
    """Whole slices that spans of one width touch, of a table sliced by time; no other folder is opened."""
    names = set()
    for start in starts:
        at, end = start, start + width
        while at < end:
            names.add(table.folder(table.unit.of(at)))
            at += table.unit.step
        names.add(table.folder(table.unit.of(end - timedelta(microseconds=1))))
    known = sorted(names & storage.children(spark, table.path))
    return _folders(spark, table, table.path, known).select(*table.columns.names)


def with_slice(df: DataFrame, table: KeyedTable) -> DataFrame:
    return df.withColumn(table.slice_column, F.expr(table.unit.rule.format(table.source)))


def publish(rows: DataFrame, table: KeyedTable, may_empty: Sequence = ()) -> None:
    """Make ``rows`` the whole content of every slice they cover, and of the slices ``may_empty`` even if no row is left for
    one of those. ``rows`` may read the table itself: they are written to the workspace first."""
    spark = rows.sparkSession
    root = workspace(spark, "publish")
    merged = written(rows.select(*table.stored.names), f"{root}/merged")
    _overwrite(merged, table)
    if may_empty:
        covered = {r[0] for r in merged.select(F.col(table.slice_column).cast("string")).distinct().collect()}
        for value in may_empty:
            if str(value) not in covered:
                storage.drop(spark, f"{table.path}/{table.folder(value)}")
    storage.drop(spark, root)


def _slices(spark: SparkSession, table: KeyedTable) -> set[str]:
    """Folders of the slices the table has."""
    return {name for name in storage.children(spark, table.path) if name.startswith(f"{table.slice_column}=")}


def _overwrite(rows: DataFrame, table: KeyedTable) -> None:
    """Put whole slices in place of the stored ones. ``REBALANCE`` packs each into files of the advisory size, so small
    batches do not pile up small files, and splits a hot slice over tasks. While folders are replaced, a query that has already
    been planned may fail on a file that is gone; run it again."""
    packed = rows.select(*table.stored.names).hint("rebalance", table.slice_column).sortWithinPartitions(*table.order)
    writer = packed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(table.slice_column).parquet(table.path)


def upsert(
    table: KeyedTable,
    changes: DataFrame,
    seq: str = "seq",
    given: Mapping[str, Column] | None = None,
    within: str | None = None,
    then: Callable[[DataFrame], None] | None = None,
) -> None:
    """Lay changes over the table: per key and column the value of the greatest ``seq`` that provided it, over all changes
    ever made; of equal ones the one that arrives last, and within one call the one with the greatest ``within``.

    ``given`` marks the change rows that provide a column, one of ``table.partial``; see ``latest_by_key``. The order of
    calls does not matter, and a call may be repeated at any time. One writer at a time per table.

    Changes are reduced to one row per key and written to the workspace, so they are never computed twice. Only the slices
    they touch are read and rewritten, through one aggregate over stored and arriving rows; new slices hold nothing to merge
    with, and the first rows of a table are written at once. ``then`` is handed the rows that were really inserted or changed
    (``_change`` says which), before the table shows them: a caller that is cut off later finds them there again."""
    unknown = set(given or {}) - set(table.partial)
    if unknown or not table.versioned:
        raise ValueError(f"{table.path}: columns without a register: {sorted(unknown) or table.values}")
    _lay_over(table, registered(changes, table.keys, table.values, table.partial, seq, given, within), then)


def replace(table: KeyedTable, rows: DataFrame, then: Callable[[DataFrame], None] | None = None) -> None:
    """Put ``rows`` (unique on the keys) in place of stored rows of the same keys, whatever those hold. In a versioned table
    they have no register: any later change wins over them."""
    hidden = [F.lit(None).cast("bigint").alias(r) for r in table.registers]
    _lay_over(table, rows.select(*table.columns.names, *hidden), then, False)


def _lay_over(table: KeyedTable, latest: DataFrame, then: Callable[[DataFrame], None] | None, by_register: bool = True) -> None:
    spark = latest.sparkSession
    if then is None and not _slices(spark, table):
        return _fill(with_slice(latest, table), table)
    root = workspace(spark, "change")
    landed = written(with_slice(latest, table), f"{root}/incoming")
    known = _known(landed, table)
    if known is None:
        return storage.drop(spark, root)
    keys, partial = [*table.keys, table.slice_column], table.partial if by_register else None
    if known:
        merged = merge(_folders(spark, table, table.path, known), landed, keys, table.values, partial)
        hidden = [] if by_register else [F.lit(None).cast("bigint").alias(r) for r in table.registers]
        told = [] if then is None else [CHANGE]
        rows = written(merged.select("*", *hidden).select(*table.stored.names, *told), f"{root}/merged")
    else:
        rows = landed.withColumn(CHANGE, F.lit("insert"))
    if then is not None:
        then(rows.where(F.col(CHANGE).isNotNull()).select(*table.columns.names, CHANGE))
    _overwrite(rows, table)
    return storage.drop(spark, root)


def _fill(rows: DataFrame, table: KeyedTable) -> None:
    """Write the first rows of an empty table, or none if one has no slice."""
    value, refused = F.col(table.slice_column), f"{table.path}: key columns {table.keys} must not be NULL"
    checked = F.when(value.isNull(), F.raise_error(F.lit(refused))).otherwise(value)
    try:
        _overwrite(rows.withColumn(table.slice_column, checked), table)
    except PySparkException as error:
        if refused in str(error):
            raise ValueError(refused) from error
        raise


def delete(table: KeyedTable, removed: DataFrame) -> None:
    """Remove rows by key. Keys that are not stored are ignored.

    The keys are written as they come, to tell the slices they touch. Repeated ones fall away on their way to the join, whose
    shuffle they share, so a key costs one shuffle, and a hot one a row a task."""
    spark = removed.sparkSession
    root = workspace(spark, "delete")
    gone = written(with_slice(removed.select(*table.keys), table), f"{root}/keys")
    known = _known(gone, table)
    if known:
        stored = _folders(spark, table, table.path, known)
        kept = stored.join(gone.distinct(), [*table.keys, table.slice_column], "left_anti")
        publish(kept.select(*table.stored.names), table, [name.partition("=")[2] for name in known])
    storage.drop(spark, root)


def _known(batch: DataFrame, table: KeyedTable) -> list[str] | None:
    """Folders of the slices that a batch touches and the table has; None for a batch without rows.

    Slices are hours, days or months of the calendar, or a fixed number of shards - never row keys, so
    the list stays small."""
    touched = [r[0] for r in batch.select(F.col(table.slice_column).cast("string")).distinct().collect()]
    if None in touched:
        raise ValueError(f"{table.path}: key columns {table.keys} must not be NULL")
    if not touched:
        return None
    return sorted({table.folder(value) for value in touched} & _slices(batch.sparkSession, table))


def newest(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """Rows of the newest slice of a table sliced by time: all that a "latest row" needs to open."""
    names = sorted(name for name in storage.children(spark, table.path) if name.startswith(f"{table.slice_column}="))
    return _folders(spark, table, table.path, names[-1:])


def read_footers(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """The table through the newer Parquet source, which answers a global minimum, maximum or count of numbers from the
    files' footers and reads no row for it."""
    setting = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(setting)
    spark.conf.set(setting, ",".join(name for name in before.split(",") if name != "parquet"))
    try:
        return spark.read.schema(table.stored).parquet(table.path).select(*table.columns.names)
    finally:
        spark.conf.set(setting, before)


def append(rows: DataFrame, path: str) -> None:
    """Add rows; the write commits as a whole or not at all."""
    rows.write.mode("append").parquet(path)


def block_table(path: str) -> KeyedTable:
    """Blocks by the day of their time; headers leave the number of transactions out."""
    return KeyedTable.by_time(path, BLOCKS, ("timestamp", "hash"), "timestamp", partial=("nTx",))


def mempool_table(path: str, slices: int = 64) -> KeyedTable:
    return KeyedTable.by_hash(path, MEMPOOL_STATE, ("txid",), slices)

