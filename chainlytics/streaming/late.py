"""Buckets of a stream under an event-time bound, and the rows that come too late for it.

A watermark trails the newest event time by a delay. Rows of a bucket that the mark has not passed are counted; rows behind it change
nothing and are kept in a side table. Spark's own windowed aggregate drops such rows without a word, and so does a stateful
function with an event-time timeout, so the state is kept by one without: two numbers for every bucket and salt, as many as
the table of buckets has, given up when a row is late for them. Salts split a hot bucket; a task reads its rows batch by
batch and keeps only their sums."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chainlytics import storage
from chainlytics.functions import time_bucket
from chainlytics.functions.buckets import width_micros
from chainlytics.plans import tables
from chainlytics.plans.tables import MONTH, KeyedTable
from chainlytics.schemas import INT, LONG, TIME, struct

DRAIN = {"availableNow": True}

#: Parts a bucket is split into.
SALTS = 8


def bucket_table(path: str) -> KeyedTable:
    """Sums of a bucket, one row for every salt."""
    return KeyedTable.by_time(path, struct(time=TIME, salt=INT, total=LONG, rows=LONG), ("time", "salt"), "time", MONTH)


def late_path(table: KeyedTable) -> str:
    return f"{table.path}__late"


def _counter(width: int, value: str, columns: list[str]):
    """The stateful function over (bucket start in microseconds, salt)."""

    def count(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, salt = int(key[0]), int(key[1])
        over = (start + width) // 1000 <= state.getCurrentWatermarkMs()
        if over:
            if state.exists:
                state.remove()
            for rows in parts:
                yield rows[columns].assign(_start=start, _salt=salt, _total=None, _rows=None)
            return
        total, number = state.get if state.exists else (0, 0)
        for rows in parts:
            total += int(rows[value].sum())
            number += len(rows)
        state.update((total, number))
        yield pd.DataFrame({"_start": [start], "_salt": [salt], "_total": [total], "_rows": [number]}).reindex(columns=[*columns, "_start", "_salt", "_total", "_rows"])

    return count


def late_stream(
    rows: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    time: str,
    value: str,
    width: str = "1 day",
    delay: str = "1 hour",
    salts: int = SALTS,
    trigger: Mapping = DRAIN,
) -> StreamingQuery:
    """Sum ``value`` (NULL counts as nothing) and count rows per bucket of ``time`` into ``table`` (a :func:`bucket_table`).

    A row is late if its whole bucket lies at or behind the mark, which is ``delay`` behind the newest time of the micro-batches
    before. Late rows are kept as they came under :func:`late_path`, one folder a micro-batch, so that a replay does not repeat
    them, and counted in no bucket. Rows without a time belong to no bucket and are left out."""
    spark = rows.sparkSession
    tables.create(spark, table)
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    marked = rows.where(F.col(time).isNotNull()).withWatermark(time, delay)
    keyed = marked.withColumns({"_bucket": F.unix_micros(time_bucket(time, width)), "_part": spread})
    found = T.StructType([*rows.schema.fields, *struct(_start=LONG, _salt=INT, _total=LONG, _rows=LONG)])
    counted = keyed.groupBy("_bucket", "_part").applyInPandasWithState(
        _counter(width_micros(width), value, rows.columns), found, "total bigint, rows bigint", "update", GroupStateTimeout.NoTimeout
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            late = batch.where("_rows IS NULL").select(*rows.columns)
            if not late.isEmpty():
                late.write.mode("overwrite").parquet(f"{late_path(table)}/batch={batch_id}")
            sums = batch.where("_rows IS NOT NULL").select(
                F.timestamp_micros("_start").alias("time"), F.col("_salt").alias("salt"), F.col("_total").alias("total"),
                F.col("_rows").alias("rows"), F.lit(batch_id).cast("bigint").alias("seq"),
            )
            tables.upsert(table, sums)
        finally:
            batch.unpersist()

    writer = counted.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).foreachBatch(apply).start()


def buckets(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """time, total and rows of every bucket."""
    return tables.read(spark, table).groupBy("time").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))


def late_rows(spark: SparkSession, table: KeyedTable, schema: T.StructType) -> DataFrame:
    """Rows that came too late, as they came."""
    if not storage.exists(spark, late_path(table)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(late_path(table)).select(*schema.names)
