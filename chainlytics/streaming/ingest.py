"""Streams that keep tables current. Checkpoints remember progress, and keyed upserts make a replayed
micro-batch harmless, so every change is applied at least once with an exactly-once effect."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chainlytics import schemas, storage
from chainlytics.functions import time_bucket
from chainlytics.plans import rollup_store, tables
from chainlytics.plans.rollup_store import Policy, Rollup
from chainlytics.plans.tables import KeyedTable
from chainlytics.session import workspace, written
from chainlytics.sources.records import CORRUPT, blocks_of, malformed, with_corrupt
from chainlytics.sources.topics import landed_stream

# How often the node is asked for blocks, and for a new height while predicting.
BLOCK_POLL = "2 seconds"
HEIGHT_POLL = "10 seconds"

DRAIN = {"availableNow": True}


def every(interval: str) -> dict[str, str]:
    """Trigger for a stream that keeps running."""
    return {"processingTime": interval}


def _start(stream: DataFrame, apply, checkpoint: str, trigger: Mapping, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).foreachBatch(apply).start()


def upsert_stream(
    stream: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    given: Mapping[str, Column] | None = None,
    trigger: Mapping = DRAIN,
) -> StreamingQuery:
    """Upsert every micro-batch. ``stream`` has the table's columns and ``seq``; no watermark, as the
    table takes rows of any age, and micro-batches may come in any order and again."""
    tables.create(stream.sparkSession, table)

    def apply(batch: DataFrame, _: int) -> None:
        tables.upsert(table, batch, given=given)

    return _start(stream, apply, checkpoint, trigger)


def block_stream(
    records: DataFrame, table: KeyedTable, checkpoint: str, trigger: Mapping = DRAIN
) -> StreamingQuery:
    """Blocks and headers into the block table. ``records`` has the block columns, ``seq`` and
    ``kind``: a ``'header'`` row lands before its block and leaves ``nTx`` as it is."""
    return upsert_stream(records, table, checkpoint, {"nTx": F.col("kind") != "header"}, trigger)


def header_stream(
    spark: SparkSession,
    folder: str,
    table: KeyedTable,
    checkpoint: str,
    kind: str = "block",
    files_per_trigger: int | None = None,
    trigger: Mapping = DRAIN,
) -> StreamingQuery:
    """Landed header records (JSON lines) into the block table. ``kind`` tells whether the folder
    gets records of mined blocks, or headers that run ahead of their blocks.

    Lines that do not parse stop nothing: they are kept under :func:`malformed_path`, one folder per
    micro-batch, so that a replay does not repeat them, and counted in the query's progress (metrics ``headers``: rows,
    malformed). A micro-batch is parsed once, into the workspace. Of several versions of a key the one in the newest file
    counts, whatever the order files are read in; of files of one time in a micro-batch the last by name, else the one read
    last; within a file the last line."""
    tables.create(spark, table)
    lines = landed_stream(spark, folder, with_corrupt(schemas.HEADER_RECORD), "json", files_per_trigger, places=True)
    broken = F.count(F.when(F.col(CORRUPT).isNotNull(), 1)).alias("malformed")
    lines = lines.observe("headers", F.count(F.lit(1)).alias("rows"), broken)

    def apply(batch: DataFrame, batch_id: int) -> None:
        root, seen = workspace(spark, "lines"), Observation()
        parsed = written(batch.withColumn("line", F.monotonically_increasing_id()).observe(seen, broken), root)
        if seen.get["malformed"]:
            bad = malformed(parsed).select(CORRUPT)
            bad.write.mode("overwrite").text(f"{malformed_path(table)}/batch={batch_id}")
        rows = blocks_of(parsed).withColumns({"kind": F.lit(kind), "within": F.struct("file", "block", "line")})
        tables.upsert(table, rows, given={"nTx": F.col("kind") != "header"}, within="within")
        storage.drop(spark, root)

    return _start(lines, apply, checkpoint, trigger)


def malformed_path(table: KeyedTable) -> str:
    return f"{table.path}__malformed"


def rollup_stream(
    blocks: DataFrame,
    rollup: Rollup,
    checkpoint: str,
    trigger: Mapping = DRAIN,
    given: Mapping[str, Column] | None = None,
) -> StreamingQuery:
    """Blocks into the base table, and the buckets they touch into the stored rollup.

    ``blocks`` has the base table's columns and ``seq``. A micro-batch is upserted first; then the
    buckets it touches, and those between the old mark and the newest block's bucket, are computed
    anew from the base table, so blocks that are read twice, come late or change are counted as the
    base has them. The mark follows the newest block, so :func:`rollup_store.read` serves what is
    stored. A batch that is replayed after a crash gives the same tables."""
    spark = blocks.sparkSession
    store = tables.create(spark, rollup.store(spark))
    tables.create(spark, rollup.base)

    def apply(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        try:
            tables.upsert(rollup.base, batch, given=given)
            touched = batch.select(time_bucket(rollup.time, rollup.width).alias("time")).distinct()
            text = F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
            times = [datetime.fromisoformat(r[0]) for r in touched.where("time IS NOT NULL").select(text).collect()]
            if times:
                rollup_store.follow(spark, rollup, store, sorted(times))
        finally:
            batch.unpersist()

    return _start(blocks, apply, checkpoint, trigger)


def clock(spark: SparkSession) -> DataFrame:
    """A stream that ticks by itself, for work that must run on schedule whether rows arrive or not."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()


def policy_stream(
    changes: DataFrame, rollup: Rollup, policy: Policy, checkpoint: str, trigger: Mapping | None = None, now=None
) -> StreamingQuery:
    """Run a refresh policy on its schedule. ``changes`` drives it: :func:`clock` ticks always, a stream of
    base rows only while some arrive."""
    spark = changes.sparkSession

    def apply(_: DataFrame, __: int) -> None:
        at = now() if now else datetime.now(timezone.utc).replace(tzinfo=None)
        rollup_store.run_policy(spark, rollup, policy, at)

    return _start(changes, apply, checkpoint, trigger or every(policy.schedule))


def append_stream(rows: DataFrame, path: str, checkpoint: str, trigger: Mapping = DRAIN) -> StreamingQuery:
    """Append to Parquet with exactly-once file commits: predictions and audits."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()
