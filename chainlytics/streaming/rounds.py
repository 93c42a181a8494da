"""Predict, wait for the next height, audit, predict again: the cycle as a stream of new heights."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chainlytics import storage
from chainlytics.operators.asof import audit_history
from chainlytics.plans import cycle, tables
from chainlytics.plans.tables import MONTH, KeyedTable
from chainlytics.schemas import DOUBLE, INT, TIME, struct
from chainlytics.session import workspace, written
from chainlytics.streaming.ingest import HEIGHT_POLL, every

AUDITS = struct(prediction_time=TIME, block_height=INT, matches=INT, added=INT, missing=INT, accuracy=DOUBLE)


def audit_table(path: str) -> KeyedTable:
    """One audit a prediction round."""
    return KeyedTable.by_time(path, AUDITS, ("prediction_time",), "prediction_time", MONTH)


def cycle_stream(
    heights: DataFrame,
    bodies: DataFrame | Callable[[DataFrame], DataFrame],
    predictions: str,
    audits: KeyedTable,
    checkpoint: str,
    predict: Callable[[], DataFrame] | None = None,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Audit new blocks as they come. ``heights`` is a stream of (block, mined_at); ``bodies`` has (block, txid), or gives it
    for the new blocks; ``predictions`` is where predictions are saved.

    Every new block is joined with the latest prediction before it, and a round's audit is that of the highest block it sees:
    the heights passed over are not audited. The audit is kept under the round's time with the height as its ``seq``, so
    a higher block takes its place and a lower one that comes later does not; micro-batches may be cut, ordered and
    repeated in any way. With ``predict`` the next prediction is made and saved after each audit (of a prediction made twice after a
    crash the later one counts). Heights are asked for every HEIGHT_POLL, unless ``trigger`` says otherwise."""
    spark = heights.sparkSession
    tables.create(spark, audits)

    def apply(batch: DataFrame, _: int) -> None:
        root = workspace(spark, "heights")
        mined = written(batch.select("block", "mined_at").distinct(), root)
        if mined.isEmpty():
            return storage.drop(spark, root)
        if storage.exists(spark, cycle.rounds_path(predictions)):
            listed = bodies(mined) if callable(bodies) else bodies
            found = audit_history(mined, listed, cycle.predictions(spark, predictions), cycle.rounds(spark, predictions))
            rows = found.withColumnRenamed("block", "block_height").withColumn("seq", F.col("block_height").cast("bigint"))
            tables.upsert(audits, rows.select(*[F.col(f.name).cast(f.dataType) for f in AUDITS], "seq"))
        if predict is not None:
            cycle.save_prediction(predict(), predictions)
        return storage.drop(spark, root)

    writer = heights.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or every(HEIGHT_POLL))).foreachBatch(apply).start()


def audits_of(spark: SparkSession, audits: KeyedTable) -> DataFrame:
    return tables.read(spark, audits)
