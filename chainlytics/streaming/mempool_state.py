"""The mempool state in Spark's own state store: a streaming aggregate keyed by transaction, kept in RocksDB.

A micro-batch brings sightings of transactions, and those that were mined. The state of a transaction is its latest values, when
it was first seen, its place (lowest ``seq``, and position within that snapshot), which orders equal fee rates, and whether
it was mined. All of these are maxima and minima: sightings may come in any order, and what was mined stays away whenever an old
sighting comes again. The checkpoint holds the state by versions, one a micro-batch; a batch that was cut off runs again
from the version before it. Only what changed is uploaded; Spark makes snapshots of it in the background.

The state is read back, with no stream running, through Spark's state reader."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chainlytics.schemas import BOOL, INT, LONG, MEMPOOL_STATE, STRING, TIME, struct

SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

DRAIN = {"availableNow": True}

_VALUES = [f for f in MEMPOOL_STATE if f.name != "txid"]

# What the aggregates of ``_state`` keep, by position; Spark names its buffers otherwise.
_KEPT = T.StructType([T.StructField("latest", T.StructType(_VALUES)), *struct(at=LONG, first_ever_seen=TIME, place=LONG, pos=INT, pos_at=LONG, mined=BOOL)])


def _state(events: DataFrame) -> DataFrame:
    return events.groupBy("txid").agg(
        F.max_by(F.struct(*[f.name for f in _VALUES]), "seq").alias("latest"),
        F.min("first_seen").alias("first_ever_seen"),
        F.min("seq").alias("place"),
        F.min_by("pos", "seq").alias("pos"),
        F.bool_or("mined").alias("mined"),
    )


def mempool_stream(transactions: DataFrame, checkpoint: str, mined: DataFrame | None = None, trigger: Mapping = DRAIN) -> StreamingQuery:
    """Keep the state of ``transactions`` (txid, fee, weight, sigops, first_seen, seq, and pos if known), without those that
    the stream ``mined`` (txid) ever names.

    The number of state partitions is the session's number of shuffle partitions when the checkpoint is made. A hot
    transaction is reduced by every task before the shuffle."""
    spark = transactions.sparkSession
    rows = transactions if "pos" in transactions.columns else transactions.withColumn("pos", F.lit(0))
    columns = [*MEMPOOL_STATE, *struct(seq=LONG, pos=INT, mined=BOOL)]
    events = rows.select(*[F.col(f.name).cast(f.dataType) for f in columns[:-1]], F.lit(False).alias("mined"))
    if mined is not None:
        known = {"txid": F.col("txid").cast(STRING), "mined": F.lit(True)}
        events = events.unionByName(mined.select(*[known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in columns]))
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        writer = _state(events.where("txid IS NOT NULL")).writeStream.outputMode("update").format("noop")
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()  # with the settings of now
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def load(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The state after a micro-batch (default: the last one that is complete): one row per transaction that was seen and not
    mined; predict from it with ties ("place", "pos")."""
    reader = spark.read.format("statestore")
    stored = (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)
    kept = stored.select("key.txid", F.col("value").cast(_KEPT).alias("kept"))
    return kept.where("kept.latest IS NOT NULL AND NOT kept.mined").select("txid", "kept.latest.*", *[f"kept.{c}" for c in ("first_ever_seen", "place", "pos")])
