"""Predict, save, audit, save: the steps of one round."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlytics.functions import moment
from chainlytics.operators.audit import audit_summary
from chainlytics.plans import tables
from chainlytics.plans.tables import KeyedTable
from chainlytics.schemas import BLOCK_AUDITS, MEMPOOL_STATE, PREDICTED_BLOCKS, PREDICTION_ROUNDS


def _now(at: datetime | None) -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None) if at is None else at


def rounds_path(path: str) -> str:
    return f"{path}__rounds"


def save_prediction(block: DataFrame, path: str, at: datetime | None = None) -> None:
    """Append a predicted block with its 0-based positions; all of its rows or none. Its time (default:
    now) is noted as a round, also of a block without rows."""
    spark, at = block.sparkSession, moment(_now(at))
    rows = block.withColumn("prediction_time", at)
    tables.append(rows.select(*[F.col(f.name).cast(f.dataType) for f in PREDICTED_BLOCKS]), path)
    tables.append(spark.range(1).select(at.cast("timestamp").alias("prediction_time")), rounds_path(path))


def save_audits(summary: DataFrame, path: str, at: datetime | None = None) -> None:
    """Append audit counts and accuracy, one row per block."""
    rows = summary.withColumnRenamed("block", "block_height").withColumn("audit_time", moment(_now(at)))
    tables.append(rows.select(*[F.col(f.name).cast(f.dataType) for f in BLOCK_AUDITS]), path)


def predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTED_BLOCKS).parquet(path)


def audits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_AUDITS).parquet(path)


def rounds(spark: SparkSession, path: str) -> DataFrame:
    """Times of all saved predictions, the empty ones too."""
    return spark.read.schema(PREDICTION_ROUNDS).parquet(rounds_path(path))


def audit_next(actual: DataFrame, predicted: DataFrame, height: int, rounds: DataFrame | None = None) -> DataFrame:
    """Audit the block mined at ``height`` (its txids) against the newest saved prediction; always one row.

    ``rounds`` (default: the times of ``predicted``) has the times of all predictions; the newest may
    have been empty."""
    times = (predicted if rounds is None else rounds).agg(F.max("prediction_time").alias("_newest"))
    expected = predicted.crossJoin(F.broadcast(times)).where("prediction_time = _newest")
    block = F.lit(height).alias("block")
    summary = audit_summary(actual.select(block, "txid"), expected.select(block, "txid"))
    one = actual.sparkSession.range(1).select(block)
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("matches", "added", "missing")]
    return one.join(summary, "block", "left").select("block", *counts, F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"))


def save_mempool(state: DataFrame, table: KeyedTable) -> None:
    """Upsert the state by txid."""
    spark = state.sparkSession
    tables.create(spark, table)
    tables.upsert(table, state.select(*MEMPOOL_STATE.names, F.lit(0).cast("bigint").alias("seq")))


def load_mempool(spark: SparkSession, table: KeyedTable) -> DataFrame:
    return tables.read(spark, table)
