"""As-of lookup: for every row, the last version that was made no later than it."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainlytics.operators.audit import audit_summary
from chainlytics.session import shuffle_width, workspace, written


def _ticks(column: Column) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(column.cast("timestamp"))


def asof(left: DataFrame, left_time: str, right: DataFrame, right_time: str, value: str) -> DataFrame:
    """``left`` with ``value`` of the last ``right`` row at or before its time; NULL where none is.
    Among right rows of one instant the greatest value counts.

    Instants are made distinct first (map-side, so a hot instant costs one row per task), then cut
    into equal ranges at approximate quantiles. A range holds no ties, so ranges stay balanced. Each
    range is filled forward on its own, starting from the last value of the ranges before it - that
    table has one row per range. Finally rows look their instant up, an equi-join whose hot instants
    adaptive execution splits."""
    spark = left.sparkSession
    instants = (
        left.select(_ticks(F.col(left_time)).alias("_t"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
        .unionAll(right.select(_ticks(F.col(right_time)).alias("_t"), F.col(value).alias("_v")))
        .where("_t IS NOT NULL")
        .groupBy("_t")
        .agg(F.max("_v").alias("_v"))
        # A DOUBLE holds microseconds exactly for some 285 years around the epoch.
        .withColumn("_x", F.col("_t").cast("double"))
    )
    instants = written(instants, workspace(spark, "instants"))  # read for the cuts and for the ranges
    ranges = shuffle_width(spark)
    wanted = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(instants.approxQuantile("_x", wanted, 0.5 / ranges))) if wanted else []
    splits = [float("-inf"), *cuts, float("inf")]
    placed = Bucketizer(splits=splits, inputCol="_x", outputCol="_r").transform(instants)

    lasts = placed.where("_v IS NOT NULL").groupBy("_r").agg(F.max_by("_v", "_t").alias("_v"))
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        spark.range(len(splits) - 1)
        .select(F.col("id").cast("double").alias("_r"))
        .join(lasts, "_r", "left")
        .select("_r", F.last("_v", ignorenulls=True).over(before).alias("_carry"))
    )
    upto = Window.partitionBy("_r").orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)
    answers = placed.join(F.broadcast(carried), "_r").select(
        "_t", F.coalesce(F.last("_v", ignorenulls=True).over(upto), F.col("_carry")).alias(value)
    )
    return left.withColumn("_t", _ticks(F.col(left_time))).join(answers, "_t", "left").drop("_t")


def audited_blocks(mined: DataFrame, predictions: DataFrame) -> DataFrame:
    """(prediction_time, block): the pairs the predict / wait / audit cycle works through.

    ``mined`` has block and mined_at, ``predictions`` has prediction_time. Every block falls to the
    latest prediction before it; of several blocks under one prediction only the highest is seen by
    the cycle, the others pass by unaudited."""
    rounds = predictions.select("prediction_time").distinct()
    return (
        asof(mined, "mined_at", rounds, "prediction_time", "prediction_time")
        .where("prediction_time IS NOT NULL")
        .groupBy("prediction_time")
        .agg(F.max("block").alias("block"))
    )


def audit_history(mined: DataFrame, actual: DataFrame, predicted: DataFrame, rounds: DataFrame | None = None) -> DataFrame:
    """Audit every block the cycle sees. ``actual`` has block and txid, ``predicted`` has
    prediction_time and txid; ``rounds`` (default: the times of ``predicted``) has the times of all
    predictions, the empty ones too."""
    # One row per prediction round, read three times below.
    pairs = written(audited_blocks(mined, predicted if rounds is None else rounds), workspace(mined.sparkSession, "pairs"))
    seen = actual.join(pairs.select("block"), "block", "left_semi")
    expected = predicted.join(pairs, "prediction_time").select("block", "txid")
    # A block that lists no transaction has no row above; it still gets its audit, with accuracy 0.
    summary = audit_summary(seen, expected)
    return (
        pairs.join(summary, "block", "left")
        .select(
            "block",
            "prediction_time",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("matches", "added", "missing")],
            F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"),
        )
    )
