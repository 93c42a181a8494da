"""Histogram of bucket totals over standard-deviation bands around their mean.

Bands are numbered 1..8. With mean m and sample deviation d, band 1 lies below m-3d, bands 2..7
are the six steps of one d between m-3d and m+3d, band 8 lies above m+3d. Both ends of a step
belong to it and the lowest matching number wins, so v = m is band 4. Below the mean a step's
lower end is never under zero. A NULL deviation leaves only band 4, ``[0.00 - m]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlytics.functions import two_decimals
from chainlytics.operators.rollups import bucket_stats

# The texts panels show and sort by.
BELOW, ABOVE = "< 4σ", "> 4σ"
STEP_NAMES = ["-3σ", "-2σ", "-1σ", "+1σ", "+2σ", "+3σ"]


def _edge(k: int) -> Column:
    return F.col("mean") if k == 0 else F.col("mean") + F.lit(float(k)) * F.col("stddev")


def _steps() -> list[tuple[Column, Column]]:
    """(low, high) of bands 2..7."""
    steps = []
    for low in range(-3, 3):
        bottom = F.greatest(F.lit(0.0), _edge(low)) if low < 0 else _edge(low)
        steps.append((bottom, _edge(low + 1)))
    return steps


def _labels() -> list[Column]:
    """Label texts of bands 1..8, computed once on the one statistics row."""
    labels = [F.lit(BELOW)]
    for position, (name, (low, high)) in enumerate(zip(STEP_NAMES, _steps())):
        # The lowest step always prints 0.00 as its start.
        start = F.lit("0.00") if position == 0 else two_decimals(low)
        labels.append(F.concat(F.lit(f"{name} ["), start, F.lit(" - "), two_decimals(high), F.lit("]")))
    return labels + [F.lit(ABOVE)]


def band(value: str | Column) -> Column:
    """Band number of a total next to ``mean`` and ``stddev``; NULL where nothing matches."""
    value = F.col(value) if isinstance(value, str) else value
    number = F.when(value < _edge(-3), 1)
    for position, (low, high) in enumerate(_steps(), start=2):
        number = number.when(value.between(low, high), position)
    return number.when(value > _edge(3), 8)


def sigma_histogram(totals: DataFrame, value: str, count: str) -> DataFrame:
    """``totals`` has one row per bucket. Result: ``stddev_range`` and the number of buckets in it,
    in band order with unmatched totals last. Bands without buckets have no row.

    The statistics are one row, so joining them by broadcast is safe at any size; the totals feed
    both sides and Spark reuses their shuffle instead of scanning the blocks twice."""
    stats = bucket_stats(totals, value).withColumn("labels", F.array(*_labels()))
    return (
        totals.select(F.col(value).alias("total"))
        .crossJoin(F.broadcast(stats))
        .select("labels", band("total").alias("band"))
        .select("band", F.get("labels", F.col("band") - 1).alias("stddev_range"))
        .groupBy("band", "stddev_range")
        .agg(F.count(F.lit(1)).alias(count))
        .orderBy(F.asc_nulls_last("band"))
        .select("stddev_range", count)
    )
