"""Predicted against mined transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MATCHED, ADDED, MISSING = "matches", "added", "missing"
SHARD_DIGITS = 1  # hex digits of a list shard
PAIR = ("block", "txid")


def _sides(actual: DataFrame, predicted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per distinct key: how often the mined side lists it, and its status.

    Both sides go through one shuffle on the whole key and are counted map-side first, so copies of
    one transaction never travel and a hot block is spread over its transactions. NULL is a key like
    any other."""
    both = actual.select(*keys, F.lit(1).alias("mined"), F.lit(0).alias("foreseen")).unionAll(
        predicted.select(*keys, F.lit(0).alias("mined"), F.lit(1).alias("foreseen"))
    )
    status = F.when(F.col("listed") == 0, MISSING).when(F.col("foreseen") == 1, MATCHED).otherwise(ADDED)
    return (
        both.groupBy(*keys)
        .agg(F.sum("mined").alias("listed"), F.max("foreseen").alias("foreseen"))
        .select(*keys, status.alias("status"), "listed")
    )


def matches(actual: DataFrame, predicted: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Predicted and mined: the intersection of two sets."""
    return _sides(actual, predicted, keys).where(F.col("status") == MATCHED).select(*keys)


def added(actual: DataFrame, predicted: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Mined but not predicted."""
    return _sides(actual, predicted, keys).where(F.col("status") == ADDED).select(*keys)


def missing(actual: DataFrame, predicted: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Predicted but not mined."""
    return _sides(actual, predicted, keys).where(F.col("status") == MISSING).select(*keys)


def audit_status(actual: DataFrame, predicted: DataFrame, block: str = "block") -> DataFrame:
    """One row per distinct (block, txid) with its status and how often the block lists it."""
    return _sides(actual, predicted, (block, "txid"))


def audit_summary(actual: DataFrame, predicted: DataFrame, block: str = "block") -> DataFrame:
    """Counts and accuracy per block. Accuracy is distinct matches over the length of the mined
    list, repeats included; 0 where nothing was mined."""
    counts = [F.count_if(F.col("status") == s).cast("int").alias(s) for s in (MATCHED, ADDED, MISSING)]
    return (
        audit_status(actual, predicted, block)
        .groupBy(block)
        .agg(*counts, F.sum("listed").alias("_mined"))
        .select(
            block,
            MATCHED,
            ADDED,
            MISSING,
            F.when(F.col("_mined") > 0, F.col(MATCHED) / F.col("_mined")).otherwise(0.0).alias("accuracy"),
        )
    )


def audit_lists(
    actual: DataFrame, predicted: DataFrame, block: str = "block", shard_digits: int = SHARD_DIGITS
) -> DataFrame:
    """Sorted transaction lists per block and status.

    A list is cut into 16^digits shards by the first hex digits of the transaction's SHA-256, so
    no row has to hold a whole hot block; the shards of a status together are its full list. One
    digit suits blocks of up to some 100,000 transactions, each further one 16 times as many.
    :func:`audit_status` is the unsharded long form."""
    status = audit_status(actual, predicted, block)
    shard = F.substring(F.sha2(F.col("txid").cast("binary"), 256), 1, shard_digits)
    return status.groupBy(block, "status", shard.alias("shard")).agg(
        F.sort_array(F.collect_list("txid")).alias("txids")
    )

