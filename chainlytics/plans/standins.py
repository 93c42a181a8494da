"""Block, mempool and price tables derived from the driver's tables, over all of their rows.

Timestamps stay TIMESTAMP_NTZ here, as the files have them; ``as_utc`` is for stores and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlytics.functions import time_bucket

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def blocks_from(rows: DataFrame) -> DataFrame:
    """One block per event: nTx is the event's k, difficulty its value in hundredths."""
    return rows.select(
        _hash("event_id").alias("hash"),
        F.col("ts").alias("timestamp"),
        F.get_json_object("props", "$.k").cast("int").alias("nTx"),
        F.round(F.col("value") * 100).cast("bigint").alias("difficulty"),
        F.col("event_id").cast("int").alias("height"),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks_from(events(spark, sf_dir))


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain that forks at every height: even events follow each other, each odd one is a dead
    end on the even event before it."""
    parent = F.col("event_id") - F.when(F.col("event_id") % 2 == 1, 1).otherwise(2)
    return events(spark, sf_dir).select(
        _hash("event_id").alias("hash"),
        F.when(parent >= 0, _hash(parent)).alias("previousblockhash"),
        F.col("ts").alias("timestamp"),
        F.round(F.col("value") * 100).cast("bigint").alias("difficulty"),
        F.ceil(F.col("event_id") / 2).cast("int").alias("height"),
        "event_id",
    )


def forked_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`headers`, but the dead ends after the middle of the events follow each other: two long branches."""
    rows = events(spark, sf_dir)
    fork = 2 * (rows.agg(F.max("event_id")).first()[0] // 4)
    number = F.col("event_id")
    parent = F.when((number % 2 == 1) & (number <= fork + 1), number - 1).otherwise(number - 2)
    return rows.select(
        _hash("event_id").alias("hash"),
        F.when(parent >= 0, _hash(parent)).alias("previousblockhash"),
        F.ceil(number / 2).cast("int").alias("height"),
        "event_id",
    )


def _hash(number):
    number = F.col(number) if isinstance(number, str) else number
    return F.sha2(number.cast("string").cast("binary"), 256)


def versions_from(rows: DataFrame) -> DataFrame:
    """Changes of one keyed row per user, over thirty days: views are header-only, the event number is the
    order."""
    return rows.select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("user_id") % 30 * 86400).cast("timestamp_ntz").alias("timestamp"),
        F.col("user_id").cast("string").alias("hash"),
        F.get_json_object("props", "$.k").cast("int").alias("nTx"),
        F.round(F.col("value") * 100).cast("bigint").alias("difficulty"),
        F.col("event_id").cast("int").alias("height"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "view", "header").otherwise("block").alias("kind"),
    )


def as_utc(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp"))


def mempool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One waiting transaction per line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws(
            "-",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.date_format("l_shipdate", "yyyyMMdd"),
        ).alias("txid"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("fee"),
        (F.col("l_quantity").cast("bigint") * 400).alias("weight"),
        F.col("l_linenumber").alias("sigops"),
        F.col("l_shipdate").alias("first_seen"),
        F.col("l_suppkey").alias("block"),
        "l_linestatus",
        "l_returnflag",
    )


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mempool(spark, sf_dir).where("l_linestatus = 'O'").select("block", "txid")


def actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mempool(spark, sf_dir).where("l_returnflag <> 'N'").select("block", "txid")


def ticker_from(rows: DataFrame) -> DataFrame:
    return rows.where("event_type = 'purchase'").select(F.col("ts").alias("timestamp"), F.col("value").alias("price"))


def ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticker_from(events(spark, sf_dir))


def snapshots_from(rows: DataFrame) -> DataFrame:
    """Mempool versions: an event is a sighting of its user's transaction in the snapshot of its day."""
    return rows.select(
        F.concat(F.lit("tx"), F.col("user_id")).alias("txid"),
        F.round(F.col("value") * 100).cast("bigint").alias("fee"),
        ((F.get_json_object("props", "$.k").cast("int") + 1) * 4).cast("bigint").alias("weight"),
        F.length("event_type").alias("sigops"),
        F.col("ts").alias("first_seen"),
        F.col("event_id").alias("seq"),
        time_bucket("ts", "1 day").alias("snapshot"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots_from(events(spark, sf_dir))
