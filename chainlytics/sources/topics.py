"""Message topics, read as streams from a broker or from a folder its messages are landed in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlytics.functions import decode
from chainlytics.schemas import HEADER_RECORD, MEMPOOL_ENTRY, STRING, TICKER

# Topic names.
RAW_BLOCKS = "raw-btc-blocks"
RAW_TRANSACTIONS = "raw-btc-transactions"
RAW_TRANSACTIONS_BACKFILL = "raw-btc-transactions-backfill"
RAW_PRICE = "raw-price-btcusd-binance"
RAW_TICKER = "raw-ticker-btcusd-binance"

_TRANSACTION = T.StructType([T.StructField("txid", STRING), *MEMPOOL_ENTRY.fields])

TOPICS: dict[str, T.StructType] = {
    RAW_BLOCKS: HEADER_RECORD,
    RAW_TRANSACTIONS: _TRANSACTION,
    RAW_TRANSACTIONS_BACKFILL: _TRANSACTION,
    RAW_PRICE: TICKER,
    RAW_TICKER: TICKER,
}


def broker_options(topic: str, servers: str, per_trigger: int | None = None, start: str = "earliest") -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def topic_stream(
    spark: SparkSession,
    topic: str,
    servers: str | None = None,
    folder: str | None = None,
    fmt: str = "json",
    files_per_trigger: int | None = None,
    schema: T.StructType | None = None,
    **broker,
) -> DataFrame:
    """Typed rows of a topic. With ``servers`` it comes from the broker, and ``seq`` is the offset;
    with ``folder`` from landed files, and ``seq`` is the time a file was written."""
    schema = schema or TOPICS[topic]
    if servers:
        messages = spark.readStream.format("kafka").options(**broker_options(topic, servers, **broker)).load()
        return messages.select(
            decode(F.col("value").cast("string"), schema).alias("record"), F.col("offset").alias("seq")
        ).select("record.*", "seq")
    return landed_stream(spark, folder, schema, fmt, files_per_trigger)


def landed_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    fmt: str = "json",
    files_per_trigger: int | None = None,
    pattern: str | None = None,
    places: bool = False,
) -> DataFrame:
    """Files of a folder as a stream, a bounded number of files per micro-batch: older files first, files of one time in
    any order. What is kept of the rows must therefore not depend on the order of micro-batches. With
    ``places`` rows also carry their ``file`` and the ``block`` of it they were read from."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    where = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block")] if places else []
    return reader.load(folder).select("*", F.unix_micros("_metadata.file_modification_time").alias("seq"), *where)


