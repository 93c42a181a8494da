"""Messages for subscribers: an event name, and the payload as JSON text inside the JSON message."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chainlytics.functions import encode
from chainlytics.operators.changes import CHANGE
from chainlytics.operators.latest import SLICE, latest, latest_in_slices
from chainlytics.plans import tables
from chainlytics.plans.tables import KeyedTable
from chainlytics.streaming.ingest import DRAIN

# Event names of the messages.
INITIAL_DATA = "initial_data"
INITIAL_BLOCKS = "blocks_initial_data"
INITIAL_DAILY_TRANSACTIONS = "transactions_daily_initial_data"
INITIAL_TICKER_PRICE = "ticker_price_initial_data"
BLOCKS_NEW_ROW = "blocks_new_row"
TRANSACTIONS_NEW_ROW = "transactions_new_row"
TICKER_PRICE_NEW_ROW = "ticker_price_new_row"

# Change channels and the event each one sends.
CHANNELS = {
    "new_block": BLOCKS_NEW_ROW,
    "new_transactions": TRANSACTIONS_NEW_ROW,
    "new_ticker_price": TICKER_PRICE_NEW_ROW,
}


def envelopes(rows: DataFrame, event: str) -> DataFrame:
    """One message per row, in ``value``; works on tables and on streams."""
    payload = encode(F.struct(*rows.columns))
    return rows.select(encode(F.struct(F.lit(event).alias("event"), payload.alias("data"))).alias("value"))


def feed_stream(
    rows: DataFrame,
    channel: str,
    checkpoint: str,
    folder: str | None = None,
    servers: str | None = None,
    trigger: Mapping = DRAIN,
) -> StreamingQuery:
    """Send new rows of a channel as messages: to the broker topic of that name, or as text files."""
    writer = envelopes(rows, CHANNELS[channel]).writeStream.option("checkpointLocation", checkpoint)
    if servers:
        writer = writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", channel)
    else:
        writer = writer.format("text").option("path", folder)
    return writer.trigger(**trigger).start()


def change_stream(
    rows: DataFrame,
    table: KeyedTable,
    channel: str,
    checkpoint: str,
    folder: str,
    given: Mapping[str, Column] | None = None,
    trigger: Mapping = DRAIN,
) -> StreamingQuery:
    """Upsert a stream and send a message for every row that was really inserted or changed, and for no other: a block
    that is read twice is told once. ``rows`` has the table's columns and ``seq``.

    Messages are text files, a folder for each micro-batch, written before the table shows the change. A batch that is cut off
    before runs again and writes the same folder; one that is cut off after finds nothing changed and leaves it as it is."""
    spark = rows.sparkSession
    tables.create(spark, table)

    def apply(batch: DataFrame, batch_id: int) -> None:
        def tell(changed: DataFrame) -> None:
            if not changed.isEmpty():
                messages = envelopes(changed.drop(CHANGE), CHANNELS[channel])
                messages.write.mode("overwrite").text(f"{folder}/batch={batch_id}")

        tables.upsert(table, batch, given=given, then=tell)

    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).foreachBatch(apply).start()


def _listed(rows: DataFrame, event: str, by: str) -> DataFrame:
    """The rows (a top-10) as one JSON array, newest first."""
    newest_first = F.sort_array(F.collect_list(F.struct(F.col(by).alias("_by"), F.struct(*rows.columns).alias("row"))), False)
    data = encode(F.transform(newest_first, lambda r: r["row"]))
    return rows.agg(data.alias("data")).select(F.lit(event).alias("event"), "data")


def snapshot(blocks: DataFrame, daily: DataFrame, ticker: DataFrame) -> DataFrame:
    """What a new subscriber gets: latest blocks, daily totals and prices, one message each. Of a block
    table with its slice column only the slices that hold the latest blocks are read whole."""
    if SLICE in blocks.columns:
        newest = latest_in_slices(blocks, "height", ties=("timestamp", "hash")).drop(SLICE)
    else:
        newest = latest(blocks, "height", ties=("timestamp", "hash"))
    parts = [
        _listed(newest, INITIAL_BLOCKS, "height"),
        _listed(latest(daily, "time"), INITIAL_DAILY_TRANSACTIONS, "time"),
        _listed(latest(ticker, "timestamp"), INITIAL_TICKER_PRICE, "timestamp"),
    ]
    messages = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return messages.select("event", "data", encode(F.struct("event", "data")).alias("value"))


def respond(requests: DataFrame, blocks: DataFrame, daily: DataFrame, ticker: DataFrame) -> DataFrame:
    """Messages for every request text asking for initial data; other events get none."""
    asked = requests.where(F.get_json_object("value", "$.event") == INITIAL_DATA).withColumnRenamed("value", "request")
    return asked.crossJoin(F.broadcast(snapshot(blocks, daily, ticker)))
