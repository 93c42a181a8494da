"""Landed node records: headers, blocks, tips, chain info and mempool snapshots as JSON files.

Files are split over executors and rows go straight to a sink; nothing is gathered on the driver.
Schemas are given, never inferred. A record that does not parse is kept with its text in
``_corrupt_record``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlytics.functions import as_bigint, decode, epoch_to_time, to_smallest_unit
from chainlytics.schemas import BLOCK_BODY, CHAIN_INFO, CHAIN_TIP, HEADER_RECORD, MEMPOOL_ENTRY, MEMPOOL_SNAPSHOT

CORRUPT = "_corrupt_record"


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_records(spark: SparkSession, path: str, schema: T.StructType, whole_files: bool = False) -> DataFrame:
    """JSON records, one per line, or one per file with ``whole_files``."""
    return (
        spark.read.schema(with_corrupt(schema))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", whole_files)
        .json(path)
    )


def malformed(records: DataFrame) -> DataFrame:
    return records.where(F.col(CORRUPT).isNotNull())


def blocks_of(records: DataFrame) -> DataFrame:
    """Header records of mined blocks -> rows of the block table, plus the link to the parent and
    whatever else the record carries."""
    others = [c for c in records.columns if c not in (*HEADER_RECORD.names, CORRUPT)]
    return records.where(_parsed(records)).select(
        "hash",
        epoch_to_time("time").alias("timestamp"),
        "nTx",
        as_bigint("difficulty").alias("difficulty"),
        "height",
        "previousblockhash",
        *others,
    )


def _parsed(records: DataFrame) -> Column:
    return F.col(CORRUPT).isNull() if CORRUPT in records.columns else F.lit(True)


def read_headers(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Block rows of a height range, both ends included."""
    blocks = blocks_of(read_records(spark, path, HEADER_RECORD))
    if first is not None:
        blocks = blocks.where(F.col("height") >= first)
    return blocks if last is None else blocks.where(F.col("height") <= last)


def read_tips(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file with its ``tips`` array in listed order, and when (``landed``) and as what
    ``file`` it came. A file is one reply of the node, a few tips long."""
    replies = spark.read.text(path, wholetext=True)
    return replies.select(decode("value", T.ArrayType(CHAIN_TIP)).alias("tips"), *_landed())


def _landed() -> list[Column]:
    return [F.col("_metadata.file_modification_time").alias("landed"), F.col("_metadata.file_name").alias("file")]


def read_chain_info(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed reply, with ``landed`` and ``file``."""
    return read_records(spark, path, CHAIN_INFO, whole_files=True).select("*", *_landed())


def read_block_bodies(spark: SparkSession, path: str) -> DataFrame:
    """(block, txid) of landed block bodies, one block per line; repeats in a block are kept."""
    bodies = read_records(spark, path, BLOCK_BODY)
    return bodies.where(_parsed(bodies)).select(F.col("height").alias("block"), F.explode("tx").alias("txid"))


def blocks_ahead(blocks: DataFrame, info: DataFrame, start_block: int) -> DataFrame:
    """Blocks to process when the chain is ahead of ``start_block``: from it (again, it is the
    boundary) to the newest. ``info`` holds the node's replies."""
    tip = info.agg(F.max("blocks").alias("_newest"))
    return (
        blocks.crossJoin(F.broadcast(tip))
        .where((F.col("_newest") > start_block) & F.col("height").between(start_block, F.col("_newest")))
        .drop("_newest")
    )


def headers_start(info: DataFrame, start_block: int, start_header: int) -> DataFrame:
    """One row with the height headers are read from, or no row: headers must be ahead of both
    marks and the first download must be over. Of several landed replies the newest counts."""
    if "landed" in info.columns:
        reply = F.struct("headers", "initialblockdownload")
        info = info.agg(F.max_by(reply, F.struct("landed", "file")).alias("reply")).select("reply.*")
    return info.where(
        (F.col("headers") > start_header) & (F.col("headers") > start_block) & ~F.col("initialblockdownload")
    ).select(F.lit(max(start_block, start_header)).alias("start"))


def transactions_of(entries: DataFrame, exact: bool = False) -> DataFrame:
    """Mempool entries (txid, entry, and whatever else the row carries) -> typed transactions.
    Missing sigops count as 0."""
    others = [c for c in entries.columns if c not in ("txid", "entry")]
    return entries.select(
        "txid",
        to_smallest_unit("entry.fee", exact).alias("fee"),
        F.col("entry.weight").alias("weight"),
        F.coalesce("entry.sigops", F.lit(0)).alias("sigops"),
        *others,
    )


def parse_mempool(documents: DataFrame, text: str = "value", exact: bool = False) -> DataFrame:
    """Snapshots as one JSON object txid -> entry per row -> one row per transaction, with its
    position in the object. Other columns of the document, such as its time, are carried along."""
    others = [c for c in documents.columns if c != text]
    entries = documents.select(
        *others, F.posexplode(decode(text, MEMPOOL_SNAPSHOT)).alias("pos", "txid", "entry")
    )
    return transactions_of(entries, exact)


def read_mempool(spark: SparkSession, path: str, exact: bool = False) -> DataFrame:
    """Landed snapshots, one JSON object per file. ``snapshot`` is the time the file was written.
    One file is one reply of a node and bounded by the node's memory; many files spread out."""
    files = spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_modification_time").alias("snapshot")
    )
    return _stamped(parse_mempool(files, exact=exact))


def read_mempool_lines(spark: SparkSession, path: str, exact: bool = False) -> DataFrame:
    """Landed entries, one JSON record per line with its ``txid``: the layout that splits a big
    snapshot over executors."""
    record = T.StructType([T.StructField("txid", T.StringType()), *MEMPOOL_ENTRY.fields])
    rows = read_records(spark, path, record).withColumn("snapshot", F.col("_metadata.file_modification_time"))
    return _stamped(transactions_of(entries_of(rows), exact))


def entries_of(rows: DataFrame) -> DataFrame:
    """Flat entry records, as lines or topic messages have them, in the shape of map entries."""
    others = [c for c in rows.columns if c not in ("txid", CORRUPT, *MEMPOOL_ENTRY.names)]
    entry = F.struct(*MEMPOOL_ENTRY.names).alias("entry")
    return rows.where(_parsed(rows)).select("txid", entry, *others)


def _stamped(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"first_seen": F.col("snapshot"), "seq": F.unix_micros("snapshot")})
