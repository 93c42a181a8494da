"""Explicit schemas of every table, message and landed record."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


STRING, INT, LONG, DOUBLE, BOOL, TIME = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
)

# Column types a definitions file may use -> Spark types.
COLUMN_TYPES = {
    "text": STRING,
    "timestamptz": TIME,
    "int4": INT,
    "int8": LONG,
    "float8": DOUBLE,
    "bool": BOOL,
}

BLOCKS = struct(hash=STRING, timestamp=TIME, nTx=INT, difficulty=LONG, height=INT)
HEADER_RECORD = struct(
    hash=STRING, time=LONG, difficulty=DOUBLE, height=INT, nTx=INT, previousblockhash=STRING
)
CHAIN_TIP = struct(hash=STRING, height=INT, status=STRING)
CHAIN_INFO = struct(blocks=INT, headers=INT, initialblockdownload=BOOL)
BLOCK_BODY = struct(height=INT, hash=STRING, tx=T.ArrayType(STRING))
MEMPOOL_ENTRY = struct(fee=DOUBLE, weight=LONG, sigops=INT)
MEMPOOL_SNAPSHOT = T.MapType(STRING, MEMPOOL_ENTRY)
MEMPOOL_STATE = struct(txid=STRING, fee=LONG, weight=LONG, sigops=INT, first_seen=TIME)
PREDICTED_BLOCKS = struct(prediction_time=TIME, txid=STRING, position=INT, fee=LONG, weight=LONG)
PREDICTION_ROUNDS = struct(prediction_time=TIME)
BLOCK_AUDITS = struct(
    block_height=INT, audit_time=TIME, matches=INT, added=INT, missing=INT, accuracy=DOUBLE
)
TICKER = struct(timestamp=TIME, price=DOUBLE)
