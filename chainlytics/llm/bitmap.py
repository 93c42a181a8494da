"""A bitmap of keys of fixed size, to leave most rows out before a shuffle. It may let others through, never loses one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the map: 4 MB, whatever the number of keys.
BITS = 1 << 25


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Words of the map of a bigint column; at most BITS / 64 rows reach the driver."""
    place = F.pmod(F.col(column), F.lit(BITS))
    rows = keys.select(F.shiftrightunsigned(place, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))").alias("bit"))
    out = np.zeros(BITS // 64, dtype=np.int64)
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def holds(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True for every key in the map, and for a few others."""
    place = keys.astype(np.int64) % BITS
    return (words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


def only(batches: Iterator[pa.RecordBatch], words: np.ndarray, column: str, inside: bool) -> Iterator[pa.RecordBatch]:
    """Rows whose key is in the map, or those whose key is not (rows without a key are not)."""
    for batch in batches:
        keys = batch.column(column)
        hit = holds(words, np.asarray(keys.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64))
        hit &= ~np.asarray(keys.is_null().to_numpy(zero_copy_only=False))
        yield batch.filter(pa.array(hit if inside else ~hit))
