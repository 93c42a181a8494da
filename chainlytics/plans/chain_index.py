"""Stored jump pointers over block headers: ancestors and reorganisations without walking the chain.

Level k holds the headers at heights that are multiples of 4^k, each with its ancestor 4^k further down (level 0: its parent), a
third more rows than headers in all. Rows lie in bands of heights that grow with the level, so a batch of new headers reads and
writes the bands around its heights: what it costs follows the number of new headers, and the number of levels, not the
length of the chain. Headers may arrive in any order and again; a pointer that has to wait for a missing ancestor is
made when that arrives."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chainlytics import storage
from chainlytics.operators.chain import FAN, trail
from chainlytics.plans import tables
from chainlytics.plans.tables import KeyedTable, Unit
from chainlytics.schemas import INT, LONG, STRING, struct
from chainlytics.session import workspace, written

#: Headers of a level that a band holds, where every height has one.
BAND = 16_384

POINTERS = struct(level=INT, height=LONG, hash=STRING, up=STRING)


def chain_index(path: str, band: int = BAND) -> KeyedTable:
    rule = f"concat(level, '-', cast(height div (cast({band} as bigint) * cast(pow({FAN}, level) as bigint)) as string))"
    return KeyedTable(path, POINTERS, ("level", "height", "hash"), Unit(f"band{band}", rule, STRING, str), "level, height", versioned=False)


def _level(spark: SparkSession, index: KeyedTable, level: int, low: int, high: int) -> DataFrame:
    """Rows of a level between two heights, both included, from their bands alone."""
    size = int(index.slice_column.removeprefix("band")) * FAN**level
    stored = storage.children(spark, index.path)
    bands = sorted({index.folder(f"{level}-{b}") for b in range(max(0, low) // size, max(0, high) // size + 1)} & stored)
    return tables.read_named(spark, index, bands).where(F.col("height").between(low, high))


def _hops(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """``rows`` (height, hash, up) with up moved on by three more steps; rows that lack a step are left out."""
    for _ in range(FAN - 1):
        rows = rows.join(steps.select(F.col("hash").alias("up"), F.col("up").alias("further")), "up").select("height", "hash", F.col("further").alias("up"))
    return rows.where("up IS NOT NULL")


def _top(spark: SparkSession, index: KeyedTable) -> int:
    """A height that no header is above, from the names of the bands."""
    prefix = f"{index.slice_column}=0-"
    bands = [int(name.removeprefix(prefix)) for name in storage.children(spark, index.path) if name.startswith(prefix)]
    return (max(bands, default=0) + 1) * int(index.slice_column.removeprefix("band"))


def extend(index: KeyedTable, headers: DataFrame) -> None:
    """Add headers (hash, previousblockhash, height). Headers that are there already change nothing."""
    spark = headers.sparkSession
    tables.create(spark, index)
    root = workspace(spark, "chain")
    new = headers.where("hash IS NOT NULL AND height IS NOT NULL").select(F.col("height").cast("bigint").alias("height"), "hash", F.col("previousblockhash").alias("up")).distinct()
    new = written(new, f"{root}/new")
    low, high = new.agg(F.min("height"), F.max("height")).first()
    if low is not None:
        tables.replace(index, new.select(F.lit(0).alias("level"), "height", "hash", "up"))
        top = _top(spark, index)
        level = 1
        while FAN**level <= top:
            far = FAN**level
            # Whatever is new, and what waited for something new; its pointer is four steps of the level below.
            below = written(_level(spark, index, level - 1, low - far, high + far), f"{root}/below{level}")
            known = _level(spark, index, level, low, high + far).select("height", "hash")
            fresh = below.where((F.col("height") >= low) & (F.col("height") % far == 0) & F.col("up").isNotNull()).join(known, ["height", "hash"], "left_anti")
            made = written(_hops(fresh.select("height", "hash", "up"), below.select("hash", "up")), f"{root}/level{level}")
            if not made.isEmpty():
                tables.replace(index, made.select(F.lit(level).alias("level"), "height", "hash", "up"))
            level += 1
    storage.drop(spark, root)


def chain_stream(headers: DataFrame, index: KeyedTable, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Keep the index up with a stream of headers."""
    tables.create(headers.sparkSession, index)
    writer = headers.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).foreachBatch(lambda batch, _: extend(index, batch)).start()


def _up(spark: SparkSession, index: KeyedTable, level: int, at: list[tuple[str, int]]) -> list[str | None]:
    """The pointers of one or two headers at a level: a lookup of so many rows."""
    heights = [height for _, height in at]
    rows = _level(spark, index, level, min(heights), max(heights)).where(F.col("hash").isin([name for name, _ in at]))
    found = {(r["hash"], r["height"]): r["up"] for r in rows.collect()}
    return [found.get(header) for header in at]


def _climb(spark: SparkSession, index: KeyedTable, at: list[tuple[str, int]], level: int) -> list[tuple[str, int]] | None:
    ups = _up(spark, index, level, at)
    return None if None in ups else [(up, height - FAN**level) for up, (_, height) in zip(ups, at)]


def ancestor(spark: SparkSession, index: KeyedTable, tip: tuple[str, int], height: int) -> tuple[str, int] | None:
    """The (hash, height) above which ``tip`` was built at a height: some 6 log4 lookups of a row, or None where a header is missing."""
    at = tip
    while at[1] > height:
        level = 0
        while at[1] % FAN ** (level + 1) == 0 and at[1] - FAN ** (level + 1) >= height:
            level += 1
        step = _climb(spark, index, [at], level)
        while step is None and level > 0:  # a pointer that waits for a missing header
            level -= 1
            step = _climb(spark, index, [at], level)
        if step is None:
            return None
        at = step[0]
    return at if at[1] == height else None


def common_ancestor(spark: SparkSession, index: KeyedTable, one: tuple[str, int], other: tuple[str, int]) -> tuple[str, int] | None:
    """The highest header (hash, height) that both tips are built on; None where their chains do not meet.

    The higher tip comes down to the other's height. Both then jump together, by levels as high as their height allows, for as
    long as they differ, and where they would meet by lower ones: lookups of two rows, in the logarithm of the depth."""
    low = min(one[1], other[1])
    pair = [ancestor(spark, index, one, low), ancestor(spark, index, other, low)]
    if None in pair:
        return None
    if pair[0] == pair[1]:
        return pair[0]
    rising, level = True, 0
    while True:
        if rising:
            level = 0 if pair[0][1] % FAN else level
            while pair[0][1] % FAN ** (level + 1) == 0 and pair[0][1] >= FAN ** (level + 1):
                level += 1
        step = _climb(spark, index, pair, level)
        if step is not None and step[0] != step[1]:
            pair = step
        elif level > 0:
            rising, level = False, level - 1
        else:
            return None if step is None else step[0]


def reorganisation(spark: SparkSession, index: KeyedTable, old: tuple[str, int], new: tuple[str, int]) -> DataFrame:
    """(side, hash, height): the blocks ``leaving`` the chain and those ``entering`` it when the tip changes from ``old`` to
    ``new``, both (hash, height). Only heights above the common ancestor are read; chains that do not meet leave and enter whole."""
    meet = common_ancestor(spark, index, old, new)
    first = 0 if meet is None else meet[1] + 1
    sides = []
    for side, (name, height) in (("leaving", old), ("entering", new)):
        near = _level(spark, index, 0, first, height).select("hash", F.col("up").alias("previousblockhash"), "height")
        path = trail(near, name, height, first)
        if path is not None:
            sides.append(near.join(path.distinct(), "hash", "left_semi").select(F.lit(side).alias("side"), "hash", "height"))
    if not sides:
        return spark.createDataFrame([], "side string, hash string, height bigint")
    return sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
