"""Walking headers back from a chain tip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlytics.session import workspace, written


def candidate_tip(tips: DataFrame) -> DataFrame:
    """First listed tip, unless it is the active chain already. ``tips`` has the listed ``tips`` array of
    a node's reply; of several replies, told apart by ``landed`` and ``file``, the newest counts."""
    if "landed" in tips.columns:
        tips = tips.agg(F.max_by("tips", F.struct("landed", "file")).alias("tips"))
    return tips.select(F.get("tips", F.lit(0)).alias("tip")).select("tip.*").where("status <> 'active'")


# Ancestors one level adds: a level is a quarter of the one before, in three joins against it.
FAN = 4


def walk(headers: DataFrame, tip_hash: str, tip_height: int, start_height: int = 0) -> DataFrame:
    """Headers met when following ``previousblockhash`` from the tip down to ``start_height``.

    The walk is pointer jumping over depths below the tip. Level k keeps the headers at depths that
    are multiples of 4^k, each with its ancestor 4^k further down, so all levels together hold a
    third more than the headers. Going back down the levels, every header found names the three that
    lie between it and the next one found, until the path is whole: a walk of n steps takes
    6 log4(n) joins, and none of them a step at a time.

    Levels, and the path at every third of them, are written to the shared folder: that ends the
    lineage, and their file sizes tell Spark which joins are small. Hashes are unique, so no join has a
    hot key on its build side."""
    near = headers.where(F.col("height").between(start_height, tip_height))
    path = trail(near, tip_hash, tip_height, start_height)
    return near.limit(0) if path is None else near.join(path, "hash", "left_semi")


def trail(near: DataFrame, tip_hash: str, tip_height: int, start_height: int = 0) -> DataFrame | None:
    """The hashes :func:`walk` meets among headers of these heights; some may name a header that is
    missing. None where there is no step to take."""
    spark = near.sparkSession
    steps = tip_height - start_height + 1
    if steps < 1:
        return None
    folder = workspace(spark, "walk")
    depth = F.lit(tip_height) - F.col("height")
    bottom = near.select("hash", F.col("previousblockhash").alias("up"), depth.alias("depth"))
    levels = [written(bottom, f"{folder}/level0")]
    while FAN ** len(levels) < steps:
        longer = levels[-1].where(F.col("depth") % FAN ** len(levels) == 0)
        for _ in range(FAN - 1):
            longer = longer.join(_hop(levels[-1], "up", "further"), "up").select(
                "hash", F.col("further").alias("up"), "depth"
            )
        levels.append(written(longer, f"{folder}/level{len(levels)}"))

    path = spark.createDataFrame([(tip_hash,)], "hash string")
    for number, level in reversed(list(enumerate(levels))):
        names = ["hash", *[f"below{i}" for i in range(1, FAN)]]
        for here, below in zip(names, names[1:]):
            # A left join: the last headers of a chain have nothing that far below them, and stay.
            path = path.join(_hop(level, here, below), here, "left")
        path = path.select(F.explode(F.array(*names)).alias("hash")).where("hash IS NOT NULL")
        if number % 3 == 0:
            path = written(path, f"{folder}/path{number}")
    return path


def _hop(level: DataFrame, here: str, below: str) -> DataFrame:
    return level.select(F.col("hash").alias(here), F.col("up").alias(below))


def process_headers(headers: DataFrame, tips: DataFrame, start_height: int) -> DataFrame:
    """Header rows between ``start_height`` and the first listed tip, without ``nTx``: they land
    before their blocks do. No row where the tip is active. Only the tip's one row is read here."""
    tip = candidate_tip(tips).first()
    found = headers.limit(0) if tip is None else walk(headers, tip["hash"], tip["height"], start_height)
    return found.select("hash", "timestamp", "difficulty", "height")


def canonical_only(blocks: DataFrame, headers: DataFrame, tip_hash: str, tip_height: int) -> DataFrame:
    """Blocks on the chain of one tip; by default forks stay in and sums count both sides."""
    path = trail(headers.where(F.col("height").between(0, tip_height)), tip_hash, tip_height)
    return blocks.limit(0) if path is None else blocks.join(path, "hash", "left_semi")
