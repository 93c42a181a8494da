"""Waiting transactions: state over snapshots, ranking by fee rate, and the next-block prediction."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlytics.functions import fee_rate, rate_band
from chainlytics.operators.changes import without_keys
from chainlytics.session import shuffle_width, workspace, written

# Budgets of one block.
BLOCK_WEIGHT_LIMIT = 4_000_000
BLOCK_SIGOPS_LIMIT = 80_000


def mempool_state(snapshots: DataFrame, seq: str = "seq") -> DataFrame:
    """Latest version of every transaction ever seen.

    ``first_seen`` is that of the latest snapshot, as each snapshot replaces the entry; the true
    first time is kept as ``first_ever_seen``. ``place`` is the lowest ``seq`` of the transaction:
    a replaced entry keeps its place among equal fee rates. Where one snapshot's rows share a
    ``seq``, their position ``pos`` in it is kept as well: break ties by ``("place", "pos")``."""
    within = [F.min_by("pos", seq).alias("pos")] if "pos" in snapshots.columns else []
    return snapshots.groupBy("txid").agg(
        *[F.max_by(c, seq).alias(c) for c in ("fee", "weight", "sigops", "first_seen")],
        F.min("first_seen").alias("first_ever_seen"),
        F.min(seq).alias("place"),
        *within,
    )


def in_last_snapshot(snapshots: DataFrame, snapshot: str = "snapshot") -> DataFrame:
    """Only the rows of the newest snapshot. By default state grows for ever; this is the pruned view."""
    newest = snapshots.agg(F.max(snapshot).alias("_newest"))
    return snapshots.crossJoin(F.broadcast(newest)).where(F.col(snapshot) == F.col("_newest")).drop("_newest")


def without_mined(state: DataFrame, mined: DataFrame) -> DataFrame:
    return without_keys(state, mined, ["txid"])


def ranked_by_rate(state: DataFrame, ties: Sequence[str] = ("txid",)) -> DataFrame:
    """Every transaction with its fee rate, best first (a range-partitioned sort)."""
    return state.withColumn("fee_rate", fee_rate()).orderBy(F.desc("fee_rate"), *ties)


def with_rank(state: DataFrame, ties: Sequence[str] = ("txid",)) -> DataFrame:
    """Every transaction with its fee rate and its rank, from 1 in the order of :func:`ranked_by_rate`.

    The sorted rows are written; ranks then are a row's number in its range plus the rows of the
    ranges before (one number a range), so no task sees more than a range."""
    spark = state.sparkSession
    width = shuffle_width(spark)
    rated = state.withColumn("fee_rate", fee_rate())
    order = [F.desc("fee_rate"), *[F.col(t) for t in ties]]
    spread = rated.repartitionByRange(width, *order).withColumn("_range", F.spark_partition_id())
    numbered = written(spread.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), workspace(spark, "ranks"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    offsets = sizes.select("_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = (F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("bigint").alias("rank")
    return numbered.join(F.broadcast(offsets), "_range").select(*state.columns, "fee_rate", rank)


def predict_block(
    state: DataFrame,
    weight_limit: int = BLOCK_WEIGHT_LIMIT,
    sigops_limit: int = BLOCK_SIGOPS_LIMIT,
    by: Sequence[str] = (),
    ties: Sequence[str] = ("txid",),
) -> DataFrame:
    """Take transactions by falling fee rate while both running sums fit; stop at the first that
    does not, even if a later one would. One block, or one per group of ``by``. ``ties`` order
    equal rates and must tell any two rows apart.

    Weights are positive and sigops are not negative, so both running sums only rise and "stop" is
    the same as "running sum within the limit". The state is never sorted or shuffled as a whole:

    1. weight and sigops are summed per narrow band of fee rates: a small hash aggregate, run right
       away and written, as it steers the rest;
    2. running sums over the bands give the band in which a budget runs out; worse bands are
       filtered out in the scan;
    3. that band may still hold most rows, when they share one rate. Each part keeps the rows that
       would fit if its rows were alone, and the first that would not: whatever ends the block is the
       first misfit of its own part too, so it is still there at the end to stop it. No more than
       limit / lightest weight rows can fit, which lets Spark cut every task's rows before the
       shuffle, as far as that number stays below ``windowGroupLimitThreshold`` (see ``configure``);
       above it the rows of the cut band are shuffled to their parts, which are as many as the
       session's shuffle partitions;
    4. what is left is brought together in two steps, and is bounded by the budgets, not by the data.

    ``state`` is read twice, for the bands and for the rows, so it must be a fixed set: a table, or
    landed files no more of which arrive meanwhile.
    """
    by = list(by)
    spark = state.sparkSession
    rated = state.withColumns({"sigops": _counted("sigops"), "fee_rate": fee_rate()})
    rated = rated.withColumn("_band", rate_band("fee_rate"))
    sums = [F.sum("weight").alias("_w"), F.sum("sigops").alias("_s"), F.min("weight").alias("_lightest")]
    bands = written(rated.groupBy(*by, "_band").agg(*sums), workspace(spark, "bands"))
    lightest = bands.agg(F.min("_lightest")).first()[0]
    most = weight_limit // lightest if lightest else 0

    rising = Window.partitionBy(*by).orderBy(F.desc("_band")).rowsBetween(Window.unboundedPreceding, 0)
    over = (F.sum("_w").over(rising) > weight_limit) | (F.sum("_s").over(rising) > sigops_limit)
    cut = (
        bands.select(*by, "_band", over.alias("_over"))
        .groupBy(*[F.col(b).alias(f"_by_{b}") for b in by])
        .agg(F.max(F.when(F.col("_over"), F.col("_band"))).alias("_cut"))
    )
    # Without groups the cut is one row. With groups their number is the data's affair: Spark
    # broadcasts it only if its measured size allows, and splits hot groups of the join otherwise.
    same = [F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by]
    candidates = rated.join(cut, same) if by else rated.crossJoin(F.broadcast(cut))
    candidates = candidates.where(F.col("_cut").isNull() | (F.col("_band") >= F.col("_cut")))

    def running(df: DataFrame, *parts: str) -> DataFrame:
        order = Window.partitionBy(*by, *parts).orderBy(F.desc("fee_rate"), *ties)
        upto = order.rowsBetween(Window.unboundedPreceding, 0)
        sums = {"_n": F.row_number().over(order), "_w": F.sum("weight").over(upto), "_s": F.sum("sigops").over(upto)}
        return df.withColumns(sums)

    def up_to_the_misfit(df: DataFrame) -> DataFrame:
        """Rows of a part before which both sums are within the limits."""
        before = (F.col("_w") - F.col("weight") <= weight_limit) & (F.col("_s") - F.col("sigops") <= sigops_limit)
        return running(df, "_part").where((F.col("_n") <= most + 1) & before)

    # Which part a row falls into does not matter, so parts follow the tasks that read the rows.
    width = shuffle_width(spark)
    parts = up_to_the_misfit(candidates.withColumn("_part", F.spark_partition_id() % F.lit(width)))
    parts = up_to_the_misfit(parts.withColumn("_part", F.col("_part") % F.lit(isqrt(width))))
    block = running(parts).where((F.col("_n") <= most) & (F.col("_w") <= weight_limit) & (F.col("_s") <= sigops_limit))
    return block.select(
        *by,
        "txid",
        (F.col("_n") - 1).cast("int").alias("position"),
        "fee",
        "weight",
        "sigops",
        "fee_rate",
    )


def _counted(sigops: str):
    value = F.coalesce(F.col(sigops), F.lit(0))
    return F.when(value >= 0, value).otherwise(F.raise_error(F.lit("sigops must not be negative")).cast("int"))
