"""Keeping keyed rows unique when changes arrive late, twice, or with some columns only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hidden columns: the ``seq`` that a row's values were written with, and one more for each column that changes may leave out.
REGISTER = "_seq"
CHANGE = "_change"

#: Stored values without a register lose to any that has one.
_BEFORE_ALL = -(2**62)


def register_of(column: str, partial: Sequence[str]) -> str:
    return f"{REGISTER}_{column}" if column in partial else REGISTER


def latest_by_key(
    changes: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    seq: str = "seq",
    given: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key; every column holds the value of the highest ``seq`` that provided it.

    ``given`` says, per column, which change rows provide it (default: all). A provided NULL wins
    like any other value, a column that is not provided is left alone.

    ``seq`` is one BIGINT: with fixed-width columns this stays a hash aggregate, and rows of a hot
    key are reduced to one per task before the shuffle."""
    given = given or {}
    picks = [
        F.max_by(c, F.when(given[c], F.col(seq)) if c in given else F.col(seq)).alias(c) for c in columns
    ]
    return changes.groupBy(*keys).agg(*picks)


def registered(
    changes: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    partial: Sequence[str],
    seq: str = "seq",
    given: Mapping[str, Column] | None = None,
    within: str | None = None,
) -> DataFrame:
    """:func:`latest_by_key` with its registers: the ``seq`` of the row, and of each ``partial`` column, NULL where no
    change provides it. Changes of one ``seq`` go by ``within``, if given."""
    given = given or {}
    order = F.col(seq) if within is None else F.struct(F.col(seq), F.col(within))

    def provided(c: str, value: Column) -> Column:
        return F.when(given[c], value) if c in given else value

    picks = [F.max_by(c, provided(c, order)).alias(c) for c in columns]
    written_at = [F.max(F.col(seq).cast("bigint")).alias(REGISTER)]
    written_at += [F.max(provided(c, F.col(seq).cast("bigint"))).alias(register_of(c, partial)) for c in partial]
    return changes.groupBy(*keys).agg(*picks, *written_at)


def merge(stored: DataFrame, latest: DataFrame, keys: Sequence[str], columns: Sequence[str], partial: Sequence[str] | None = ()) -> DataFrame:
    """Stored rows and arriving ones (both with their registers, unique on ``keys``) as one row per key.

    Every column takes the value with the greater register, the arriving one if they are equal, and the greater register
    stays beside it. So the result is a maximum over all changes ever made: it does not depend on the order they arrive in
    nor on how often. With ``partial`` None there are no registers, and arriving rows win.

    ``_change`` tells an ``insert`` from an ``update`` of some value; it is NULL where nothing changed. Rows of both sides
    go through one aggregate. Registers lie between -2^62 and 2^62."""
    known = F.col("_arrived") == 0
    registers = [] if partial is None else [REGISTER, *[register_of(c, partial) for c in partial]]

    def order(c: str) -> Column:
        if partial is None:
            return F.col("_arrived")
        at = F.col(register_of(c, partial))
        stored_at = F.shiftleft(F.coalesce(at, F.lit(_BEFORE_ALL)), 1)
        return F.when(known, stored_at).otherwise(F.shiftleft(at, 1) + 1)

    names = [*keys, *columns, *registers]
    both = stored.select(*names, F.lit(0).alias("_arrived")).unionByName(latest.select(*names, F.lit(1).alias("_arrived")))
    merged = both.groupBy(*keys).agg(
        *[F.max_by(c, order(c)).alias(c) for c in columns],
        *[F.max(r).alias(r) for r in registers],
        *[F.max_by(c, F.when(known, F.lit(1))).alias(f"_was_{c}") for c in columns],
        F.min("_arrived").alias("_arrived"),
    )
    same = F.lit(True)
    for c in columns:
        same &= F.col(c).eqNullSafe(F.col(f"_was_{c}"))
    change = F.when(~known, F.lit("insert")).when(~same, F.lit("update")).alias(CHANGE)
    return merged.select(*names, change)


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def without_keys(df: DataFrame, removed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``removed``."""
    return df.join(removed.select(*keys).distinct(), list(keys), "left_anti")


def lookup(df: DataFrame, **key) -> DataFrame:
    """Rows of one key; no row where it is unknown."""
    for name, value in key.items():
        df = df.where(F.col(name) == F.lit(value))
    return df
