"""Unit conversions, rates and JSON text as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNITS_PER_COIN = 100_000_000  # fixed value: smallest units in one coin
BANDS_PER_OCTAVE = 256
LOWEST_BAND = -(2**31)
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_OPTIONS = {
    "timestampFormat": TIME_FORMAT + "XXX",
    "timestampNTZFormat": TIME_FORMAT,
    "ignoreNullFields": "false",
}


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def epoch_to_time(seconds: str | Column) -> Column:
    """Epoch seconds -> TIMESTAMP."""
    return F.timestamp_seconds(seconds)


def as_bigint(value: str | Column) -> Column:
    """Assign a double to a BIGINT the way the block table does: rounded, ties away from zero."""
    return F.round(value).cast("bigint")


def number(text: str | Column) -> Column:
    """Raw command output such as ``' 861970\\n'`` -> BIGINT."""
    return F.regexp_replace(_column(text), r"^\s+|\s+$", "").cast("bigint")


def to_smallest_unit(coins: str | Column, exact: bool = False) -> Column:
    """Coins -> smallest units. The default cuts the binary product, so 0.29 gives 28999999;
    ``exact`` rounds through decimals and gives 29000000."""
    if exact:
        return (_column(coins).cast("decimal(20,8)") * F.lit(UNITS_PER_COIN)).cast("bigint")
    return (_column(coins) * F.lit(UNITS_PER_COIN)).cast("bigint")


def fee_rate(fee: str = "fee", weight: str = "weight") -> Column:
    """Fee per weight unit. A weight that is missing, zero or negative is an error, not a row to lose."""
    return F.when(F.col(weight) > 0, F.col(fee) / F.col(weight)).otherwise(
        F.raise_error(F.lit("transaction weight must be positive")).cast("double")
    )


def rate_band(rate: str | Column) -> Column:
    """Integer that never falls when ``rate`` rises: 1/256 octave steps, one band for rates <= 0.

    A double spans fewer than 2,100 octaves, so there are at most 540,000 bands whatever the data."""
    rate = _column(rate)
    return F.when(rate > 0, F.floor(F.log2(rate) * BANDS_PER_OCTAVE).cast("int")).otherwise(
        F.lit(LOWEST_BAND)
    )


def two_decimals(value: Column) -> Column:
    """Number as text with exactly two decimals, ties away from zero."""
    return F.format_string("%.2f", F.round(value, 2))


def encode(value: Column) -> Column:
    """Value -> JSON text with microsecond times and explicit nulls."""
    return F.to_json(value, JSON_OPTIONS)


def decode(text: str | Column, schema: T.DataType) -> Column:
    """JSON text -> value; text that does not parse gives NULL."""
    return F.from_json(_column(text), schema, JSON_OPTIONS)
