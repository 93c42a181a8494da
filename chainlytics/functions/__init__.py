from chainlytics.functions.buckets import (
    bucket_ceil,
    bucket_floor,
    moment,
    register_sql,
    time_bucket,
    width_micros,
)
from chainlytics.functions.scalars import (
    as_bigint,
    decode,
    encode,
    epoch_to_time,
    fee_rate,
    number,
    rate_band,
    to_smallest_unit,
    two_decimals,
)

__all__ = [
    "as_bigint",
    "bucket_ceil",
    "bucket_floor",
    "decode",
    "encode",
    "epoch_to_time",
    "fee_rate",
    "moment",
    "number",
    "rate_band",
    "register_sql",
    "time_bucket",
    "to_smallest_unit",
    "two_decimals",
    "width_micros",
]
