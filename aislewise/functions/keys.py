"""Row keys, salts, hash chains and fixed-width cells of the serving table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.functions.time import reversed_micros, reversed_millis

SALT_BUCKETS = 16


def salt_bucket(entity: Column) -> Column:
    """One of 16 two-character buckets (``00`` to ``0f``) that spreads hot entities over key ranges."""
    return F.lpad(F.substring(F.md5(entity.cast("string")), 1, 1), 2, "0")


def serving_key(store: Column, cashier: Column, ts: Column) -> Column:
    return F.concat(store, F.lit("#"), cashier, F.lit("#"), reversed_micros(ts))


def alert_key(store: Column, ts: Column) -> Column:
    return F.concat(salt_bucket(store), F.lit("#STORE#"), store, F.lit("#ALERT#"), reversed_millis(ts))


def hourly_key(cashier: Column, hour_start: Column) -> Column:
    return F.concat(
        salt_bucket(cashier), F.lit("#CASHIER#"), cashier, F.lit("#WIN#"), F.date_format(hour_start, "yyyyMMddHH")
    )


def stock_key(store: Column, sku: Column) -> Column:
    return F.concat(salt_bucket(store), F.lit("#STORE#"), store, F.lit("#SKU#"), sku)


def hash_chain(seed: Column, passes: int) -> Column:
    """``passes`` rounds of SHA-256, each over the previous digest and a round label."""
    digest = seed
    for n in range(passes):
        digest = F.sha2(F.concat_ws("#", digest, F.lit(f"s{n}")), 256)
    return digest


def encode_int64(value: Column) -> Column:
    """Big-endian signed 64-bit cell."""
    return F.unhex(F.lpad(F.hex(value.cast("long")), 16, "0"))


def decode_int64(cell: Column) -> Column:
    return F.conv(F.hex(cell), 16, -10).cast("long")


@F.pandas_udf(T.BinaryType())
def encode_float64(values: pd.Series) -> pd.Series:
    """Big-endian IEEE-754 cell. Spark has no function from a double to its bits."""
    packed = values.to_numpy(dtype=">f8").tobytes()
    cells = pd.Series([packed[i : i + 8] for i in range(0, len(packed), 8)], dtype=object)
    return cells.where(~np.isnan(values.to_numpy(dtype="f8")), None)


def decode_float64(cell: Column) -> Column:
    """IEEE-754 double from its big-endian bytes, by sign, exponent and fraction."""
    bits = decode_int64(cell)
    sign = F.when(bits < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    exponent = F.shiftrightunsigned(bits, 52).bitwiseAND(F.lit(2047)).cast("int")
    fraction = bits.bitwiseAND(F.lit((1 << 52) - 1)).cast("double") / F.lit(float(1 << 52))
    normal = sign * (F.lit(1.0) + fraction) * F.pow(F.lit(2.0), (exponent - 1023).cast("double"))
    tiny = sign * fraction * F.pow(F.lit(2.0), F.lit(-1022.0))
    special = F.when(fraction == 0.0, sign * F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return F.when(exponent == 2047, special).when(exponent == 0, tiny).otherwise(normal)


def encode_text(value: Column) -> Column:
    return F.encode(value, "UTF-8")


def decode_text(cell: Column) -> Column:
    return F.decode(cell, "UTF-8")
