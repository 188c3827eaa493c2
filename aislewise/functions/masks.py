"""Masking expressions. A mask hides values in a view; it does not protect the files below it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sha256_hex(col: Column) -> Column:
    return F.sha2(col.cast("string"), 256)


def sha256_base64(col: Column) -> Column:
    return F.base64(F.unhex(F.sha2(col.cast("string"), 256)))


def last_four(col: Column) -> Column:
    return F.concat(F.lit("XXXXX"), F.right(col.cast("string"), F.lit(4)))


def email(col: Column) -> Column:
    """Keeps the domain, hides the mailbox."""
    return F.regexp_replace(col.cast("string"), "^[^@]+", "XXXXX")


def default_value(col: Column, dtype: T.DataType) -> Column:
    """The neutral value of the column's type."""
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, (T.DateType, T.TimestampType)):
        return F.lit("1970-01-01").cast(dtype)
    return F.lit(None).cast(dtype)


def always_null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def card_number(col: Column) -> Column:
    """Card numbers keep four digits; the marker ``NA`` (cash sale) passes through."""
    return F.when(col == "NA", col).otherwise(F.concat(F.lit("X" * 12), F.right(col, F.lit(4))))


def card_number_for(col: Column, is_auditor: Column) -> Column:
    return F.when(is_auditor, col).otherwise(F.concat(F.lit("XXXX-XXXX-XXXX-"), F.right(col, F.lit(4))))


CARD_MASK_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION mask_card_number(val STRING) RETURNS STRING
RETURN CASE WHEN val = 'NA' THEN val ELSE concat(repeat('X', 12), right(val, 4)) END
"""


def register_card_mask(spark) -> None:
    """The same mask as a SQL function, for callers that write SQL."""
    spark.sql(CARD_MASK_SQL)
