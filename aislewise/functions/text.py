"""Identifiers, links and code extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes of codes the retrieval path looks for.
CODE_PATTERN = r"[A-Za-z0-9]+-[A-Za-z0-9-]+"
FAULT_PATTERN = r"ERR[-_](PAY|SYNC|NET|PRN|INV)[-_]\d{3,4}"
# The characters the warehouse dialect trims as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """Regex extract that is NULL, not the empty string, when nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def file_stem(uri: Column, extension: str = "pdf") -> Column:
    return first_match(uri, rf"([^/]+)\.{extension}$")


def https_link(uri: Column, host: str, scheme: str = "gs://") -> Column:
    """Object-store address to a clickable link on ``host``; any other address stays as it is."""
    return F.regexp_replace(uri, f"^{scheme}", f"{host.rstrip('/')}/")


def names_fault(text: Column) -> Column:
    return text.rlike(FAULT_PATTERN)


def store_key(raw: Column) -> Column:
    """``48``, ``Store 48`` and ``STORE_048`` all become ``STORE_048``; no digits leaves the input.

    The number stays text, so ids of any length keep all their digits.
    """
    digits = F.regexp_replace(raw.cast("string"), "[^0-9]", "")
    number = F.ltrim(digits, F.lit("0"))
    padded = F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number)
    return F.when(digits == "", raw.cast("string")).otherwise(F.concat(F.lit("STORE_"), padded))


def cashier_key(raw: Column) -> Column:
    digits = F.regexp_replace(raw.cast("string"), "[^0-9]", "")
    return F.when(digits == "", raw.cast("string")).otherwise(F.concat(F.lit("CASH_"), digits))


def trimmed(text: Column) -> Column:
    """Trim every Unicode white-space character, not only the blank."""
    return F.btrim(text, F.lit(WHITESPACE))


def or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))
