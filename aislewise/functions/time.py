"""Event times, business days and reversed timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_EPOCH_MILLIS = 9_999_999_999_999
MAX_INT64 = 9_223_372_036_854_775_807


def event_time(col: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to timestamp: the given format first, then Spark's default, NULL when neither reads it."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.coalesce(F.try_to_timestamp(text, F.lit(fmt)), F.try_to_timestamp(text))


def business_date(declared: Column, event_ts: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """The declared business date when it parses, otherwise the calendar day of the event."""
    return F.coalesce(F.try_to_date(declared.cast("string"), fmt), F.to_date(event_ts))


def business_day(ts: Column, tz: str = "UTC", cutoff_hours: int = 4) -> Column:
    """Trading day with a local cutoff: a sale at 03:59 still belongs to the day before."""
    local = ts if tz == "UTC" else F.from_utc_timestamp(ts, tz)
    return F.to_date(local - F.expr(f"INTERVAL {int(cutoff_hours)} HOURS"))


def month_boundaries(later: Column, earlier: Column) -> Column:
    """Number of month boundaries crossed (31 Jan to 1 Feb is one), not elapsed whole months."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def within_days(ts: Column, as_of: Column, days: int) -> Column:
    """Rolling recency window that ends at ``as_of``; the clock is always a parameter."""
    return ts >= as_of - F.expr(f"INTERVAL {int(days)} DAYS")


def date_range(col: Column, start: str | None, until: str | None, kind: str = "date") -> Column:
    """Inclusive range; a missing end, or the word ``all``, leaves that side open."""
    keep = F.lit(True)
    if start:
        keep = keep & (col >= F.lit(start).cast(kind))
    if until and until.lower() != "all":
        keep = keep & (col <= F.lit(until).cast(kind))
    return keep


def reversed_millis(ts: Column) -> Column:
    """Sorts newest first as text; 13 digits wide."""
    return F.lpad((F.lit(MAX_EPOCH_MILLIS) - F.unix_millis(ts)).cast("string"), 13, "0")


def reversed_micros(ts: Column) -> Column:
    """Sorts newest first as text; 19 digits wide."""
    return F.lpad((F.lit(MAX_INT64) - F.unix_micros(ts)).cast("string"), 19, "0")
