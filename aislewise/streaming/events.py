"""Reading checkout events: parse, reject, date, watermark and drop repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.functions.time import business_day, event_time
from aislewise.operators.dedup import latest_per_key

EVENT = (
    "transaction_id string, event_timestamp string, store_id string, cashier_id string, customer_id string, "
    "payment_method string, card_number string, subtotal_amount decimal(18,2), discount_amount decimal(18,4), "
    "promo_code_applied string, manual_discount_flag boolean, "
    "items array<struct<product_id: string, qty: bigint, unit_price: decimal(18,2)>>"
)
LATE_BY = "10 minutes"


def parse_events(raw: DataFrame, tz: str = "UTC", cutoff_hours: int = 4) -> DataFrame:
    """JSON text to event columns, with ``reject_reason`` where a row cannot be used.

    Nothing is dropped here: rejected rows keep their text for the dead-letter table.
    """
    parsed = F.from_json(
        "value", EVENT + ", _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    )
    ts = event_time("event_timestamp")
    reason = (
        F.when(F.col("_corrupt_record").isNotNull() | F.col("value").isNull(), "MALFORMED_JSON")
        .when(F.col("transaction_id").isNull(), "NO_TRANSACTION_ID")
        .when(F.col("store_id").isNull(), "NO_STORE_ID")
        .when(F.col("event_ts").isNull(), "BAD_EVENT_TIME")
    )
    return (
        raw.withColumn("_event", parsed)
        .select("value", "_event.*")
        .withColumn("event_ts", ts)
        .withColumn("business_date", business_day(F.col("event_ts"), tz, cutoff_hours))
        .withColumn("reject_reason", reason)
        .drop("_corrupt_record")
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "value")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def once(events: DataFrame, late_by: str = LATE_BY, key: str = "transaction_id") -> DataFrame:
    """Each transaction once. A stream forgets ids after the watermark; a table keeps the newest copy."""
    if events.isStreaming:
        return events.withWatermark("event_ts", late_by).dropDuplicatesWithinWatermark([key])
    return latest_per_key(events, [key], ["event_ts"])


def lateness(events: DataFrame, as_of: Column) -> DataFrame:
    """How far behind the clock events are: rows per minute of delay."""
    minutes = F.floor((F.unix_seconds(as_of) - F.unix_seconds("event_ts")) / 60)
    return events.groupBy(minutes.alias("minutes_late")).agg(F.count(F.lit(1)).alias("events"))
