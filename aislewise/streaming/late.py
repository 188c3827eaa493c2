"""Event intake that keeps late rows: what lies behind the watermark goes to a table of its own, and every row is counted.

A batch's watermark is the newest event time of the batches before it, less the allowed delay, as Spark's own is. It is kept in a
small table under the batch's id, so a batch that runs again finds the same watermark and replaces its own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aislewise.streaming import events
from aislewise.streaming.jobs import Lake, _run, write_batch

MARK = T.StructType([T.StructField("newest", T.TimestampType()), T.StructField("batch_id", T.LongType())])


def watermark(spark: SparkSession, lake: Lake, batch_id: int, late_by: str) -> Column | None:
    """The time behind which this batch's rows are late; None before any event."""
    try:
        marks = spark.read.schema(MARK).parquet(lake.path("marks")).where(F.col("batch_id") < batch_id)
        newest = marks.agg(F.max("newest")).first()[0]
    except Exception as e:  # noqa: BLE001 - the first batch has no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return None if newest is None else F.lit(newest) - F.expr(f"INTERVAL {late_by}")


def judged(raw: DataFrame, mark: Column | None) -> DataFrame:
    """Parsed events with their ``outcome``: on_time, late or rejected."""
    late = F.lit(False) if mark is None else F.col("event_ts") < mark
    outcome = F.when(F.col("reject_reason").isNotNull(), "rejected").when(late, "late").otherwise("on_time")
    return events.parse_events(raw).withColumn("outcome", outcome)


def intake(raw: DataFrame, lake: Lake, late_by: str = events.LATE_BY, trigger: dict | None = None) -> StreamingQuery:
    """Raw JSON to the tables silver, late and dead_letter, and the count of each outcome per batch to intake_counts.

    The counts are taken from the judged rows that are then written, and those of all three tables of a batch add up to its input.
    """

    def emit(batch: DataFrame, batch_id: int) -> None:
        outcomes = [F.count_if(F.col("outcome") == o).alias(o) for o in ("on_time", "late", "rejected")]
        newest = F.max(F.when(F.col("reject_reason").isNull(), F.col("event_ts"))).alias("newest")
        rows = judged(batch, watermark(batch.sparkSession, lake, batch_id, late_by)).persist()
        try:
            counts = rows.agg(*outcomes, newest).first()
            plain = rows.drop("outcome")
            write_batch(events.accepted(plain.where(rows["outcome"] == "on_time")), lake.path("silver"), batch_id, ("business_date",))
            write_batch(events.accepted(plain.where(rows["outcome"] == "late")), lake.path("late"), batch_id, ("business_date",))
            write_batch(events.rejected(plain), lake.path("dead_letter"), batch_id)
            spark = batch.sparkSession
            told = spark.createDataFrame([(counts["on_time"], counts["late"], counts["rejected"])], "on_time long, late long, rejected long")
            write_batch(told, lake.path("intake_counts"), batch_id)
            # Last: from here on the batch counts for the watermark of the next.
            mark = spark.createDataFrame([(counts["newest"],)], "newest timestamp")
            write_batch(mark, lake.path("marks"), batch_id)
        finally:
            rows.unpersist()

    writer = raw.writeStream.foreachBatch(emit).option("checkpointLocation", lake.checkpoint("intake"))
    return _run(writer, trigger)
